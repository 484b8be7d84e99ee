"""The registry of countries and sources: one manifest.json for each country."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import REGISTRY

#: Names the folder of manifests, unless a caller gives it.
ROOT_VARIABLE = "CAIRN_REGISTRY"


def status(options: Column) -> Column:
    """enabled, conditional or disabled, from the status in a source's options (JSON text); no status is enabled."""
    raw = F.lower(F.get_json_object(F.coalesce(options, F.lit("{}")), "$.status"))
    return (
        F.when(raw.isNull() | (raw == "true"), "enabled").when(raw == "false", "disabled").when(raw == "conditional", "conditional")
        .otherwise(F.raise_error(F.concat(F.lit("invalid status: "), raw)))
    )


def registry(spark: SparkSession, root: str | None = None) -> DataFrame:
    """One row for each country, america first, then by id; sources as an array of structs. Ids must equal folders."""
    root = root or os.environ.get(ROOT_VARIABLE, "")
    if not root:
        raise ValueError(f"give the folder of manifests or set {ROOT_VARIABLE}")
    a = spark.read.schema(REGISTRY).option("multiLine", True).json(f"{root.rstrip('/')}/*/manifest.json").withColumn("__dir", F.element_at(F.split(F.input_file_name(), "/"), -2))
    own = F.when((F.col("id") == F.col("__dir")) & F.col("id").rlike(r"\A[a-z][a-z0-9-]*\z"), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("manifest id doesn't match its folder: "), F.coalesce("id", F.lit("null")))))
    return a.withColumn("id", own).drop("__dir").orderBy(F.when(F.col("id") == "america", 0).otherwise(1), "id")


def sources(countries: DataFrame) -> DataFrame:
    """(country, source, name, protocol, endpoint, status): one row for each source."""
    a = countries.select(F.col("id").alias("country"), F.explode("sources").alias("s"))
    return a.select("country", F.col("s.id").alias("source"), F.col("s.name").alias("name"), F.col("s.protocol").alias("protocol"), F.col("s.endpoint").alias("endpoint"), status(F.col("s.options")).alias("status"))


def country(spark: SparkSession, name: str, root: str | None = None) -> dict:
    """A country's manifest as a dict; a bad or unknown name raises."""
    if not re.fullmatch(r"[a-z][a-z0-9-]*", name):
        raise ValueError(f"invalid country: {name!r}")
    rows = registry(spark, root).where(F.col("id") == name).collect()
    if not rows:
        raise ValueError(f"unknown country: {name!r}")
    out = rows[0].asDict(recursive=True)
    out["sources"] = {s["id"]: {**s, "options": json.loads(s["options"] or "{}")} for s in out["sources"] or []}
    return out


def usable_source(manifest: dict, name: str) -> dict:
    """A source that may be read; an unknown, disabled or conditional one raises before any input is touched."""
    if name not in manifest["sources"]:
        raise ValueError(f"unknown source {name!r}; choose one of {', '.join(manifest['sources'])}")
    s = manifest["sources"][name]
    state = s["options"].get("status", True)
    if state is not True:
        raise ValueError(f"source {name!r} is {'disabled' if state is False else state}")
    return s
