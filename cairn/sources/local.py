"""JSON Lines in and out, and audited local exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import rights_eligible
from ..functions.text import clean_text, earliest_year, stable_id, strip
from ..schemas import DOCUMENT, as_documents
from . import markup, ordered

#: Columns of records.jsonl.
EXPORT = T.StructType([T.StructField(k, T.StringType()) for k in ("id", "source", "path", "title", "date", "url", "rights", "place", "genre")] + [T.StructField("authors", T.ArrayType(T.StringType()))])
MIN_CHARS, MAX_BYTES = 100, 20_000_000


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT, *, strict_keys: bool = True) -> DataFrame:
    """JSON Lines: a byte order mark and blank lines are skipped, a malformed line fails, and so does an unknown key."""
    if not strict_keys:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).select(F.regexp_replace("value", "\\A\ufeff", "").alias("value")).where(strip(F.col("value")) != "")
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    extra = F.array_except(F.json_object_keys("value"), known)
    bad = F.json_object_keys("value").isNull()
    checked = F.when(bad, F.raise_error(F.concat(F.lit("malformed line: "), F.substring("value", 1, 80)))).when(F.size(extra) > 0, F.raise_error(F.concat(F.lit("unknown keys: "), F.array_join(extra, ", ")))).otherwise(F.col("value"))
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name == "metadata" else f.dataType) for f in schema.fields])
    return lines.select(F.from_json(checked, as_text, {"mode": "FAILFAST"}).alias("x")).select("x.*")


def write_jsonl(df: DataFrame, path: str, *, append: bool = False) -> None:
    """JSON Lines. Appending never removes duplicates; else the new folder takes the place of the old one once it is whole.

    The old folder steps aside and goes last; if the new one can't be put in place, the old one comes back.
    """
    if append:
        df.write.mode("append").json(path)
        return
    staging = path.rstrip("/") + ".staging"
    df.write.mode("overwrite").json(staging)
    jvm = df.sparkSession._jvm
    new, old = jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(path)
    fs = new.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".old")
    there = fs.exists(old)
    if there:
        fs.delete(aside, True)
        if not fs.rename(old, aside):
            raise RuntimeError(f"can't move {path} aside")
    if not fs.rename(new, old):
        if there:
            fs.rename(aside, old)
        raise RuntimeError(f"can't put {path} in place")
    fs.delete(aside, True)


def local_export(spark: SparkSession, root: str, *, source: str, country: str, language: str, cutoff: int, caution: str = "", protocol: str = "", rights_override: str = "", max_bytes: int = MAX_BYTES, limit: int | None = None) -> DataFrame:
    """Documents of records.jsonl and the text files beside it, in the order of the records; the first `limit` of them.

    A record needs its source (or none), a known year up to the cutoff, eligible rights or an override, a text of 100
    characters in a file of max_bytes at most, and an address. Its path must be relative, not empty, and stay inside root;
    else the query fails, and so it does at a malformed XML file. XML files give all their text. A record without a title
    has its file's name for one, without a date its year. Filters on the record come before any text is read.
    """
    if rights_override and not rights_override.strip():
        raise ValueError("rights_override cannot be blank")
    root = root.rstrip("/")
    records = spark.read.schema(EXPORT).option("mode", "FAILFAST").json(f"{root}/records.jsonl")
    records = records.select("*", F.monotonically_increasing_id().alias("pos"))
    year = earliest_year(F.array(F.coalesce("date", F.lit(""))))
    rights = F.coalesce(F.nullif("rights", F.lit("")), F.lit(rights_override))
    ok = F.lit(True) if rights_override else rights_eligible(rights)
    a = records.where((F.coalesce("source", F.lit("")).isin("", source)) & (year <= cutoff) & ok)
    path = F.coalesce("path", F.lit(""))
    parts = F.split(path, "/")
    depth = F.aggregate(parts, F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")), lambda s, p: F.struct(_deeper(s, p).alias("d"), F.least(s["low"], _deeper(s, p)).alias("low")), lambda s: s["low"])
    bad = (path == "") | path.startswith("/") | (depth < 0)
    a = a.withColumn("path", F.when(bad, F.raise_error(F.concat(F.lit("path must be relative and inside the export: "), path))).otherwise(path))
    # a path without its "." parts, and without each ".." and the part before it
    tidy = F.aggregate(F.split("path", "/"), F.array().cast("array<string>"), lambda s, p: F.when(p.isin("", "."), s).when(p == "..", F.slice(s, F.lit(1), F.size(s) - 1)).otherwise(F.array_append(s, p)))
    a = a.withColumns({"__year": year, "__rights": rights, "__file": F.array_join(tidy, "/")})
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    whole = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = whole.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(whole).toUri().getPath()
    own = F.substring_index("path", whole + "/", -1)
    files = files.where((F.col("length") <= max_bytes) & ~F.col("path").endswith("/records.jsonl")).select(own.alias("__file"), "content")

    def build(part: DataFrame) -> DataFrame:
        b = part.join(files, "__file")
        is_xml = F.lower("__file").rlike(r"\.(xml|tei)\z")
        plain = b.where(~is_xml).withColumn("text", clean_text(F.regexp_replace(F.when(~is_xml, F.decode("content", "UTF-8")), "\\A\ufeff", ""))).drop("content")
        parsed = markup.elements(b.where(is_xml), ("#text",), column="content", strict=True)
        xml = parsed.withColumn("text", clean_text(F.element_at("elements", -1)["text"])).drop("elements")
        b = plain.unionByName(xml).where(F.length("text") >= MIN_CHARS)
        url = F.when(F.coalesce("url", F.lit("")) == "", F.raise_error(F.concat(F.lit("a record without an address: "), "path"))).otherwise(F.col("url"))
        record = F.coalesce(F.nullif("id", F.lit("")), "path")
        stem = F.regexp_replace(F.substring_index("__file", "/", -1), r"(?<=.)\.[^.]*\z", "")
        status = "operator_override" if rights_override else "source_record"
        meta = F.struct(F.lit(protocol).alias("protocol"), F.lit(True).alias("local_export"), record.alias("local_record_id"), F.col("path").alias("source_file"), F.lit(cutoff).alias("publication_year_filter"), F.lit(status).alias("rights_status"), F.lit(caution).alias("rights_caution"))
        out = b.select(
            F.concat(F.lit(f"{country}:{source}:"), stable_id(record)).alias("id"), F.lit(source).alias("source"), F.coalesce(F.nullif("title", F.lit("")), stem).alias("title"), "text", url.alias("url"),
            F.coalesce(F.nullif("date", F.lit("")), F.col("__year").cast("string")).alias("date"), "authors", "place", "genre", F.col("__rights").alias("rights"), F.lit(country).alias("country"), F.lit(language).alias("language"), F.to_json(meta).alias("metadata"), "pos",
        )
        return as_documents(out, "pos")

    return ordered.first_documents(a, build, limit)


def _deeper(s: Column, p: Column) -> Column:
    return s["d"] + F.when(p == "..", -1).when(p.isin("", "."), 0).otherwise(1)
