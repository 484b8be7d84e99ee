"""Building and publishing an index: chunks, excluded chunks, vectors, blocks of postings and a one-row configuration."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..files import Files, beside
from ..functions.classify import serial_decision
from . import blocks
from .chunking import chunk_documents
from .embed import Embedder, embed

# Sources whose chunks are checked for serial fiction, and the version of the layout.
NEWSPAPER_SOURCES = ("loc_chronicling_america", "chronicling_america")
LAYOUT = 3


def guarded(docs: DataFrame, country: str | None = None, content_mode: str | None = None) -> DataFrame:
    """docs, failing at the first row of another country or content mode; nothing is filtered."""
    for name, want in (("country", country), ("content_mode", content_mode)):
        if want is not None:
            other = F.raise_error(F.concat(F.lit(f"{name} mismatch: expected {want}, found "), F.coalesce(name, F.lit("null"))))
            docs = docs.withColumn(name, F.when(F.col(name) == want, F.col(name)).otherwise(other))
    return docs


def split_serials(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded with filter_decision): literary chunks of newspaper sources leave the index."""
    a = chunks.withColumn("filter_decision", F.when(F.col("source").isin(*NEWSPAPER_SOURCES), serial_decision(F.col("text"))))
    literary = F.coalesce(F.col("filter_decision.status") == "literary", F.lit(False))
    return a.where(~literary).drop("filter_decision"), a.where(literary)


def numbered(chunks: DataFrame) -> DataFrame:
    """chunks with pos (bigint from 0) by document_id and ordinal: the order that ties fall back to.

    Rows are dealt by ranges and counted in each; only one count a partition is summed up on the driver.
    """
    a = chunks.repartitionByRange("document_id", "ordinal").sortWithinPartitions("document_id", "ordinal", "id")
    a = a.withColumn("__p", F.spark_partition_id()).withColumn("__n", F.monotonically_increasing_id() - (F.spark_partition_id().cast("bigint") * (1 << 33)))
    return a


def build(docs: DataFrame, path: str, embedder: Embedder, *, target: int | None = 350, overlap: int = 50, country: str | None = None, content_mode: str | None = None) -> dict:
    """Writes an index beside `path`, checks it and puts it in place; returns its configuration.

    target None: each document is one chunk, see chunk_documents(); overlap doesn't count then.

    Each table is written once and read back for the next: chunks are numbered and embedded from files, so a lost
    executor repeats its own tasks only. An index without chunks, or vectors that don't match the chunks, raise and
    leave the old index as it was.
    """
    spark = docs.sparkSession
    files, staging = Files(spark), beside(path, f"staging.{uuid.uuid4().hex}")
    try:
        kept, excluded = split_serials(chunk_documents(guarded(docs, country, content_mode), target, overlap))
        numbered(kept).write.parquet(f"{staging}/numbered")
        a = spark.read.parquet(f"{staging}/numbered")
        sizes = {r["__p"]: r["n"] for r in a.groupBy("__p").agg(F.count("*").alias("n")).collect()}
        total, rows = 0, []
        for p in sorted(sizes):
            rows.append((p, total))
            total += sizes[p]
        if not total:
            raise ValueError("no chunks to index")
        offsets = F.broadcast(spark.createDataFrame(rows, "__p int, __first bigint"))  # a row a partition
        a.join(offsets, "__p").withColumn("pos", F.col("__first") + F.col("__n")).drop("__p", "__n", "__first").write.parquet(f"{staging}/chunks")
        excluded.write.parquet(f"{staging}/excluded_chunks")
        chunks = spark.read.parquet(f"{staging}/chunks")
        embed(chunks, embedder).write.parquet(f"{staging}/embeddings")
        lexical = blocks.write(chunks, staging)
        files.delete(f"{staging}/numbered")
        config = {**configuration(spark, staging, lexical), "model": embedder.name, "target_words": target, "overlap_words": 0 if target is None else overlap}
        files.write_json(f"{staging}/config.json", config)
        promote(files, staging, path)
    finally:
        files.delete(staging)
    return config


def configuration(spark: SparkSession, path: str, lexical: dict) -> dict:
    """Counts and distinct countries, languages and modes of a written index; vectors must match the chunks one to one.

    lexical: what blocks.write() has counted.
    """
    chunks, vectors = spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/embeddings")
    c = chunks.agg(F.count("*").alias("n"), *[F.sort_array(F.collect_set(k)).alias(k) for k in ("country", "language", "content_mode")]).collect()[0]
    v = vectors.agg(F.count("*").alias("n"), F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high")).collect()[0]
    if v["n"] != c["n"] or v["low"] != v["high"]:
        raise ValueError(f"embedding mismatch: {c['n']} chunks, {v['n']} vectors of {v['low']} to {v['high']} dimensions")
    one = lambda x: x[0] if len(x) == 1 else None
    return {
        "schema_version": LAYOUT, "chunks": c["n"], "country": one(c["country"]), "content_mode": one(c["content_mode"]),
        "countries": c["country"], "languages": c["language"], "content_modes": c["content_mode"],
        "excluded_chunks": spark.read.parquet(f"{path}/excluded_chunks").count(),
        "integrity": {"chunk_rows": c["n"], "embedding_rows": v["n"], "embedding_dimensions": v["low"], "lexical_rows": lexical["lexical_rows"], "lexical_tokens": lexical["lexical_tokens"]},
    }


def open_index(spark: SparkSession, path: str, country: str | None = None, content_mode: str | None = None) -> tuple[DataFrame, DataFrame, blocks.BlockIndex]:
    """(chunks, vectors, lexical index) of a written index for search(); raises unless it holds that country and mode alone."""
    config = Files(spark).read_json(f"{path}/config.json")
    check_index(config, country, content_mode)
    n, tokens = config["integrity"]["chunk_rows"], config["integrity"]["lexical_tokens"]
    return spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/embeddings"), blocks.opened(spark, path, n, tokens)


def check_index(config: dict, country: str | None = None, content_mode: str | None = None) -> None:
    """Raises unless the index holds exactly that country and content mode."""
    for name, want in (("countries", country), ("content_modes", content_mode)):
        if want is not None and list(config.get(name) or []) != [want]:
            raise ValueError(f"index {name} mismatch: expected {want}, found {config.get(name)}")


def promote(files: Files, staging: str, path: str) -> None:
    """Puts a staged directory in place of the old one; if that fails the old one comes back. A stale backup raises."""
    backup = beside(path, "backup")
    if files.exists(backup):
        raise RuntimeError(f"refusing to overwrite a stale backup: {backup}")
    there = files.exists(path)
    if there:
        files.move(path, backup)
    try:
        files.move(staging, path)
    except BaseException:
        if there:
            files.move(backup, path)
        raise
    if there:
        files.delete(backup)


def add_positions(rows: DataFrame, *order: str) -> DataFrame:
    """rows with pos from one window; for inputs of a bounded size, such as results and registries."""
    return rows.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1)
