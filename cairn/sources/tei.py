"""TEI files of a local checkout: documents, and the list of texts to review."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import review_reasons
from ..schemas import as_documents
from . import markup


def read(spark: SparkSession, root: str) -> DataFrame:
    """(path, stem, title, date, authors, subjects, text, header, reasons) of the well-formed files below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{xml,XML}").load(root)
    a = markup.parse_tei(files.select("path", F.decode("content", "UTF-8").alias("xml")))
    stem = F.regexp_extract("path", r"([^/]*)\.[xX][mM][lL]\z", 1)
    a = a.withColumn("stem", stem).withColumn("title", F.coalesce(F.nullif("title", F.lit("")), "stem"))
    return a.withColumn("reasons", review_reasons(F.col("title"), F.col("subjects")))


def documents(files: DataFrame, *, review_candidates: bool = False, limit: int | None = None) -> DataFrame:
    """Documents with 100 characters, the first `limit` by path; those with a reason for review only if asked for."""
    a = files.where(F.length("text") >= 100)
    if not review_candidates:
        a = a.where(F.size("reasons") == 0)
    status = F.when(F.size("reasons") > 0, "review_candidate").otherwise("retained")
    meta = F.to_json(F.struct(F.col("path").alias("local_xml"), "subjects", "header", status.alias("nonfiction_status"), F.col("reasons").alias("classification_reasons")))
    out = a.select(F.concat(F.lit("evans:"), "stem").alias("id"), F.lit("evans_tcp").alias("source"), "title", "text", F.concat(F.lit("https://texts.earlyprint.org/works/"), "stem").alias("url"), "date", "authors", F.lit("early_american_imprint").alias("genre"), F.lit("Public-domain Evans-TCP transcription").alias("rights"), meta.alias("metadata"), "path")
    out = as_documents(out, "path").orderBy("path")
    return (out if limit is None else out.limit(limit)).drop("path")


def review_list(files: DataFrame) -> DataFrame:
    joined = lambda c: F.array_join(F.array_distinct(c), " | ")
    a = files.where(F.size("reasons") > 0)
    get = lambda k: F.coalesce(F.try_element_at("header", F.lit(k)), F.lit(""))
    return a.select(
        F.col("stem").alias("tcp_id"), "title", F.col("date").alias("publication_year"), joined("authors").alias("authors"), joined("subjects").alias("subjects"), joined("reasons").alias("candidate_reasons"),
        get("wordCount").alias("word_count"), get("finalGrade").alias("quality_grade"), F.concat(F.lit("https://texts.earlyprint.org/works/"), "stem").alias("url"), F.lit("REVIEW—NOT EXCLUDED").alias("decision"),
    )


def write_review_list(files: DataFrame, path: str) -> tuple[int, int]:
    """One CSV file for readers, with a byte order mark, rows by path; returns (files, listed). Rows stream to the driver."""
    listed, n = review_list(files.orderBy("path")), 0
    with open(path, "w", newline="", encoding="utf-8-sig") as f:
        w = csv.writer(f)
        for r in listed.toLocalIterator():
            if not n:
                w.writerow(listed.columns)
            w.writerow(list(r))
            n += 1
        if not n:
            w.writerow(["tcp_id"])
    return files.count(), n
