"""A corpus pipeline: documents that pass quality rules, without near copies and benchmark leaks, mixed and tokenised.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents. run() applies them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cairn.llm import decontam, mixing, neardup, quality_rules, tokens
from cairn.llm.common import shared_dir
from cairn.llm.queries import tokenizer_path
from cairn.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep; null and empty texts go, see keep_good()."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least doc_id, a null one last; see one_of_each()."""
    ship_package(spark)
    return neardup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts stay, see clean()."""
    ship_package(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in files ordered by the slots of the mix; a null source is a source, see schedule()."""
    return mixing.mixed_order(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, which is the row order of the files that hold docs, and their contents.

    A DataFrame that no files hold is written in order of doc_id, null ids first. A null text has only the end id.
    """
    ship_package(spark)
    try:
        docs = docs.selectExpr("doc_id", "text", "_metadata.file_name AS file", "_metadata.row_index AS place")
        order = ("file", "place")
    except AnalysisException:
        order = ("doc_id",)
    return tokens.encode(docs, tokenizer_path=tokenizer_path(), order=order)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", token_files),
]

#: SQL can't express the stages (learned rules, minimum hashes, tokenizer); tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, f) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        f(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
