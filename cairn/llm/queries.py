"""The operators' queries over the tables of a folder, and SQL for what SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, mixing, neardup, negatives, pages, pii, quality_cnn, quality_rules, ranked, secrets, tokens, toxicity
from .common import held_out, stored
from .sql import ORACLE  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; a null text or one without a letter is `und` with score 0, see langid.predict()."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    a = langid.predict(docs, langid.fit(docs))
    return a.select("doc_id", held_out().alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"), F.col("__rejected").alias("rejected"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its block, slot, release and deadline under square-root weights."""
    docs = _table(spark, sf_dir, "documents")
    own = {f"__{k}": k for k in ("block", "slot", "release", "deadline", "in_block")}
    return mixing.schedule(docs, keep=("doc_id", "source")).select("doc_id", "source", *[F.col(a).alias(b) for a, b in own.items()])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; null and empty texts have a score like others, see toxicity.score()."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    a = toxicity.score(docs, toxicity.fit(docs, labels))
    return a.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), F.col("__predicted").alias("predicted"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets; null and empty texts have none, see secrets.find() for repeated rows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = stored(secrets.scan(docs, ("doc_id",)), "secrets")
    return secrets.digest(secrets.find(docs, secrets.fit(docs, scanned=scanned), scanned=scanned))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data; null and empty texts have none, see pii.find() for repeated rows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = stored(pii.scan(docs, ("doc_id",)), "personal")
    return pii.digest(pii.find(docs, pii.disclosing(docs, scanned=scanned), scanned=scanned))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and verdict; null and empty texts have no words and fail, see quality_rules.verdicts()."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    counted = stored(quality_rules.with_counts(docs).drop("text"), "counts")  # read for each condition of the list, and judged
    a = quality_rules.judged(counted, quality_rules.fit(docs, labels, counted=counted))
    return a.select("doc_id", *[F.col(f"__{k}").alias(k) for k in quality_rules.COUNTS], F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files; a null text has its end id only, see tokens.encode()."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.encode(docs, tokenizer_path=tokenizer_path())


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies and its number of links."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.classes_of(docs).select("doc_id", "class_id", "n_links", "n_copies")


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that leaked into it."""
    docs, bench = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    a = decontam.search(docs, decontam.fit(docs, bench))
    return a.selectExpr("doc_id", "inline(__leaks)")


def op10_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; null and empty texts have a score like others, see quality_cnn.score()."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    a = quality_cnn.score(docs, quality_cnn.fit(docs, labels))
    return a.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item; see ranked.build() and search() for nulls, ties and repeated rows."""
    docs, bench = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark").select("item_id", "text")
    return ranked.top_documents(docs, bench).select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three hard negatives for each anchor and positive; see negatives.mine() for nulls, ties and repeated rows."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), anchors=F.col("vec_id") % 50 == 0)


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text; null and empty pages have an empty one; see pages.extract()."""
    return pages.extract(_table(spark, sf_dir, "pages"), keep=("page_id", "url")).select("page_id", "url", F.col("__text").alias("text"), F.col("__n_chars").alias("n_chars"))


def tokenizer_path() -> str:
    """The vocabulary of the token files, from the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


QUERIES = {f.__name__: f for f in (op1_langid, op2_mixing, op3_toxicity, op4_secrets, op5_pii, op6_quality_rules, op7_token_files, op8_ngram_jaccard, op9_decontam, op10_quality_cnn, op11_ranked_search, op12_hard_negatives, op13_page_text)}
