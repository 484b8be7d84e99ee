"""Hybrid retrieval: exact cosine and BM25 over a lexical index, fused by reciprocal ranks, at most a few chunks a document.

Ranking orders only what survives a top-k, so nothing is sorted as a whole: Spark keeps k rows of each partition and
merges them. The fused lists have a fixed number of rows (dense max(50, 5 k), lexical 100).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_year, folded, index_tokens, search_terms
from ..session import stored

K1, B, LEXICAL_ROWS, RRF_K = 1.2, 0.75, 100, 60
# The texts of the prompt.
INSTRUCTIONS = (
    "Answer the historical question using only the evidence below. Cite claims with [S1], [S2], etc. "
    "Distinguish contemporaneous evidence from recollection, report disagreement, and say when the "
    "evidence is insufficient. Answer in the language of the question and do not generalize from a small sample."
)
DETAILS = ("Country: ", " | Language: ", " | Content mode: ", " | Document ID: ")
WARNING = "\nMACHINE TRANSLATION: verify wording and quotations against native document "


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; null if either is null, missing places count 0."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda t, x: t + x)


def eligible(source: str = "", date_from: int | None = None, date_to: int | None = None) -> Column:
    """Rows of a source and of a range of years, both ends included; a row of unknown year stays."""
    year = first_year(F.coalesce(F.col("date"), F.lit("")))
    out = F.lit(True)
    if source:
        out = out & (F.col("source") == source)
    if date_from is not None:
        out = out & F.coalesce(year >= date_from, F.lit(True))
    if date_to is not None:
        out = out & F.coalesce(year <= date_to, F.lit(True))
    return out


def dense_top(vectors: DataFrame, query: list[float], k: int, *, key: str = "id", pos: str = "pos", vector: str = "embedding") -> DataFrame:
    """The k rows of the largest inner product with the query: key, pos, dense_score, rank (from 1). Ties by pos."""
    q = F.array(*[F.lit(float(x)) for x in query])
    top = vectors.select(key, pos, dot(F.col(vector), q).alias("dense_score")).orderBy(F.desc("dense_score"), pos).limit(k)
    # one task numbers k rows, a number that doesn't grow with the data
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("dense_score"), pos)))


def token_runs(chunks: DataFrame) -> DataFrame:
    """(id, pos, length, runs): the tokens of text, title and their search terms, counted: array<struct<term, tf>> by term.

    Counts are made inside each row, so they need no shuffle. A chunk without a token has no runs.
    """
    both = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")))
    tokens = F.concat(index_tokens(F.coalesce("text", F.lit(""))), index_tokens(F.coalesce("title", F.lit(""))), index_tokens(F.array_join(search_terms(both), " ")))
    a = chunks.select("id", "pos", F.sort_array(tokens).alias("tokens")).withColumn("length", F.size("tokens"))
    # equal tokens stand side by side: where each term begins, and where the next one does
    first = F.filter(F.transform("tokens", lambda t, i: F.when((i == 0) | (t != F.try_element_at(F.col("tokens"), i)), i)), lambda i: i.isNotNull())
    a = a.withColumn("first", first)
    runs = F.transform("first", lambda i, k: F.struct(F.element_at(F.col("tokens"), i + 1).alias("term"), (F.coalesce(F.try_element_at(F.col("first"), k + 2), F.col("length")) - i).alias("tf")))
    return a.select("id", "pos", "length", runs.alias("runs"))


def _equals(term: str):
    return lambda x: x == F.lit(term)


def lexical_scores(chunks: DataFrame, query_terms: list[str]) -> DataFrame:
    """id, pos, bm25 (higher is better) of every chunk that holds a term; see lexical_top()."""
    wanted = [t for t in query_terms if t]
    distinct = sorted(set(wanted))
    both = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")))
    tokens = F.concat(index_tokens(F.coalesce("text", F.lit(""))), index_tokens(F.coalesce("title", F.lit(""))), index_tokens(F.array_join(search_terms(both), " ")))
    a = chunks.select("id", "pos", tokens.alias("tokens"))
    # texts are tokenised once: statistics and scores read the few numbers of each row
    a = stored(a.select("id", "pos", F.size("tokens").alias("length"), *[F.size(F.filter("tokens", _equals(t))).alias(f"f{k}") for k, t in enumerate(distinct)]), "frequencies")
    stats = a.agg(F.count("*").alias("n"), F.avg("length").alias("avg"), *[F.count_if(F.col(f"f{k}") > 0).alias(f"n{k}") for k in range(len(distinct))]).collect()[0]
    return _scored(a, stats["n"], stats["avg"] or 1.0, {t: (f"f{k}", stats[f"n{k}"]) for k, t in enumerate(distinct)}, wanted)


def _scored(a: DataFrame, n: int, avg: float, held: dict[str, tuple[str, int]], wanted: list[str]) -> DataFrame:
    score, some = F.lit(0.0), F.lit(False)
    for t in wanted:
        f, df = F.col(held[t][0]), held[t][1]
        idf = math.log((n - df + 0.5) / (df + 0.5))
        idf = idf if idf > 0 else 1e-6
        score = score + F.lit(idf) * (f * (K1 + 1)) / (f + K1 * (1 - B + B * F.col("length") / avg))
        some = some | (f > 0)
    return a.where(some).select("id", "pos", score.alias("bm25"))


def query_terms(spark, query: str, tokenizer=None) -> list[str]:
    """The folded terms of a question; terms that differ only in case count each, as the index sees them."""
    text = F.lit(query)
    if tokenizer is not None:
        text = F.array_join(tokenizer(text), " ")
    row = spark.range(1).select(F.transform(search_terms(text), folded).alias("t")).collect()[0]
    return list(row["t"])


def lexical_top(chunks: DataFrame, terms: list[str], k: int = LEXICAL_ROWS) -> DataFrame:
    """The best k chunks by BM25 among all, whatever may be eligible later. Ties by pos."""
    return lexical_scores(chunks, terms).orderBy(F.desc("bm25"), "pos").limit(k)


def reciprocal_ranks(rankings: list[DataFrame], key: str = "id", k: int = RRF_K) -> DataFrame:
    """(key, score, seen): sum of 1 / (k + rank) over (key, rank) lists; seen orders ties, earlier lists first."""
    parts = [r.select(key, (1 / (k + F.col("rank"))).alias("part"), (F.lit(i * 1_000_000) + F.col("rank")).alias("at")) for i, r in enumerate(rankings)]
    all_parts = parts[0]
    for p in parts[1:]:
        all_parts = all_parts.unionByName(p)
    return all_parts.groupBy(key).agg(F.sum("part").alias("score"), F.min("at").alias("seen"))


def diversified(fused: DataFrame, top_k: int, per_document: int) -> DataFrame:
    """At most per_document rows of a document, then the best top_k (one at least); (document_id, score, seen) needed."""
    best = Window.partitionBy("document_id").orderBy(F.desc("score"), "seen")
    capped = fused.withColumn("__nth", F.row_number().over(best)).where(F.col("__nth") <= per_document).drop("__nth")
    return capped.orderBy(F.desc("score"), "seen").limit(max(1, top_k))


def search(chunks: DataFrame, vectors: DataFrame, question: str, query_vector: list[float], *, top_k: int = 8, source: str = "", date_from: int | None = None, date_to: int | None = None, per_document: int = 2, tokenizer=None, lexical_index=None) -> DataFrame:
    """Ranked chunks with score and dense_score.

    lexical_index: a BlockIndex of the chunks, of which only the question's terms are read, and of these the blocks that
    can matter; without it every chunk is tokenised.

    chunks: columns of CHUNK with pos, the row number that ties fall back to; vectors: (id, embedding). The dense list
    holds eligible chunks only; the lexical list is cut to 100 before chunks that aren't eligible leave it, and ranks
    are counted anew. The fused rows (150 at most for the default) are joined back to the chunks by a broadcast.
    """
    ok = chunks.where(eligible(source, date_from, date_to))
    q = F.array(*[F.lit(float(x)) for x in query_vector])
    product = dot(F.col("embedding"), q).alias("dense_score")
    dense = vectors.select("id", product).join(ok.select("id", "pos"), "id").orderBy(F.desc("dense_score"), "pos").limit(max(50, 5 * top_k))
    dense = dense.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("dense_score"), "pos")))
    from . import blocks  # it builds on this module

    terms = query_terms(chunks.sparkSession, question, tokenizer)
    hits = lexical_top(chunks, terms) if lexical_index is None else blocks.top(lexical_index, terms)
    lexical = hits.join(ok.select("id"), "id", "left_semi").withColumn("rank", F.row_number().over(Window.orderBy(F.desc("bm25"), "pos")))
    fused = reciprocal_ranks([dense, lexical])
    rows = chunks.join(F.broadcast(fused), "id")
    top = diversified(rows, top_k, per_document)
    last = vectors.join(F.broadcast(top), "id")  # top_k rows
    return last.withColumn("dense_score", product).drop("embedding").orderBy(F.desc("score"), "seen")


def context_prompt(question: str, results: DataFrame) -> DataFrame:
    """One row, one text: instructions, the question and the numbered evidence. results: ordered by score and seen."""
    nth = results.withColumn("__n", F.row_number().over(Window.orderBy(F.desc("score"), "seen")))
    mode = F.coalesce("content_mode", F.lit("native"))
    details = F.concat(F.lit(DETAILS[0]), F.coalesce("country", F.lit("unknown")), F.lit(DETAILS[1]), F.coalesce("language", F.lit("unknown")), F.lit(DETAILS[2]), mode, F.lit(DETAILS[3]), F.coalesce("document_id", F.lit("unknown")))
    native = F.coalesce(F.get_json_object("metadata", "$.translation_provenance.source_document_id"), F.lit("unknown"))
    warning = F.when(mode == "english_translation", F.concat(F.lit(WARNING), native, F.lit("."))).otherwise("")
    date = F.coalesce(F.nullif("date", F.lit("")), F.lit("undated"))
    entry = F.concat(F.lit("[S"), F.col("__n"), F.lit("] "), F.col("title"), F.lit(" ("), date, F.lit(")\n"), details, warning, F.lit("\nURL: "), F.col("url"), F.lit("\n"), F.col("text"))
    listed = nth.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", entry.alias("e")))), lambda x: x["e"]), "\n\n").alias("evidence"))
    return listed.select(F.concat(F.lit(f"{INSTRUCTIONS}\n\nQUESTION:\n{question}\n\nEVIDENCE:\n"), F.col("evidence")).alias("prompt"))
