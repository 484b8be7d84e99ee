"""The lexical index as a table of blocks, and BM25 from the blocks that can matter.

A block holds a term's postings among RANGE neighbouring chunks, with the greatest part of a score that any of them can
get from the term. A question reads these numbers of its terms first, without the postings: for each range of chunks their
sum is a bound of every score in it. The best ranges by bound are scored exactly; what the k-th of their scores exceeds
isn't read. The ranking equals that of scoring every chunk.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files, kept_folder
from ..session import stored
from .search import K1, LEXICAL_ROWS, B, token_runs

#: Chunks of a range, and the ranges that are scored before any bound is known.
RANGE, FIRST_RANGES = 128, 16
#: Bounds and scores are sums of doubles in different orders.
_SLACK = 1e-9


@dataclasses.dataclass
class BlockIndex:
    """blocks: (term, range, n, top, postings); terms: (term, df); lengths: (id, pos, length); n chunks of mean length average."""

    blocks: DataFrame
    terms: DataFrame
    lengths: DataFrame
    n: int
    average: float


def part(tf: Column, length: Column, average: float) -> Column:
    """What a term adds to a score, before its weight."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / (average or 1.0)))


def write(chunks: DataFrame, path: str) -> dict:
    """Writes lengths, blocks and terms of chunks (id, pos, title, text) below path; returns their counts.

    Texts are tokenised once. A block has RANGE postings at most, so no term meets in one task, however common. pos must
    be a number of its own for each chunk.
    """
    spark = chunks.sparkSession
    runs = stored(token_runs(chunks), "runs")
    runs.select("id", "pos", "length").write.parquet(f"{path}/lengths")
    size = spark.read.parquet(f"{path}/lengths").agg(F.count("*").alias("n"), F.count_if(F.col("length") > 0).alias("rows"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).collect()[0]
    average = size["tokens"] / max(1, size["n"])
    each = runs.select("pos", "length", F.explode("runs").alias("x")).select("x.term", F.floor(F.col("pos") / RANGE).alias("range"), F.struct("pos", "x.tf", "length").alias("p"))
    dealt = each.repartitionByRange("term", "range")  # the order of the files, and the grouping that blocks need
    blocks = dealt.groupBy("term", "range").agg(F.count("*").cast("int").alias("n"), F.max(part(F.col("p.tf"), F.col("p.length"), average)).alias("top"), F.sort_array(F.collect_list("p")).alias("postings"))
    blocks.sortWithinPartitions("term", "range").write.parquet(f"{path}/blocks")
    spark.read.parquet(f"{path}/blocks").groupBy("term").agg(F.sum("n").alias("df")).write.parquet(f"{path}/terms")
    return {"lexical_rows": size["rows"], "lexical_chunks": size["n"], "lexical_tokens": size["tokens"]}


def opened(spark: SparkSession, path: str, n: int, tokens: int) -> BlockIndex:
    """The written index at path, of n chunks with so many tokens in all."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return BlockIndex(read("blocks"), read("terms"), read("lengths"), n, tokens / max(1, n))


def kept(chunks: DataFrame, path: str, *inputs: str) -> BlockIndex:
    """The index of chunks below path, written unless it is there for the inputs (files or folders) as they are now."""
    spark = chunks.sparkSession
    files = Files(spark)
    own = kept_folder(files, path, inputs, f"blocks-{RANGE}", lambda to: files.write_json(f"{to}/config.json", write(chunks, to)))
    config = files.read_json(f"{own}/config.json")
    return opened(spark, own, config["lexical_chunks"], config["lexical_tokens"])


def top(index: BlockIndex, terms: list[str], k: int = LEXICAL_ROWS, log: dict | None = None) -> DataFrame:
    """id, pos, bm25 of the best k chunks for a question's terms, by score and pos; a term that repeats counts each time.

    log: gets the postings of the terms and how many of them were scored.
    """
    counts = {t: terms.count(t) for t in set(terms)}
    mine = lambda df: df.where(F.col("term").isin(*counts)) if counts else df.where(F.lit(False))
    df = {r["term"]: r["df"] for r in mine(index.terms).collect()}  # a row a term of the question
    weight = F.lit(0.0)
    for t, d in df.items():
        idf = math.log((index.n - d + 0.5) / (d + 0.5))
        weight = F.when(F.col("term") == t, F.lit((idf if idf > 0 else 1e-6) * counts[t])).otherwise(weight)
    blocks = mine(index.blocks)
    bounds = stored(blocks.select("range", "n", (weight * F.col("top")).alias("most")).groupBy("range").agg(F.sum("most").alias("bound"), F.sum("n").alias("n")), "bounds")
    best = [r["range"] for r in bounds.orderBy(F.desc("bound"), "range").limit(max(FIRST_RANGES, -(-2 * k // RANGE))).collect()]

    def scored(own: DataFrame) -> DataFrame:
        hits = own.select("term", F.explode("postings").alias("p"))
        return hits.groupBy("p.pos").agg(F.sum(weight * part(F.col("p.tf"), F.col("p.length"), index.average)).alias("bm25"))

    first = stored(scored(blocks.where(F.col("range").isin(best) if best else F.lit(False))).orderBy(F.desc("bm25"), "pos").limit(k), "scored")
    least = first.agg(F.count("*").alias("n"), F.min("bm25").alias("t")).collect()[0]
    theta = least["t"] if least["n"] >= k else 0.0
    rest = bounds.where((F.col("bound") * (1 + _SLACK) >= theta) & (~F.col("range").isin(best) if best else F.lit(True)))
    if log is not None:
        log |= {"postings": sum(df.values()), "scored": bounds.where(F.col("range").isin(best)).unionByName(rest).agg(F.sum("n")).first()[0] or 0}
    more = scored(blocks.join(rest.select("range"), "range", "left_semi")) if not rest.isEmpty() else None
    found = (first if more is None else first.unionByName(more)).orderBy(F.desc("bm25"), "pos").limit(k)
    return index.lengths.select("id", "pos").join(F.broadcast(found), "pos").orderBy(F.desc("bm25"), "pos").select("id", "pos", "bm25")
