"""Exact nearest vectors from blocks around pivots: what a bound excludes isn't read.

Vectors lie in blocks, each of the vectors nearest to one pivot, of a bounded number of rows. A block keeps its pivot and
its radius, the greatest distance of a vector from the pivot; for a question q no product in it exceeds
q . pivot + |q| * radius. The blocks of the greatest bounds are read first; those whose bound is below the k-th product
found there are never read. Any pivots give right results; near ones give small radii. They are means of a bounded sample.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import Files, kept_folder
from ..session import stored
from .search import dot

#: Rows of a block, about; pivots at most; vectors that pivots are fitted on, about; and rounds of the fit.
BLOCK_ROWS, PIVOTS, SAMPLE_ROWS, ROUNDS = 4096, 1024, 20_000, 6
#: Share by which bounds are widened for rounding.
_SLACK = 1e-9


@dataclasses.dataclass
class PivotIndex:
    """vectors: (id, pos, embedding, block); blocks: (block, n, radius, centre)."""

    vectors: DataFrame
    blocks: DataFrame


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Lists of numbers as rows, missing places and nulls 0."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = np.asarray(lists.value_lengths()).astype(np.int64)
    out = np.zeros((len(lists), dim))
    out[np.arange(dim) < size[:, None]] = np.nan_to_num(np.asarray(lists.flatten().cast(pa.float64()).fill_null(0.0)))
    return out


def fit(vectors: DataFrame, n: int, dim: int, rows: int = BLOCK_ROWS) -> np.ndarray:
    """Pivots: about one for each `rows` vectors, means of what is nearest to them in a sample by hash."""
    count = max(1, min(PIVOTS, -(-n // rows)))
    share = max(1, n // max(SAMPLE_ROWS, count))
    sample = vectors.where(F.pmod(F.xxhash64("id", F.lit("pivots")), F.lit(share)) == 0).orderBy(F.xxhash64("id"), "pos").limit(2 * max(SAMPLE_ROWS, count)).select("embedding").toArrow()["embedding"]
    x = _matrix(sample, dim)
    if not len(x):
        return np.zeros((1, dim))
    pivots = x[: min(count, len(x))].copy()
    for _ in range(ROUNDS):
        nearest = _nearest(x, pivots)[0]
        total = np.zeros_like(pivots)
        np.add.at(total, nearest, x)
        many = np.bincount(nearest, minlength=len(pivots))
        pivots[many > 0] = total[many > 0] / many[many > 0, None]
    return pivots


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row, and the distance to it, which is exact for the pivot that is given."""
    at = ((pivots**2).sum(1) - 2 * x @ pivots.T).argmin(1)
    return at, np.sqrt(((x - pivots[at]) ** 2).sum(1))


def write(vectors: DataFrame, path: str, *, rows: int = BLOCK_ROWS) -> dict:
    """Writes the index of vectors (id, pos, embedding) below path; returns its counts. A null vector isn't in it.

    However many vectors are nearest to one pivot (equal ones, say), its blocks have about `rows` each.
    """
    spark, own = vectors.sparkSession, vectors.where("embedding IS NOT NULL").select("id", "pos", "embedding")
    size = own.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("d")).collect()[0]
    dim = max(1, size["d"])
    pivots = fit(own, size["n"], dim, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, far = _nearest(_matrix(b.column(2), dim), pivots)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32)), pa.array(far)], [*b.schema.names, "pivot", "far"])

    placed = stored(own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("far", T.DoubleType())])), "placed")
    parts = placed.groupBy("pivot").agg(F.ceil(F.count("*") / rows).cast("int").alias("parts"))  # PIVOTS rows at most
    centres = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(pivots)], "pivot int, centre array<double>")
    dealt = placed.join(F.broadcast(parts), "pivot").withColumn("block", F.col("pivot").cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("id", "pos"), F.col("parts")))
    dealt.repartitionByRange("block").sortWithinPartitions("block").select("id", "pos", "embedding", "block", "pivot", "far").write.parquet(f"{path}/vectors")
    blocks = spark.read.parquet(f"{path}/vectors").groupBy("block", "pivot").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
    blocks.join(F.broadcast(centres), "pivot").drop("pivot").write.parquet(f"{path}/blocks")
    return {"vectors": size["n"], "dimensions": size["d"]}


def opened(spark: SparkSession, path: str) -> PivotIndex:
    return PivotIndex(spark.read.parquet(f"{path}/vectors").drop("pivot", "far"), spark.read.parquet(f"{path}/blocks"))


def kept(vectors: DataFrame, path: str, *inputs: str, rows: int = BLOCK_ROWS) -> PivotIndex:
    """The index below path, written unless it is there for the inputs as they are now."""
    files = Files(vectors.sparkSession)
    return opened(vectors.sparkSession, kept_folder(files, path, inputs, f"pivots-{rows}", lambda to: files.write_json(f"{to}/config.json", write(vectors, to, rows=rows))))


def top(index: PivotIndex, query: list[float], k: int, log: dict | None = None) -> DataFrame:
    """id, pos, dense_score of the k vectors of the greatest products with the query, ties by pos, as search.dense_top() gives.

    log: gets the numbers of blocks and of those read.
    """
    q, norm = F.array(*[F.lit(float(x)) for x in query]), math.sqrt(sum(float(x) ** 2 for x in query))
    centre, wide = dot(F.col("centre"), q), F.lit(norm) * F.col("radius")
    slack = _SLACK * (F.abs(centre) + wide + norm)
    bounds = stored(index.blocks.select("block", "n", (centre + wide + slack).alias("bound")), "bounds")
    first, held = [], 0
    for r in bounds.orderBy(F.desc("bound"), "block").limit(k).toLocalIterator():  # a block has a vector at least
        first.append(r["block"])
        held += r["n"]
        if held >= k:
            break
    product = dot(F.col("embedding"), q).alias("dense_score")
    best = lambda df: df.orderBy(F.desc("dense_score"), "pos").limit(k)
    found = stored(best(index.vectors.where(F.col("block").isin(first) if first else F.lit(False)).select("id", "pos", product)), "nearest")
    least = found.agg(F.count("*").alias("n"), F.min("dense_score").alias("t")).collect()[0]
    rest = bounds.where(~F.col("block").isin(first) if first else F.lit(True))
    if least["n"] >= k:
        rest = rest.where(F.col("bound") >= least["t"])
    if log is not None:
        log |= {"blocks": bounds.count(), "read": len(first) + rest.count()}
    if rest.isEmpty():
        return best(found)
    more = index.vectors.join(rest.select("block"), "block", "left_semi").select("id", "pos", product)
    return best(found.unionByName(more))
