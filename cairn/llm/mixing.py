"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source is cut into blocks. Block j of a source with weight w may not begin before slot floor(j / w) and must end
by slot ceil((j + 1) / w), with w the exact target. The driver places every block, earliest deadline first, in a table
of one row a block, so no task ever walks the schedule. In every prefix of slots each source is less than one block from
its share until it runs out; then its slots stay empty, which keeps the ratio of the others.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import unpacked

#: Rows of a block at least, and blocks at most (about): larger tables have larger blocks, so that the driver can place all.
BLOCK_ROWS, MOST_BLOCKS = 64, 1_000_000
#: Rows that are ranked together, about, and such ranges of rows that are summed together.
RANK_ROWS, RANGES = 1000, 1000
#: Bits of the hash that orders the rows of a source.
_BITS = 60


def targets(weights: dict[str | None, float]) -> dict[str | None, Fraction]:
    """Shares that sum to 1, exact for the weights as they are written in decimals; weights that aren't positive are left out."""
    own = {k: Fraction(w) if isinstance(w, int) else Fraction(repr(float(w))) for k, w in weights.items() if w and w > 0}
    total = sum(own.values())
    return {k: w / total for k, w in own.items()}


def placed(blocks: dict[str | None, int], shares: dict[str | None, Fraction]) -> list[tuple[str | None, int, int, int, int]]:
    """(source, j, slot, release, deadline) of every block: at each slot the released block with the earliest deadline.

    Ties go to the smaller window and then to the name, a null one first. Feasible since the shares sum to 1 and blocks
    that a source lacks only free slots. Slots that nothing can fill are skipped, so the time grows with the blocks,
    however small a share is.
    """
    out, ready, waiting, t = [], [], [], 0
    key = lambda name: (name is not None, name or "")
    for name in shares:
        if blocks.get(name):
            heapq.heappush(waiting, (0, key(name), 0, name))
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            r, k, j, name = heapq.heappop(waiting)
            d = -(-(j + 1) * shares[name].denominator // shares[name].numerator)
            heapq.heappush(ready, (d, d - r, k, j, r, name))
        d, _, k, j, r, name = heapq.heappop(ready)
        out.append((name, j, t, r, d))
        t += 1
        if j + 1 < blocks[name]:
            heapq.heappush(waiting, ((j + 1) * shares[name].denominator // shares[name].numerator, k, j + 1, name))
    return out


def root_weights(counts: dict[str | None, int]) -> dict[str | None, int]:
    """Target weights in proportion to the square root of the counts, to six decimals: small sources gain, large ones lose."""
    return {k: math.isqrt(n * 10**12) for k, n in counts.items()}


def schedule(docs: DataFrame, weights: dict[str | None, float] | None = None, *, block_rows: int = BLOCK_ROWS, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The kept columns of docs (all by default) with __block, __slot, __release, __deadline (bigint), __in_block (int).

    Every row stays; columns of docs with those names give way. weights: target by source; None takes root_weights().
    A source without a weight comes after all slots of the others, in blocks of its own; its release and deadline are
    null. A null source is a source. Rows of a source are in order of the first 60 bits of the MD5 of doc_id and text (a
    null is empty), then doc_id, nulls first, then the hash of the text; rows that agree in all of them in any order. An
    empty table gives no rows.

    Nothing depends on a source's rows meeting in one task, nor those of an id that repeats or is null: rows are ranked
    inside ranges of the hash, and the ranges' counts are summed in two steps. The driver holds a count for each source,
    whose number must be small enough for it, and five numbers for each of about MOST_BLOCKS blocks and one a source.
    """
    spark = docs.sparkSession
    totals = {r["source"]: r["n"] for r in docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n")).collect()}
    own = root_weights(totals) if weights is None else {k: w for k, w in weights.items() if k in totals}
    names = sorted(totals, key=lambda k: (k is not None, k or ""))
    size = max(block_rows, -(-sum(totals.values()) // MOST_BLOCKS))
    blocks = placed({k: -(-n // size) for k, n in totals.items()}, targets(own))
    code = {k: i for i, k in enumerate(names)}
    table = pa.table({"name": pa.array(names, pa.string()), "code": pa.array(range(len(names)), pa.int64()), "ranges": pa.array([1 + totals[k] // RANK_ROWS for k in names], pa.int64())})
    columns = zip(*[(code[k], *x) for k, *x in blocks], strict=True) if blocks else [()] * 5
    at = spark.createDataFrame(pa.table({k: pa.array(x, pa.int64()) for k, x in zip(("c", "b", "slot", "release", "deadline"), columns, strict=True)}))

    text, doc_id = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(F.concat(doc_id, F.lit(":"), text).cast("binary")), 1, _BITS // 4), 16, 10).cast("bigint")
    a = docs.select(F.struct(*([F.col("`" + c.replace("`", "``") + "`") for c in docs.columns] if keep is None else keep)).alias("row"), F.col("source").cast("string").alias("source"), F.col("doc_id").alias("id"), h.alias("h"), F.xxhash64("text").alias("th"))
    # one row for each source, of which the driver already has the counts
    a = a.join(F.broadcast(spark.createDataFrame(table)), F.col("source").eqNullSafe(F.col("name"))).drop("source", "name")
    a = a.withColumn("r", F.expr(f"h div ({1 << _BITS} div ranges + 1)"))  # ranges in order of the hash
    counts = a.groupBy("code", "r").agg(F.count("*").alias("n")).withColumn("s", F.expr(f"r div {RANGES}"))
    earlier = (Window.unboundedPreceding, -1)
    sums = counts.groupBy("code", "s").agg(F.sum("n").alias("m")).select("code", "s", F.coalesce(F.sum("m").over(Window.partitionBy("code").orderBy("s").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("code", "s").orderBy("r").rowsBetween(*earlier)), F.lit(0))
    offsets = counts.withColumn("inside", inside).join(sums, ["code", "s"]).select("code", "r", (F.col("base") + F.col("inside")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("code", "r").orderBy("h", "id", "th")).cast("bigint") - 1
    small = sum(1 + n // RANK_ROWS for n in totals.values()) <= 100_000
    a = a.withColumn("rank", rank).join(F.broadcast(offsets) if small else offsets, ["code", "r"])
    a = a.withColumn("nth", F.col("rank") + F.col("before")).withColumn("block", F.expr(f"nth div {size}"))
    a = a.join(F.broadcast(at) if len(blocks) <= 100_000 else at, (F.col("code") == F.col("c")) & (F.col("block") == F.col("b")), "left")
    last = 1 + max((t for _, _, t, _, _ in blocks), default=-1)
    return unpacked(a, __block=F.col("block"), __slot=F.expr(f"coalesce(slot, {last}L + block)"), __release=F.col("release"), __deadline=F.col("deadline"), __in_block=F.expr(f"cast(nth % {size} as int)"))


def mixed_order(docs: DataFrame, weights: dict[str | None, float] | None = None, **kw) -> DataFrame:
    """All rows of docs with their own columns, range-partitioned and sorted by slot: written files follow the mix.

    Nulls, ties, repeated rows and empty tables as in schedule().
    """
    own = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.col("source").cast("string").alias("source"))
    a = schedule(own, weights, keep=("row", "source"), **kw)
    return a.repartitionByRange("__slot", "source", "__in_block").sortWithinPartitions("__slot", "source", "__in_block").select("row.*")
