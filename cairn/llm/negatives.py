"""Hard-negative mining: exact inner products, found through an orthogonal rotation to principal components.

Components are scaled to integers, so that products are exact. Vectors are rotated to the principal axes of a sample; a
rotation keeps inner products, whatever it was fitted on. For a block of anchors and a block of rows, the products of the
leading components are accumulated step by step. What the other components can add is at most the product of the residual
norms (plus a slack for rounding), so a pair whose bounds can't reach a place among the best is discarded early;
the pairs that survive are verified with integer products of whole vectors.

Rows of equal label and vector form a class; as they tie in all products, a class keeps its MEMBERS first rows by id, the
most that any list can take. Classes of anchors meet classes of rows in a grid of blocks of bounded size, each one task's
work; each block sends the few best rows of its anchors, of which windows take the best of all blocks. The anchors are a
stated share of the rows, so the grid's work grows with rows times anchors; nothing is broadcast but the rotation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, stored

#: Positives of an anchor, negatives of a positive, and the share of the positive's score that a negative has, in percent.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Rows of a class that some list can hold: the positives and the anchor itself.
MEMBERS = POSITIVES + 1
#: Classes of anchors and of rows that meet in one task, about.
ANCHOR_BLOCK, ROW_BLOCK = 4096, 8192
#: Anchors that are compared with a block of rows at a time.
_STEP = 128
#: Share of the pairs at which those left are looked at one by one.
_FEW = 0.2
#: Numbers of the sampled vectors that the rotation is fitted on, about.
FIT_NUMBERS = 1_000_000
#: Scaled components are below this, so that products of 512 components and more fit into 64 bits.
MOST = 1 << 27
#: Share of the norms' product that rounding of rotated products stays far below (some 10^-13 for 1000 components).
SLACK = 1e-9
_NO_ID = "9223372036854775807L"


def scaled(vectors: DataFrame, anchors: Column) -> DataFrame:
    """(id, label, v, anchor) of the rows that take part: floor(256 x) of each component.

    A null label or vector, a null or non-finite component, or one of 2^19 and more keeps a row out. A null id comes last
    among ties; missing components of shorter vectors count 0.
    """
    fits = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < MOST / 256), F.lit(False))
    rows = vectors.select(F.coalesce("vec_id", F.expr(_NO_ID)).alias("id"), "label", "embedding", F.coalesce(anchors, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fits))
    return rows.select("id", F.col("label").cast("long").alias("label"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("int")).alias("v"), "anchor")


def rotation(classes: DataFrame, n: int, dim: int) -> np.ndarray:
    """Principal axes (columns, greatest first) of a share of the classes that is sampled by hash."""
    rows = max(1, FIT_NUMBERS // max(1, dim))
    sample = classes.where(F.pmod(F.xxhash64("cls", F.lit("fit")), F.lit(max(1, n // rows))) == 0).select("v").limit(2 * rows).toArrow()["v"]
    x = matrix(sample, dim).astype(np.float64)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()


def matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    """The lists as rows of a matrix, shorter ones filled with 0."""
    lists = lists.combine_chunks()
    size = np.asarray(lists.value_lengths()).astype(np.int64)
    out = np.zeros((len(lists), dim), np.int64)
    out[np.arange(dim) < size[:, None]] = np.asarray(lists.flatten())
    return out


class Pairs:
    """Products of anchors and rows, accumulated over rotated components, leading ones first, with bounds of what is left."""

    def __init__(self, a: np.ndarray, b: np.ndarray, axes: np.ndarray):
        self.a, self.b, self.dim = a, b, len(axes)
        self.ra, self.rb = a @ axes, b @ axes
        self.steps = sorted({-(-self.dim * k // 8) for k in (2, 4, 6, 7, 8)})
        self.na, self.nb = (self._norms(x) for x in (self.ra, self.rb))

    def _norms(self, r: np.ndarray) -> dict[int, np.ndarray]:
        """Norms of what is left after each step; at 0 the whole norms."""
        return {k: np.sqrt((r[:, k:] ** 2).sum(1)) for k in (0, *self.steps)}

    def bounds(self, i: np.ndarray, j: np.ndarray):
        """(lower, upper, last) bounds of the products of anchors i and rows j after each step whose bounds can tell pairs apart."""
        part, before = np.zeros((len(i), len(j))), 0
        for k in self.steps:
            part += self.ra[i, before:k] @ self.rb[j, before:k].T
            before = k
            left = np.median(self.na[k][i]) * np.median(self.nb[k][j])
            if k < self.dim and left > part[:8].std():
                continue  # the residual is wider than the products differ
            off = np.outer(self.na[k][i], self.nb[k][j]) + SLACK * np.outer(self.na[0][i], self.nb[0][j]) + SLACK
            yield part - off, part + off, k == self.dim

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.a[i], self.b[j])


def _kth(low: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest of each row; -inf if there are fewer."""
    return np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(low), -np.inf)


def best_same(pairs: Pairs, la: np.ndarray, lb: np.ndarray, count: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row class, score) of all pairs of one label that can be among an anchor's MEMBERS best in this block.

    count: gets the number of pairs whose whole products are made.
    """
    out = []
    for label in np.unique(la):
        own, rows = np.flatnonzero(la == label), np.flatnonzero(lb == label)
        for s in range(0, len(own), _STEP) if len(rows) else ():
            i = own[s : s + _STEP]
            for lower, upper, last in pairs.bounds(i, rows):
                need = upper >= _kth(lower, MEMBERS)[:, None]
                if last or need.mean() < _FEW:
                    break
            x, y = np.nonzero(need)
            out.append(_verified(pairs, i[x], rows[y], count))
    return _joined(out)


def best_other(pairs: Pairs, la: np.ndarray, lb: np.ndarray, scores: np.ndarray, count: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row class, score) of all pairs of two labels that can be among the NEGATIVES best for some positive.

    scores: an anchor's positive scores, a row each, filled up by the last.
    """
    out, low, high = [], -(-LOW * scores // 100), HIGH * scores // 100
    rows = np.arange(len(lb))
    for s in range(0, len(la), _STEP):
        i = np.arange(s, min(len(la), s + _STEP))
        other = la[i][:, None] != lb[None, :]
        for lower, upper, last in pairs.bounds(i, rows):
            near = (upper >= low[i].min(1)[:, None]) & (lower <= high[i].max(1)[:, None]) & other
            if last or near.mean() < _FEW:
                break
        x, y = np.nonzero(near)
        lo, up = lower[x, y], upper[x, y]
        order = np.lexsort((-lo, x))
        x, y, lo, up = x[order], y[order], lo[order], up[order]
        begin = np.searchsorted(x, np.arange(len(i)))
        need = np.zeros(len(x), bool)
        for k in range(scores.shape[1]):
            a, b = low[i, k], high[i, k]
            sure = (lo >= a[x]) & (up <= b[x])
            before = np.concatenate(([0], np.cumsum(sure)))
            third = np.flatnonzero(sure & (before[1:] - before[begin[x]] == NEGATIVES))  # of the pairs surely in range
            least = a.astype(np.float64)
            least[x[third]] = np.maximum(least[x[third]], lo[third])
            need |= (up >= least[x]) & (lo <= b[x]) & (a <= b)[x]
        out.append(_verified(pairs, i[x[need]], rows[y[need]], count))
    return _joined(out)


def _verified(pairs: Pairs, i: np.ndarray, j: np.ndarray, count: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs with their integer products, a bounded number at a time."""
    count[0] += len(i)
    each = [pairs.exact(i[s : s + (1 << 15)], j[s : s + (1 << 15)]) for s in range(0, len(i), 1 << 15)]
    return i, j, np.concatenate([np.zeros(0, np.int64), *each])


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    z = np.zeros(0, np.int64)
    return tuple(np.concatenate([z, *[p[k] for p in parts]]) for k in range(3))


def _expanded(found: tuple, ids: pa.Array, groups: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, id, row, score): the classes' members, of each group of pairs the `most` best by score, id and row."""
    i, j, score = found
    size = np.asarray(ids.value_lengths()).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(size)))
    flat = ids.flatten()
    each = np.repeat(np.arange(len(i)), size[j])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(size[j]) - size[j], size[j])
    member = at[j[each]] + nth
    own, row = np.asarray(flat.field(0))[member], np.asarray(flat.field(1))[member]
    group = groups[each]
    order = np.lexsort((row, own, -score[each], group))
    g = group[order]
    first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(first, np.diff(np.concatenate((first, [len(g)]))))
    keep = order[place < most]
    return each[keep], own[keep], row[keep], score[each][keep]


def _grid(classes: DataFrame, anchors: DataFrame, n: int, n_anchors: int, run, schema: str) -> DataFrame:
    """run(anchors, rows) of each pair of blocks: (anchors: cls, label, v, scores; rows: label, v, ids)."""
    a, r = -(-n_anchors // ANCHOR_BLOCK), -(-n // ROW_BLOCK)
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(max(1, k) - 1)))
    block = lambda k: F.pmod(F.xxhash64("cls"), F.lit(max(1, k))).cast("int")
    left = anchors.select(block(a).alias("a"), every(r).alias("r"), "cls", "label", "v", "scores")
    right = classes.select(every(a).alias("a"), block(r).alias("r"), "label", "v", "ids")
    return left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInArrow(run, schema)


def mine(vectors: DataFrame, anchors: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among the rows.

    vectors: vec_id, label, embedding. Every row is one of its own, also if its id repeats; ties come by id, null last,
    then by the row's place. An anchor without a positive, or a positive without a negative, has no rows. See scaled()
    for rows that take no part.
    """
    rows = stored(scaled(vectors, anchors).withColumn("h", F.xxhash64("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    same = ("label", "h", "v")
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy("id", "row"))).where(F.col("nth") <= MEMBERS)
    classes = first.groupBy(*same).agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("ids"))  # MEMBERS at most
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    asked = stored(rows.where("anchor").select("id", "row", *same).join(classes.select("cls", *same), list(same)).select("cls", "id", "row"), "anchors")
    own = stored(classes.join(asked.select("cls").distinct(), "cls", "left_semi"), "anchor-classes")
    size = classes.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("d")).collect()[0]
    n, dim, n_anchors = size["n"], max(1, size["d"]), own.count()
    axes = rotation(classes, n, dim)

    def blocks(left: pa.Table, right: pa.Table) -> tuple[Pairs, np.ndarray, np.ndarray]:
        pairs = Pairs(matrix(left["v"], dim), matrix(right["v"], dim), axes)
        return pairs, np.asarray(left["label"].combine_chunks()), np.asarray(right["label"].combine_chunks())

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found = best_same(*blocks(left, right), [0]) if len(left) and len(right) else _joined([])
        each, ids, row, score = _expanded(found, right["ids"].combine_chunks(), found[0], MEMBERS)
        give_back()
        return pa.table({"cls": left["cls"].combine_chunks().take(pa.array(found[0][each])), "id": ids, "row": row, "score": score})

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        scores = matrix(left["scores"], MEMBERS)
        have = np.asarray(left["scores"].combine_chunks().value_lengths()).astype(np.int64)
        scores = scores[np.arange(len(scores))[:, None], np.minimum(np.arange(MEMBERS), have[:, None] - 1)] if len(scores) else scores
        found = best_other(*blocks(left, right), scores, [0]) if len(left) and len(right) else _joined([])
        out = []
        for k in range(MEMBERS):  # a pair counts for each positive whose range holds its score
            ps = scores[found[0], k]
            fit = (k < have[found[0]]) & (LOW * ps <= 100 * found[2]) & (100 * found[2] <= HIGH * ps)
            part = tuple(x[fit] for x in found)
            each, ids, row, score = _expanded(part, right["ids"].combine_chunks(), part[0], NEGATIVES)
            out.append(pa.table({"cls": left["cls"].combine_chunks().take(pa.array(part[0][each])), "positive_score": scores[part[0][each], k], "negative_id": ids, "row": row, "negative_score": score}))
        give_back()
        return pa.concat_tables(out)

    none = own.withColumn("scores", F.expr("cast(array() AS array<bigint>)"))
    top = _grid(classes, none, n, n_anchors, positives, "cls bigint, id bigint, row bigint, score bigint")
    by = Window.partitionBy("cls").orderBy(F.desc("score"), "id", "row")
    top = stored(top.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= MEMBERS), "positives")
    bands = top.groupBy("cls").agg(F.array_sort(F.collect_set("score")).alias("scores"))
    hard = _grid(classes, own.join(bands, "cls"), n, n_anchors, negatives, "cls bigint, positive_score bigint, negative_id bigint, row bigint, negative_score bigint")
    by = Window.partitionBy("cls", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "row")
    hard = stored(hard.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= NEGATIVES).drop("row"), "negatives")
    pairs = asked.select("cls", F.col("id").alias("anchor_id"), F.col("row").alias("own")).join(top.select("cls", F.col("id").alias("positive_id"), "row", F.col("score").alias("positive_score")), "cls").where("own <> row")
    by = Window.partitionBy("own").orderBy(F.desc("positive_score"), "positive_id", "row")
    pairs = pairs.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= POSITIVES)
    known = lambda c: F.nullif(F.col(c), F.expr(_NO_ID)).alias(c)
    return pairs.join(hard, ["cls", "positive_score"]).select(known("anchor_id"), known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")
