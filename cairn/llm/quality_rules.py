"""Quality rules: text statistics in Column form and a learned decision list over them.

Main path: DataFrame functions only. The list is fitted by sequential covering on the statistics of all labelled documents
outside the held-out third: Spark sorts and counts every value of every statistic for each condition, and the driver
gets one row for it. The list comes back as one ordered CASE expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, held_out, labelled, packed, stored, unpacked

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that conditions may use: SQL over the counts.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
}


def with_counts(docs: DataFrame) -> DataFrame:
    """docs with the base counts and helper counts of each whole text, as columns with prefix __; columns of docs with
    their names give way.

    A null text has no words. Lines are split at U+000A; a line counts as a duplicate if it has a word and equals an
    earlier line. Repeated words are those inside a 5-word window that occurs twice or more, first ones included: the
    hashes of all windows are compared, and only texts with a repeated hash take the sorting branch. The hash is
    xxhash64 of the windows' word hashes (64 bits): the longest texts have some 10^5 windows, so that two different
    windows of one text agree with a chance under 10^-9.
    """
    a = packed(docs).withColumns({"w": F.expr(f"filter(split(t, r'{BLANK}+', -1), w -> w != '')"), "l": F.expr("filter(split(t, '\\n', -1), l -> l rlike r'[^\\x20\\x09-\\x0D]')")})
    a = a.withColumn("h", F.expr("transform(w, w -> xxhash64(w))"))
    grams = "transform(sequence(0, size(h) - 5), i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4]))"
    a = a.withColumn("g", F.expr(f"CASE WHEN size(h) >= 5 THEN {grams} ELSE cast(array() as array<bigint>) END"))
    # positions sorted by window hash; a position repeats if a neighbour has the same hash
    order = "sort_array(transform(g, (h, i) -> struct(h AS h, i AS i)))"
    marked = "zip_with(zip_with(o, concat(array(cast(null as struct<h:bigint,i:int>)), slice(o, 1, size(o) - 1)), (c, p) -> struct(c.i AS i, c.h AS h, coalesce(c.h = p.h, false) AS m)), concat(slice(o, 2, size(o) - 1), array(cast(null as struct<h:bigint,i:int>))), (c, n) -> CASE WHEN c.m OR coalesce(c.h = n.h, false) THEN c.i END)"
    places = f"transform(array({order}), o -> sort_array(filter({marked}, i -> i IS NOT NULL)))[0]"
    covered = f"aggregate({places}, named_struct('n', 0L, 'to', 0), (a, i) -> named_struct('n', a.n + i + 5 - greatest(i, a.to), 'to', i + 5), a -> a.n)"
    return unpacked(
        a,
        __n_words=F.expr("cast(size(w) as bigint)"),
        __word_chars=F.expr("aggregate(w, 0L, (a, w) -> a + length(w))"),
        __n_symbols=F.expr("cast(length(t) - length(regexp_replace(t, r'[#*$%&|<>]+', '')) as bigint)"),
        __n_dup_lines=F.expr("cast(size(l) - size(array_distinct(l)) as bigint)"),
        __n_repeat_words=F.expr(f"CASE WHEN size(g) > size(array_distinct(g)) THEN {covered} ELSE 0L END"),
        __n_lines=F.expr("cast(size(l) as bigint)"),
        __n_upper=F.expr("cast(length(t) - length(regexp_replace(t, r'\\p{Lu}+', '')) as bigint)"),
        __n_marks=F.expr("cast(length(t) - length(regexp_replace(t, r'[!?;:]+', '')) as bigint)"),
        __n_distinct=F.expr("cast(size(array_distinct(h)) as bigint)"),
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, '<=' or '>', threshold) that rejects (or keeps) what it covers."""

    conditions: tuple[tuple[str, str, float], ...]
    reject: bool = True


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules and the verdict of the rows that none covers."""

    rules: tuple[Rule, ...] = ()
    default_kept: bool = True
    features: dict = field(default_factory=lambda: dict(FEATURES))

    def expression(self) -> Column:
        """The list as CASE WHEN ... over the columns of with_counts(): true keeps."""
        out = F.lit(self.default_kept)
        for r in reversed(self.rules):
            c = F.lit(True)
            for name, sign, cut in r.conditions:
                x = F.expr(_prefixed(self.features[name]))
                c = c & ((x <= F.lit(cut)) if sign == "<=" else (x > F.lit(cut)))
            out = F.when(c, F.lit(not r.reject)).otherwise(out)
        return out

    def __str__(self) -> str:
        lines = ["IF " + " AND ".join(f"{n} {s} {c:.4g}" for n, s, c in r.conditions) + (" THEN reject" if r.reject else " THEN keep") for r in self.rules]
        return "\n".join([*lines, "ELSE " + ("keep" if self.default_kept else "reject")])


def _prefixed(sql: str) -> str:
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_distinct"):
        sql = sql.replace(name, "__" + name)
    return sql


def learn(rows: list[tuple[tuple[float, ...], int]], names: tuple[str, ...], *, fold=None, **limits) -> DecisionList:
    """The list that covering() learns from (statistics, label) rows in memory.

    fold: which rows prune, every third one by default. With no labelled rows, or only one class, the list is empty and
    keeps everything.
    """
    return covering(_Rows(rows, names, fold), **limits) if rows else DecisionList()


def covering(table: _Rows | _Table, *, max_rules: int = 8, max_conditions: int = 3, min_cover: int = 5, min_precision: float = 0.9) -> DecisionList:
    """Sequential covering (grow on two thirds, prune on one third) of the rejected class (label 0).

    Growing adds the threshold with the best gain of information; pruning removes last conditions while the precision
    on the other third doesn't fall. A rule of less than min_precision or min_cover ends the covering. Ties take the
    first feature, `<=` before `>`, and the lowest threshold.
    """
    rules: list[Rule] = []
    left = table.counts(rules, [])[0]
    while len(rules) < max_rules and left[0][0] + left[1][0] >= min_cover:
        conditions, (p, n) = [], left[0]
        while len(conditions) < max_conditions and 0 < p < n:
            found = table.split(rules, conditions, p, n)
            if found is None:
                break
            condition, p, n = found
            conditions.append(condition)
        if not conditions:
            break
        got = table.counts(rules, conditions)
        score = lambda m: _precision(*got[m][1]) if got[m][1][1] else _precision(*got[m][0]) - 1e-3  # noqa: E731, B023
        while len(conditions) > 1 and score(len(conditions) - 1) >= score(len(conditions)):
            conditions.pop()
        grown, pruned = got[len(conditions)]
        p, n = grown[0] + pruned[0], grown[1] + pruned[1]
        if n < min_cover or _precision(p, n) < min_precision:
            break
        rules.append(Rule(tuple(conditions)))
        left = tuple((a - c, b - d) for (a, b), (c, d) in zip(left, (grown, pruned), strict=True))
    return DecisionList(tuple(rules))


def _precision(p: int, n: int) -> float:
    return (p + 1) / (n + 2) if n else 0.0


class _Rows:
    """Labelled statistics in memory; see _Table for the methods."""

    def __init__(self, rows: list[tuple[tuple[float, ...], int]], names: tuple[str, ...], fold=None):
        import numpy as np

        self.names = names
        self.x, self.y = np.array([r[0] for r in rows], float), np.array([1 - r[1] for r in rows], bool)  # y: to be rejected
        self.fold = np.arange(len(rows)) % 3 == 2 if fold is None else np.array(fold, bool)

    def _covered(self, conditions):
        import numpy as np

        out = np.ones(len(self.x), bool)
        for name, sign, cut in conditions:
            x = self.x[:, self.names.index(name)]
            out &= (x <= cut) if sign == "<=" else (x > cut)
        return out

    def _left(self, rules):
        import numpy as np

        out = np.ones(len(self.x), bool)
        for r in rules:
            out &= ~self._covered(r.conditions)
        return out

    def counts(self, rules, conditions):
        left, out = self._left(rules), []
        for m in range(len(conditions) + 1):
            own = left & self._covered(conditions[:m])
            out.append(tuple((int(self.y[own & f].sum()), int((own & f).sum())) for f in (~self.fold, self.fold)))
        return out

    def split(self, rules, conditions, p0, n0):
        import math

        import numpy as np

        inside = self._left(rules) & ~self.fold & self._covered(conditions)
        base, best = math.log2(p0 / n0), (1e-12, None)
        for k, name in enumerate(self.names):
            v = self.x[inside, k]
            at = np.argsort(v, kind="stable")
            sv, sy = v[at], self.y[inside][at]
            ends = np.flatnonzero(sv[1:] > sv[:-1])
            if not len(ends):
                continue
            p, n = np.cumsum(sy)[ends], ends + 1
            for sign, pos, tot in (("<=", p, n), (">", p0 - p, n0 - n)):
                gain = np.round(np.where(pos > 0, pos * (np.log2(np.maximum(pos, 1e-9) / tot) - base), -1), 9)
                j = int(np.argmax(gain))
                if gain[j] > best[0]:
                    low, high = float(sv[ends[j]]), float(sv[ends[j] + 1])
                    best = (gain[j], ((name, sign, low if (low + high) / 2 >= high else (low + high) / 2), int(pos[j]), int(tot[j])))
        return best[1]


class _Table:
    """Labelled statistics as a DataFrame of any size: bad (0 or 1), fold (true: prunes) and the named doubles.

    No row is left out and none comes to the driver, which gets counts and one row for each condition.
    """

    def __init__(self, rows: DataFrame, names: tuple[str, ...]):
        self.rows, self.names = rows, names

    @staticmethod
    def _covered(conditions) -> Column:
        out = F.lit(True)
        for name, sign, cut in conditions:
            out = out & ((F.col(name) <= F.lit(cut)) if sign == "<=" else (F.col(name) > F.lit(cut)))
        return out

    def _left(self, rules) -> DataFrame:
        out = self.rows
        for r in rules:
            out = out.where(~self._covered(r.conditions))
        return out

    def counts(self, rules, conditions):
        """For no condition, the first one, the first two and so on: (bad rows, rows) that they cover of those that grow and of those that prune."""
        asked = [(self._covered(conditions[:m]) & f) for m in range(len(conditions) + 1) for f in (~F.col("fold"), F.col("fold"))]
        sums = [F.coalesce(F.sum(F.when(c, x)), F.lit(0)).cast("bigint") for c in asked for x in (F.col("bad"), F.lit(1))]
        got = self._left(rules).agg(*[x.alias(f"c{k}") for k, x in enumerate(sums)]).collect()[0]
        return [((got[k], got[k + 1]), (got[k + 2], got[k + 3])) for k in range(0, len(sums), 4)]

    def split(self, rules, conditions, p0, n0):
        """((name, sign, cut), bad rows, rows) of the condition with the best gain on the n0 growing rows, p0 of them bad, that
        the rules leave and the conditions cover; None without any gain.

        Every value that a row has is tried: the values' counts are summed up in order, inside ranges of values and over
        the ranges, of which there are some thousand at most however many rows there are.
        """
        inside = self._left(rules).where(~F.col("fold") & self._covered(conditions))
        values = inside.select("bad", F.posexplode(F.array(*self.names)).alias("k", "v")).groupBy("k", "v").agg(F.sum("bad").alias("p"), F.count("*").alias("n"))
        values = values.withColumn("b", F.floor(F.signum("v") * F.log2(1 + F.abs("v") * 4096) * 64))
        along = Window.partitionBy("k").orderBy("b")
        before = lambda c: F.coalesce(F.sum(c).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranges = values.groupBy("k", "b").agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.min("v").alias("low"))
        ranges = ranges.select("k", "b", before("p").alias("bp"), before("n").alias("bn"), F.lead("low").over(along).alias("after"))
        own = Window.partitionBy("k", "b").orderBy("v")
        upto = lambda c: F.sum(c).over(own.rowsBetween(Window.unboundedPreceding, 0))
        ends = values.join(F.broadcast(ranges), ["k", "b"]).select("k", "v", (upto("p") + F.col("bp")).alias("p"), (upto("n") + F.col("bn")).alias("n"), F.coalesce(F.lead("v").over(own), "after").alias("high"))
        both = F.array(F.struct(F.lit(0).alias("s"), F.col("p"), F.col("n")), F.struct(F.lit(1).alias("s"), (p0 - F.col("p")).alias("p"), (n0 - F.col("n")).alias("n")))
        sides = ends.where("high IS NOT NULL").select("k", "v", "high", F.explode(both).alias("x")).where("x.p > 0")
        gain = F.round(F.col("x.p") * (F.log2(F.col("x.p") / F.col("x.n")) - F.log2(F.lit(p0 / n0))), 9)
        best = sides.withColumn("gain", gain).agg(F.min(F.struct((-F.col("gain")).alias("less"), "k", "x.s", "v", "high", "x.p", "x.n")).alias("x")).collect()[0]["x"]
        if best is None or -best["less"] <= 1e-12:
            return None
        cut = (best["v"] + best["high"]) / 2
        return (self.names[best["k"]], "<=" if best["s"] == 0 else ">", best["v"] if cut >= best["high"] else cut), best["p"], best["n"]


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", counted: DataFrame | None = None) -> DecisionList:
    """A decision list from the statistics of all labelled documents outside the held-out third.

    counted: docs with the counts of with_counts(), if they are there already. A third of the ids by hash prunes. Of rows
    with one id the one with the least statistics counts. Without labelled documents, or with only one class, the list is
    empty and keeps everything.
    """
    own = (docs.select("doc_id", "text") if counted is None else counted).where(~held_out()).join(labelled(labels, label), "doc_id")
    own = with_counts(own) if counted is None else own
    own = own.select("doc_id", "y", F.struct(*[F.expr(_prefixed(s)).cast("double").alias(k) for k, s in FEATURES.items()]).alias("x")).groupBy("doc_id").agg(F.min("x").alias("x"), F.max("y").alias("y"))
    rows = stored(own.select((1 - F.col("y")).alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 2).alias("fold"), "x.*"), "statistics")
    return covering(_Table(rows, tuple(FEATURES)))


def judged(counted: DataFrame, rules: DecisionList) -> DataFrame:
    """counted, which has the counts of with_counts(), with __base_failed and __kept; see verdicts()."""
    a = counted.withColumn("__base_failed", F.expr("__n_words < 10 OR 100 * __n_repeat_words > 20 * __n_words"))
    return a.withColumn("__kept", F.when(F.col("__base_failed"), F.lit(False)).otherwise(rules.expression()))


def verdicts(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """docs with the counts of with_counts(), __base_failed and __kept (never null); no shuffle. Columns of docs with those
    names give way. A null or empty text fails the base rules; repeated rows get equal verdicts."""
    return judged(with_counts(docs), rules)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns: a filter that neither reorders nor repeats rows.

    Null and empty texts go; repeated rows stay or go together; labels that are null, or of unknown ids, teach nothing.
    """
    own = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    # a filter on the verdict itself would be pushed below the projections that compute it and repeat their expressions
    a = verdicts(own, fit(own, labels)).select("row", F.explode_outer(F.array("__kept")).alias("stays"))
    return a.where("stays").select("row.*")
