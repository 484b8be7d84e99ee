"""Secret scan: fixed patterns plus a log-likelihood ratio of two character Markov models, with DataFrame functions only.

Tokens of 16 and more characters with a letter are the candidates. The values that the fixed patterns find are the
labelled random strings, candidates outside such values the labelled ordinary identifiers. First-order character
models of both classes are counted over all documents; a candidate whose mean log-likelihood ratio exceeds the
threshold is a further span of kind `markov`, unless it overlaps a span of the fixed patterns.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import literal_doubles, outside, packed, regex_spans, unpacked

# The base patterns and their least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = r"""[A-Za-z0-9+/_.=-]+\z"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the same as AKIA[A-Z0-9]+ of 20 characters and more: both take the whole run
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"  # likewise; a run is entered at its start only
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: Characters of the models; others never stand in a candidate.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Mean log-likelihood ratio (nats a transition) beyond which a candidate counts as random.
THRESHOLD = 0.7


def scan(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, assign, access, hex, cand): the kept columns of docs as a struct and the matches of each whole text, as
    array<struct<s,e,m>>. Candidates overlap no base span. A null or empty text has no matches.

    A caller that fits and finds on the same documents writes this table once, without the text.
    """
    value = "regexp_extract(x.m, r'" + ASSIGN.replace("'", "\\x27") + "', 2)"
    a = packed(docs, keep).select(
        "row",
        "t",
        F.expr(f"filter({regex_spans('t', ASSIGN)}, x -> length({value}) >= 6)").alias("assign"),
        F.expr(regex_spans("t", ACCESS)).alias("access"),
        F.expr(regex_spans("t", HEX)).alias("hex"),
    )
    words = f"filter({regex_spans('t', CANDIDATE)}, x -> x.m rlike '[A-Za-z]')"
    clear = outside("c.w", "c.b", "string")
    return a.select("row", "assign", "access", "hex", F.expr(f"transform(array(struct({words} AS w, concat(assign, access, hex) AS b)), c -> {clear})[0]").alias("cand"))


def _codes(x: str) -> str:
    """SQL: the places of a token's characters in the alphabet, -1 for others. The token is read once, whatever its length."""
    place = [-1] * 128
    for k, c in enumerate(ALPHABET):
        place[ord(c)] = k
    index = "cast(split('" + ",".join(map(str, place)) + "', ',') as array<int>)"
    return f"transform(split({x}, ''), c -> element_at({index}, ascii(c) + 1))"


def _score(x: str, ratios: list[float]) -> str:
    """SQL: the mean log-likelihood ratio of a token's transitions."""
    table = literal_doubles(ratios)
    total = f"aggregate(sequence(0, size(q) - 2), 0D, (a, i) -> a + element_at({table}, q[i] * {len(ALPHABET)} + q[i + 1] + 1)) / (size(q) - 1)"
    return f"transform(array({_codes(x)}), q -> {total})[0]"


def fit(docs: DataFrame, *, scanned: DataFrame | None = None, threshold: float = THRESHOLD) -> list[float]:
    """Log-likelihood ratio of each pair of characters, random over ordinary, as a square table in alphabet order.

    Counts over all documents; the driver gets one row for each pair and class (9,000 at most). Rare pairs are drawn
    towards the second character's share. The ordinary class is counted twice: the second time without the candidates
    that the first table takes for random, as secrets without a label stand among them. Without any labelled token the
    table is zero. scanned: scan() of the same documents, if it is there already.
    """
    n = len(ALPHABET)
    zero = [0.0] * (n * n)
    a = scan(docs, ()) if scanned is None else scanned
    value = "regexp_extract(x.m, r'" + ASSIGN.replace("'", "\\x27") + "', 2)"
    random = _pairs(a, f"concat(transform(assign, x -> {value}), transform(concat(access, hex), x -> x.m))")
    ordinary = _pairs(a, "transform(cand, x -> x.m)")
    if not sum(random) and not sum(ordinary):
        return zero
    table = [math.log(p / q) for p, q in zip(_smoothed(random, n), _smoothed(ordinary, n), strict=True)]
    kept = _pairs(a, f"transform(filter(cand, x -> {_score('x.m', table)} <= {threshold}D), x -> x.m)")
    return [math.log(p / q) for p, q in zip(_smoothed(random, n), _smoothed(kept, n), strict=True)]


def _pairs(scanned: DataFrame, tokens: str) -> list[float]:
    """How often each pair of characters stands in the tokens, in alphabet order."""
    n = len(ALPHABET)
    # outer, as a filter inferred for an inner generator would compute the list a second time
    own = scanned.selectExpr(f"explode_outer({tokens}) AS v").where("length(v) >= 2")
    pairs = own.selectExpr(f"explode_outer(transform(array({_codes('v')}), q -> transform(sequence(0, size(q) - 2), i -> CASE WHEN q[i] >= 0 AND q[i + 1] >= 0 THEN q[i] * {n} + q[i + 1] END))[0]) AS p")
    counts = [0.0] * (n * n)
    for r in pairs.where("p IS NOT NULL").groupBy("p").count().collect():
        counts[r["p"]] += r["count"]
    return counts


def _smoothed(pairs: list[float], n: int, weight: float = 5.0) -> list[float]:
    """P(b | a), drawn towards P(b), which is drawn towards 1 / n."""
    single = [sum(pairs[j::n]) for j in range(n)]
    total = sum(single)
    p = [(x + 0.5) / (total + 0.5 * n) for x in single]
    row = [sum(pairs[i * n : i * n + n]) for i in range(n)]
    return [(pairs[k] + weight * p[k % n]) / (row[k // n] + weight) for k in range(n * n)]


def find(docs: DataFrame, ratios: list[float], *, threshold: float = THRESHOLD, scanned: DataFrame | None = None) -> DataFrame:
    """docs with __secrets: array<struct<s,rank,kind,e,m,score>> by start, then kind as listed; no shuffle.

    Positions are code points, ends exclusive. Every base span stays; markov spans never overlap them. Texts are
    scanned whole; a null or empty text has no spans. Rows are independent, so ties and repeated rows keep their own.
    A column of docs named __secrets gives way. scanned: scan() of the same documents, whose kept columns then come out.
    """
    a = scan(docs) if scanned is None else scanned
    part = lambda col, rank, kind: f"transform({col}, x -> struct(x.s AS s, {rank} AS rank, '{kind}' AS kind, x.e AS e, x.m AS m, cast(null as double) AS score))"
    found = f"filter(transform(cand, x -> struct(x.s AS s, 3 AS rank, 'markov' AS kind, x.e AS e, x.m AS m, {_score('x.m', ratios)} AS score)), x -> x.score > {threshold}D)"
    return unpacked(a, __secrets=F.expr(f"array_sort(concat({part('assign', 0, 'assign')}, {part('access', 1, 'access')}, {part('hex', 2, 'hex')}, {found}))"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the hash of the base spans and all spans as text: a row for each of find()'s.

    A row without spans has zeros, the hash of the empty text and an empty text; a null doc_id stays null.
    """
    text = lambda l: f"array_join(transform({l}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(__secrets, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]],
        F.expr(f"sha2({text('filter(__secrets, x -> x.rank < 3)')}, 256)").alias("base_sha256"),
        F.expr(text("__secrets")).alias("spans"),
        F.expr("cast(size(filter(__secrets, x -> x.kind = 'markov')) as bigint)").alias("n_markov"),
    )


def masked(found: DataFrame, fill: str = "[SECRET]") -> DataFrame:
    """The texts with every span replaced; overlapping spans are replaced as one. Other columns stay, null texts stay null."""
    own = [c for c in found.columns if c != "__secrets"]
    step = "named_struct('out', CASE WHEN x.s >= a.at THEN concat(a.out, substring(coalesce(text, ''), a.at + 1, x.s - a.at), '" + fill + "') ELSE a.out END, 'at', greatest(a.at, x.e))"
    body = f"aggregate(__secrets, named_struct('out', '', 'at', 0), (a, x) -> {step}, a -> concat(a.out, substring(text, a.at + 1)))"
    return found.select(*[F.expr(body).alias("text") if c == "text" else F.col(c) for c in own])
