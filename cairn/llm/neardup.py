"""N-gram Jaccard self-join: a MinHash LSH forest, then exact verification on shingle sets.

Exact copies are first folded into classes, so the join sees each distinct word sequence once. A class's signature gives
TREES labels of PART values, one for each prefix trie of the forest. A trie is its labels in sorted order: the prefix
that a class shares with its neighbours there is the longest that it shares with any class, and classes whose longest
shared prefixes are too short to matter leave the forest at once.

Matched prefixes are then shortened value by value, in all tries together. At each length the pairs that share a prefix
of exactly that length in some trie, and a longer one in none, are candidates; they are links if the Jaccard similarity
of their shingle sets, computed from the texts, reaches the threshold. A link of similarity j is met by length d with
probability p = 1 - (1 - j ** d) ** TREES, so the links found so far, each counted 1 / p times, estimate all links that
there are. Shortening ends when in each band of similarities the found links are the target share of the estimate; a
band without links is judged by its least similarity. At the length of prefix_length() any pair at the threshold is met
with the target probability, so no shorter prefix is ever needed.

Small nodes of a trie give their pairs as rows. Larger nodes are dealt into blocks: each task compares two blocks in
memory by a product of shingle incidences and returns each member's number of links and a spanning forest, so no group
meets in one task and no group's pairs become rows. Classes are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANK, STEP_BYTES, groups_of, lean, mixed, stored, text_buffer, unused, words_of

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9995
TREES, PART = 16, 6
#: Classes of a trie node whose pairs become rows; of larger nodes, classes of a block.
LEAF, BLOCK = 12, 512
#: Shingles that a block's product takes at a time.
COLUMNS = 4096
#: Similarities between the threshold and 1 are counted in so many bins; so many of them form a band that must reach the target.
BINS, BAND = 40, 10

_rng = np.random.default_rng(11)
_MULTIPLY = _rng.integers(1, 1 << 63, TREES * PART, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def met(similarity: float, depth: int, trees: int = TREES) -> float:
    """The probability that a pair of that similarity shares a prefix of `depth` values in some trie."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_length(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES) -> int:
    """The longest prefix with which a pair at the threshold meets in some trie with the target recall; 1 at least."""
    d = PART
    while d > 1 and met(similarity, d, trees) < recall:
        d -= 1
    return d


def measured_recall(found: np.ndarray, depth: int, similarity: float = SIMILARITY, trees: int = TREES) -> float:
    """The least recall of a band of similarities at that prefix length.

    found: links by bin of similarity. A link is counted 1 / met() times in the estimate of all links, with the least
    similarity of its bin; a band without links has the recall of its least similarity.
    """
    edges = [similarity + (1 - similarity) * k / BINS for k in range(BINS)]
    p = np.array([met(j, depth, trees) for j in edges])
    out = []
    for k in range(0, BINS, BAND):
        n = found[k : k + BAND]
        out.append(n.sum() / (n / p[k : k + BAND]).sum() if n.sum() else p[k])
    return float(min(out))


def shingles_of(h: np.ndarray, first: np.ndarray, count: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all word n-grams of consecutive texts; a text of fewer words has one shingle of all of them.

    h: word hashes; first, count: each text's part. Returns shingles, and each text's first shingle and their number.
    """
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(len(count), np.int64), np.zeros(len(count), np.int64)
    pad = np.concatenate([h, np.zeros(words, np.uint64)])
    g = np.zeros(len(h), np.uint64)
    length = np.repeat(count, count)
    inside = np.arange(len(h)) - np.repeat(first, count)
    for k in range(words):
        part = pad[k : k + len(h)]
        g = mixed(g + np.uint64(k + 1)) ^ np.where(inside + k < length, part, np.uint64(0)) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
    ok = inside <= np.maximum(length - words, 0)
    n = np.where(count > 0, np.maximum(1, count - words + 1), 0)
    return mixed(g[ok]), np.concatenate([[0], np.cumsum(n)[:-1]]), n


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, word hashes, first word, words) of texts i to j. One text is always whole."""
    raw, starts, ends = text_buffer(column)
    blank = np.full(1, 32, np.uint8)
    for i, j in groups_of(starts, ends, STEP_BYTES // 2, 1024):
        parts = []
        for k in range(i, j):
            parts += [raw[starts[k] : ends[k]], blank]
        sizes = ends[i:j] - starts[i:j] + 1
        s, _, h = words_of(np.concatenate(parts))
        first = np.searchsorted(s, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        count = np.diff(np.concatenate([first, [len(s)]]))
        yield i, j, h, first, count


def node_keys(h: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[bytes | None]:
    """A 128-bit key of each text's word sequence; None without a word."""
    out: list[bytes | None] = [None] * len(count)
    some = np.flatnonzero(count)
    if len(some):
        place = (np.arange(len(h)) - np.repeat(first, count)).astype(np.uint64) + np.uint64(1)
        salts = (0x51ED270B * 0x9E3779B9 | 1, 0x2545F491 * 0x9E3779B9 | 1)
        pair = np.stack([np.add.reduceat(mixed(h + place * np.uint64(salt)), first[some]) for salt in salts], axis=1)
        for k, d in enumerate(some.tolist()):
            out[d] = pair[k].tobytes()
    return out


def _key(c: str = "doc_id"):
    """An id as text; no id has the text of a null one."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))


def features(docs: DataFrame, *, words: int = WORDS) -> DataFrame:
    """(doc_id, hash, node, sig) of each row: hash of the text; node (16 bytes) is equal for equal word sequences, null
    without a word; sig is the MinHash of the shingles, null likewise. Rows of equal id and hash are equal texts."""
    own = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    schema = T.StructType([*own.schema.fields[:2], T.StructField("node", T.BinaryType()), T.StructField("sig", T.BinaryType())])

    @lean("neardup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes: list[bytes | None] = []
            sigs: list[bytes | None] = []
            for i, j, h, first, count in _texts(b.column(2)):
                g, at, n = shingles_of(h, first, count, words)
                some = np.flatnonzero(n)
                sig = np.zeros((len(_MULTIPLY), len(some)), np.uint32)
                if len(some):
                    for k, m in enumerate(_MULTIPLY):
                        sig[k] = np.minimum.reduceat(((g * m) >> np.uint64(32)).astype(np.uint32), at[some])
                sig = np.ascontiguousarray(sig.T)
                nodes += node_keys(h, first, count)
                held: dict[int, int] = {int(d): k for k, d in enumerate(some)}
                sigs += [sig[held[d]].tobytes() if d in held else None for d in range(j - i)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())], schema.names)

    return own.mapInArrow(run, schema)


def tries(classes: DataFrame, least: int) -> DataFrame:
    """(node, t, label, shared): the tries as sorted labels; shared is the longest prefix, in values, that a label has in
    common with another one of its trie. Labels that share fewer than `least` values are left out.

    Ranges of labels are parted anywhere, also inside a group of equal ones, so no group meets in one task; at the ends
    of a range, where one neighbour is unknown, the whole label counts as shared, which loses nothing.
    """
    rows = classes.selectExpr("node", f"posexplode(transform(sequence(0, {TREES - 1}), t -> substring(sig, t * {PART * 4} + 1, {PART * 4}))) AS (t, label)")
    rows = rows.repartitionByRange("t", "label", "node").sortWithinPartitions("t", "label", "node")
    width = PART * 4

    @lean("neardup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(b: pa.RecordBatch, shared: np.ndarray) -> pa.RecordBatch:
            ok = np.flatnonzero(shared >= least)
            got = b.take(pa.array(ok))
            return pa.RecordBatch.from_arrays([*got.columns, pa.array(shared[ok].astype(np.int32))], ["node", "t", "label", "shared"])

        last: pa.RecordBatch | None = None  # the row whose right neighbour isn't known yet
        before = PART
        for b in batches:
            if not b.num_rows:
                continue
            if last is not None:
                b = pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0]
            label = b.column(2)
            raw = np.frombuffer(label.buffers()[2], np.uint8)
            at = np.frombuffer(label.buffers()[1], np.int32)[label.offset]
            values = raw[at : at + width * len(label)].reshape(len(label), PART, 4)
            t = np.asarray(b.column(1))
            same = (values[1:] == values[:-1]).all(axis=2) & (t[1:] == t[:-1])[:, None]
            right = np.logical_and.accumulate(same, axis=1).sum(axis=1)
            left = np.concatenate([[before], right])
            if len(label) > 1:
                yield done(b.slice(0, len(label) - 1), np.maximum(left[:-1], right))
            last, before = b.slice(len(label) - 1, 1), int(left[-1])
        if last is not None:
            yield done(last, np.array([PART]))

    return rows.mapInArrow(run, "node binary, t int, label binary, shared int")


def nodes_of(forest: DataFrame, depth: int) -> DataFrame:
    """(node, t, p, n): the trie nodes with company at that depth, p: hash of trie and prefix, n: classes below it.

    Nodes with only one child are left out, as in a path-compressed trie: all their classes share a longer prefix.
    """
    rows = forest.where(F.col("shared") >= depth).selectExpr("node", "t", f"xxhash64(t, substring(label, 1, {4 * depth})) AS p", f"substring(label, {4 * depth + 1}, 4) AS next")
    company = rows.groupBy("p").agg(F.count("*").alias("n"), F.min("next").alias("lo"), F.max("next").alias("hi")).where("n >= 2" if depth == PART else "lo < hi")
    return rows.join(company, "p").select("node", "t", "p", "n")


def pairs_of(nodes: DataFrame, leaf: int) -> DataFrame:
    """(a, b), a < b: distinct pairs below small nodes, at most leaf * (leaf - 1) / 2 of a node."""
    one = nodes.where(F.col("n") <= leaf).select("node", "p")
    two = one.select(F.col("node").alias("other"), "p")
    return one.join(two, "p").where("node < other").selectExpr("node AS a", "other AS b").distinct()


def _bin(jaccard, similarity: float):
    """The bin of a similarity; above the threshold by a rounding error is still inside the first or last."""
    return np.clip(((np.asarray(jaccard) - similarity) / max(1e-9, 1 - similarity) * BINS).astype(np.int64), 0, BINS - 1)


def block_links(nodes: DataFrame, sets: DataFrame, depth: int, *, leaf: int = LEAF, block: int = BLOCK, similarity: float = SIMILARITY) -> DataFrame:
    """(node, n, root, bin) of large nodes, compared block by block: links of a member and a member they lead to; rows
    with a null node have the number of links of a bin.

    A member goes to one task for each block of its trie node. Pairs that also share a small node are left to
    pairs_of(), pairs that share a longer prefix were met before; of several large nodes that a pair shares, the one of
    the first trie counts it. nodes: see nodes_of(); sets: see shingle_sets(). No large node, or no row, gives no row.
    """
    large = nodes.where(F.col("n") > leaf)
    # of every class with a large node: in which tries its node is large
    big = F.expr(f"transform(sequence(0, {TREES - 1}), t -> array_contains(m, t))")
    own = large.groupBy("node").agg(F.collect_set("t").alias("m")).select("node", big.alias("big")).join(sets, "node")
    dealt = large.withColumns({"nb": F.ceil(F.col("n") / block).cast("int"), "h": F.xxhash64("node", F.lit(9))}).withColumn("k", F.expr("cast(pmod(h, nb) as int)"))
    dealt = dealt.selectExpr("node", "t", "p", "k", "explode(sequence(0, nb - 1)) AS x").selectExpr("node", "t", "p", "k", "least(k, x) AS i", "greatest(k, x) AS j")
    rows = dealt.join(own, "node")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        t, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        table = table.combine_chunks()
        ids = table.column("node").to_pylist()
        side = np.asarray(table.column("k"))
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        empty = pa.table({"node": pa.array([], pa.binary()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.binary()), "bin": pa.array([], pa.int32())})
        if not len(left) or not len(right) or table.num_rows < 2:
            return empty
        big = table.column("big").chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), TREES)
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(ids), TREES, PART)
        todo = np.ones((len(left), len(right)), bool)
        if i == j:
            todo &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
        for other in range(TREES):
            share = np.ones(todo.shape, bool)
            for v in range(depth):
                share &= sig[left, other, v][:, None] == sig[right, other, v][None, :]
            if depth < PART:
                todo &= ~(share & (sig[left, other, depth][:, None] == sig[right, other, depth][None, :]))
            if other != t:
                todo &= ~(share if other < t else share & ~big[left, other][:, None])
        use_l, use_r = todo.any(axis=1), todo.any(axis=0)
        left, right, todo = left[use_l], right[use_r], todo[np.ix_(use_l, use_r)]
        if not len(left):
            return empty
        lists = table.column("s").chunk(0)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy(zero_copy_only=False)
        size = np.diff(offsets)
        common = _common([flat[offsets[k] : offsets[k + 1]] for k in left], [flat[offsets[k] : offsets[k + 1]] for k in right])
        total = size[left][:, None] + size[right][None, :]
        linked = todo & (common >= similarity * (total - common))
        a, b = np.nonzero(linked)
        if not len(a):
            return empty
        x, y = left[a], right[b]
        bins = np.bincount(_bin(common[a, b] / (total[a, b] - common[a, b]), similarity), minlength=BINS)
        count = np.bincount(x, minlength=len(ids)) + np.bincount(y, minlength=len(ids))
        root = np.arange(len(ids))
        while True:  # least member reached, by pointer jumping
            low = np.minimum(root[x], root[y])
            new = root.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        at, full = np.flatnonzero(count), np.flatnonzero(bins)
        return pa.table(
            {
                "node": pa.array([*(ids[k] for k in at), *[None] * len(full)], pa.binary()),
                "n": pa.array([*count[at].tolist(), *bins[full].tolist()], pa.int64()),
                "root": pa.array([*(ids[root[k]] for k in at), *[None] * len(full)], pa.binary()),
                "bin": pa.array([*[None] * len(at), *full.tolist()], pa.int32()),
            }
        )

    return rows.groupBy("t", "p", "i", "j").applyInArrow(compare, "node binary, n bigint, root binary, bin int")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, from the shingles that both sides hold, COLUMNS at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    if not len(both):
        return out

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.concatenate(sets)
        col = np.minimum(np.searchsorted(both, at), len(both) - 1)
        ok = both[col] == at
        order = np.argsort(col[ok], kind="stable")
        return rows[ok][order], col[ok][order]

    (ra, ca), (rb, cb) = places(left), places(right)
    for k in range(0, len(both), COLUMNS):
        x, y = np.zeros((len(left), COLUMNS), np.float32), np.zeros((len(right), COLUMNS), np.float32)
        for m, r, c in ((x, ra, ca), (y, rb, cb)):
            lo, hi = np.searchsorted(c, [k, k + COLUMNS])
            m[r[lo:hi], c[lo:hi] - k] = 1
        out += x @ y.T
    return out


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, sig, s): sorted distinct shingle hashes of the wanted classes.

    wanted: (node, doc_id, hash, sig), id and hash of a row that has the text. Rows are sought by both, so that ids that
    are null or repeated don't multiply; of equal rows one is read. Classes whose row is missing give none.
    """
    own = docs.select(_key().alias("k"), F.xxhash64("text").alias("hash"), "text").join(wanted.select(_key().alias("k"), "hash", "node", "sig"), ["k", "hash"])
    own = own.select("node", "sig", "text").dropDuplicates(["node"])

    @lean("neardup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, h, first, count in _texts(b.column(2)):
                g, at, n = shingles_of(h, first, count, words)
                out = [np.unique(g[a : a + m]).view(np.int64) for a, m in zip(at.tolist(), n.tolist(), strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out)))], ["node", "sig", "s"])

    return own.mapInArrow(run, "node binary, sig binary, s array<bigint>")


def verified(edges: DataFrame, sets: DataFrame, depth: int = PART, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, jaccard) of the pairs whose shingle sets reach the similarity and that share no prefix longer than `depth`.

    Pairs with a longer shared prefix were compared before. A pair of which one set is missing, or null, isn't a link.
    """
    cols = lambda own, x: sets.select(F.col("node").alias(own), F.col("s").alias(f"s{x}"), F.col("sig").alias(f"g{x}"))
    both = edges.join(cols("b", "b"), "b").join(cols("a", "a"), "a")
    if depth < PART:
        part = lambda x: f"substring({x}, t * {PART * 4} + 1, {4 * (depth + 1)})"
        both = both.where(f"NOT exists(sequence(0, {TREES - 1}), t -> {part('ga')} = {part('gb')})")
    both = both.where(F.least(F.size("sa"), F.size("sb")) >= similarity * F.greatest(F.size("sa"), F.size("sb")))
    common = F.size(F.array_intersect("sa", "sb"))
    out = both.select("a", "b", (common / (F.size("sa") + F.size("sb") - common)).alias("jaccard"))
    return out.where(F.col("jaccard") >= similarity)


def components(edges: DataFrame) -> DataFrame:
    """(u, root) by alternating large-star and small-star rounds over (u, v) edges until nothing changes.

    u and v may have any type that can be ordered. Each round's state goes to the shared folder. Edges to itself, nulls
    and repeated edges add nothing; no edges give no rows.
    """
    e = stored(edges.where("u != v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "stars")
    mark = None
    while True:
        both = e.unionByName(e.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v")
        large = large.where("u != v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e2 = large.join(small, "u").where("v != m").selectExpr("v AS u", "m AS v").unionByName(small.selectExpr("u", "m AS v"))
        e = stored(e2.where("u != v").distinct(), "stars")
        now = tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).collect()[0])
        if now == mark:
            return e.selectExpr("u", "v AS root")
        mark = now


def classes_of(docs: DataFrame, *, similarity: float = SIMILARITY, recall: float = RECALL, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """doc_id, hash, node, class_id, n_links, n_copies, class_root: one row for each row of docs.

    class_id is the least doc_id of the class, n_links the verified links of the row's text to different texts,
    n_copies the rows with the same words. Words are blank-separated and compared as they are. A text of fewer than
    five words is one shingle. A null text or one without words is a class of its own without links (n_copies 1). A
    class whose ids are all null has the class_id null. An empty table gives no rows.
    """
    feats = stored(features(docs), "minhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("x")
    reps = feats.where("node IS NOT NULL").groupBy("node").agg(first, F.count("*").alias("n_copies"), F.first("sig").alias("sig"))
    reps = stored(reps.select("node", F.col("x.doc_id").alias("rep"), F.col("x.hash").alias("hash"), "n_copies", "sig"), "classes")
    least = prefix_length(similarity, recall)
    forest = stored(tries(reps.select("node", "sig"), least), "forest")
    wanted = forest.select("node").distinct().join(reps, "node")
    sets = stored(shingle_sets(docs, wanted.select("node", F.col("rep").alias("doc_id"), "hash", "sig")), "shingles")
    found, links, blocks = np.zeros(BINS), [], []
    for depth in range(PART, least - 1, -1):
        nodes = stored(nodes_of(forest, depth), "nodes")
        links.append(stored(verified(pairs_of(nodes, leaf), sets, depth, similarity), "links"))
        blocks.append(stored(block_links(nodes, sets, depth, leaf=leaf, block=block, similarity=similarity), "blocks"))
        step = f"least({BINS - 1}, greatest(0, cast((jaccard - {similarity}) / {max(1e-9, 1 - similarity)} * {BINS} as int)))"
        counted = links[-1].selectExpr(f"{step} AS bin", "1L AS n").unionByName(blocks[-1].where("node IS NULL").select("bin", "n"))
        for r in counted.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # BINS rows at most
            found[r["bin"]] += r["n"]
        if measured_recall(found, depth, similarity) >= recall:
            break
    pairs, spans = links[0].select("a", "b"), blocks[0].where("node IS NOT NULL")
    for x, y in zip(links[1:], blocks[1:], strict=True):
        pairs, spans = pairs.unionByName(x.select("a", "b")), spans.unionByName(y.where("node IS NOT NULL"))
    degree = pairs.selectExpr("explode(array(a, b)) AS node", "1L AS n").unionByName(spans.select("node", "n")).groupBy("node").agg(F.sum("n").alias("n_links"))
    root = components(pairs.selectExpr("a AS u", "b AS v").unionByName(spans.selectExpr("node AS u", "root AS v")))
    own = reps.select("node", "rep", "n_copies").join(root.withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = own.groupBy("root").agg(F.min("rep").alias("class_id"))
    info = own.join(smallest, "root").join(degree, "node", "left").select("node", "class_id", "root", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    out = feats.select("doc_id", "hash", "node").join(info, "node", "left")
    lone = F.col("node").isNull()
    return out.select("doc_id", "hash", "node", F.when(lone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"), F.col("root").alias("class_root"))


def one_of_each(docs: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the least doc_id, with the columns of docs.

    Rows without a word all stay. A null id counts as the greatest. Of rows with equal id and text one stays, any of
    them if other columns differ. An empty table gives no rows.
    """
    got = stored(classes_of(docs, similarity=similarity), "members")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("x")
    winners = got.where("node IS NOT NULL").groupBy("class_root").agg(best)
    k, h, row = unused(docs, "k", "h", "row")
    winners = winners.select(_key("x.doc_id").alias(k), F.col("x.hash").alias(h))
    wordless = F.col("text").isNull() | ~F.col("text").rlike(BLANK.replace("[", "[^"))
    tagged = docs.where(~wordless).withColumns({k: _key(), h: F.xxhash64("text")})
    chosen = tagged.join(winners, [k, h], "left_semi")
    if not got.where("node IS NOT NULL").groupBy("doc_id", "hash").count().where("count > 1").isEmpty():
        chosen = chosen.withColumn(row, F.struct(*docs.columns)).groupBy(k, h).agg(F.first(row).alias(row)).select(f"{row}.*")
    return chosen.select(*docs.columns).unionByName(docs.where(wordless))
