"""Benchmark decontamination: latent semantic retrieval, then longest-common-subsequence and answer checks.

The benchmark is the stated query set. TF-IDF vectors (document frequencies from every document) of its passages and of
all passages of all documents go through a distributed randomised SVD whose rank is at most half the
number of benchmark passages, so that words which occur together share directions. All windows of all documents are
projected on the right singular vectors and compared with all items by cosine. For each candidate the longest common
subsequence of words between the item and the place in the document decides, with a stricter check that the item's
answer (its last part) is there for paraphrases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import MARKS, STEP_BYTES, give_back, groups_of, lean, lowered, stored, text_buffer, unused, words_of

#: Buckets of document frequencies.
BUCKETS = 1 << 18
#: Rank of a basis at most, and passages of the benchmark that one scan of the documents carries, about.
RANK, SCAN_ITEMS = 100, 1024
#: A document weighs 1, which its passages share; all together weigh so much at most, as a large corpus must not outweigh the benchmark.
CORPUS_WEIGHT = 4096
#: Weight of a benchmark passage beside a document's in the decomposition.
ITEM_WEIGHT = 3.0
#: Words of half a window; windows overlap by half.
HALF = 16
#: An item of more words is sought by its windows too, as the cosine of one window to a long item falls with the item's length.
WHOLE = 64
#: Cosine from which a window is a candidate, as a share of the item's own cosine with its projection.
COSINE = 0.25
#: Words of a document frequency above this share carry no weight, except those of items that have few others.
COMMON, MOSTLY_COMMON = 0.3, 0.6
#: Share of an item's words, in order, that a leak has; from VERBATIM on the answer isn't asked for.
LEAK, VERBATIM, ANSWER = 0.6, 0.85, 0.5
#: A long text is read in steps that overlap by so many bytes at least, and by twice the longest item of the scan.
OVERLAP = 1 << 16
#: Features in one row of a part's sums, which are added by Spark.
_BLOCK = 512
#: A stored word: its bucket, above it how often the passage has it, and a mark of the passage's first one.
_TIMES, _FIRST = 18, np.uint32(1 << 31)
_MOST_TIMES = (1 << 13) - 1
#: Rows that are summed at once, and rows that are gathered at once; powers of two.
_PIECE, _GATHERED = 32, 2048


@dataclass
class Model:
    """What one scan seeks. Passages are the items and, of long ones, their windows."""

    weights: np.ndarray  # (BUCKETS,) idf
    rows: np.ndarray  # (BUCKETS,) place of a bucket in the basis; the last row is 0
    basis: np.ndarray  # (features + 1, rank), times the weights
    latent: np.ndarray  # (passages, rank), rows of length 1
    least: np.ndarray  # of each passage: the cosine from which a window is a candidate
    owner: np.ndarray  # of each passage: its item
    ids: list  # of each item: id, hashes of its words, words before its answer
    words: list[np.ndarray]
    answers: list[int]
    kinds: np.ndarray  # (BUCKETS,) place of a bucket of an item in `holds`; the last row is 0
    holds: np.ndarray  # (buckets of items + 1, items): words of the item in the bucket, 255 at most
    overlap: int = 0  # bytes that a leak of the longest item can take
    id_type: T.DataType = T.LongType()


def _hashes(text: str) -> np.ndarray:
    return words_of(lowered(np.frombuffer(text.encode(), np.uint8)), None, MARKS)[2]


def _steps(column: pa.Array, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(owner rows, word hashes, text number of each word) of groups of texts; long texts come in overlapping steps."""
    raw, starts, ends = text_buffer(column)
    blank = np.full(1, 32, np.uint8)
    for i, j in groups_of(starts, ends, STEP_BYTES, 1024):
        if j - i == 1 and ends[i] - starts[i] > STEP_BYTES:
            for a in range(int(starts[i]), int(ends[i]), STEP_BYTES):
                h = words_of(lowered(raw[max(int(starts[i]), a - max(OVERLAP, overlap)) : min(int(ends[i]), a + STEP_BYTES)]), None, MARKS)[2]
                yield np.array([i]), h, np.zeros(len(h), np.int64)
            continue
        parts = []
        for k in range(i, j):
            parts += [raw[starts[k] : ends[k]], blank]
        sizes = ends[i:j] - starts[i:j] + 1
        s, _, h = words_of(lowered(np.concatenate(parts)), None, MARKS)
        yield np.arange(i, j), h, np.searchsorted(np.cumsum(sizes), s, side="right")


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold a word of each bucket, over all words of all documents, and the number of documents."""

    @lean("decontam")
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            long: dict[int, np.ndarray] = {}  # buckets met so far of the text that is read in steps
            for own, h, of in _steps(b.column(0)):
                if len(own) == 1:
                    if own[0] not in long:
                        for seen in long.values():
                            total += seen
                        long = {int(own[0]): np.zeros(BUCKETS, bool)}
                    long[int(own[0])][(h & np.uint64(BUCKETS - 1)).astype(np.int64)] = True
                    continue
                keys = np.sort((of << 18) | (h & np.uint64(BUCKETS - 1)).astype(np.int64))
                first = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
                total += np.bincount(first & (BUCKETS - 1), minlength=BUCKETS)
            for seen in long.values():
                total += seen
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["k", "n"])

    got = docs.select("text").mapInArrow(count, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[np.asarray(got["k"])] = np.asarray(got["n"])
    return out, docs.count()


def _vectors(column: pa.Array, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, TF-IDF) of each passage, of length 1 where a word has weight."""
    for text in column.to_pylist():
        at, n = np.unique((_hashes(text or "") & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
        v = n * weights[at]
        norm = np.sqrt((v * v).sum())
        yield at[v > 0], (v / norm)[v > 0] if norm else v[v > 0]


def _coded(h: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """The words of passages (numbers in ascending order) as one stored word for each different bucket of a passage."""
    keys, n = np.unique((passage.astype(np.int64) << _TIMES) | (h & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    out = (keys & (BUCKETS - 1)).astype(np.uint32) | (np.minimum(n, _MOST_TIMES).astype(np.uint32) << np.uint32(_TIMES))
    own = keys >> _TIMES
    out[np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))] |= _FIRST
    return out


def _documents_passages(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words as _coded(), text number of each passage) of groups of whole texts, in passages of 2 * HALF words, a text's last one shorter."""
    raw, starts, ends = text_buffer(column)
    blank = np.full(1, 32, np.uint8)
    for i, j in groups_of(starts, ends, STEP_BYTES, 1024):
        if j - i > 1:
            s, _, h = words_of(lowered(np.concatenate([x for k in range(i, j) for x in (raw[starts[k] : ends[k]], blank)])), None, MARKS)
            of = np.searchsorted(np.cumsum(ends[i:j] - starts[i:j] + 1), s, side="right")
            new = (np.arange(len(h)) - np.searchsorted(of, of)) % (2 * HALF) == 0
            if len(h):
                yield _coded(h, np.cumsum(new)), of[new]
            continue
        a, end, parts = int(starts[i]), int(ends[i]), []
        while a < end:  # steps that end with a word
            b = min(end, a + STEP_BYTES)
            while b < end and not MARKS[raw[b]]:
                b += 1
            h = words_of(lowered(raw[a:b]), None, MARKS)[2]
            parts += [_coded(h, np.arange(len(h)) // (2 * HALF))] if len(h) else []
            a = b
        if parts:
            codes = np.concatenate(parts)
            yield codes, np.zeros(np.count_nonzero(codes & _FIRST), np.int64)


def windows(docs: DataFrame) -> DataFrame:
    """(share, words): all words of all documents in passages, up to 64 of one document in a row; share: 1 by the document's passages."""

    @lean("decontam")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for codes, of in _documents_passages(b.column(0)):
                cut = np.flatnonzero((np.arange(len(of)) - np.searchsorted(of, of)) % 64 == 0)
                offsets = np.append(np.flatnonzero(codes & _FIRST)[cut], len(codes)).astype(np.int32) * np.int32(4)
                words = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(offsets), pa.py_buffer(codes)])
                yield pa.RecordBatch.from_arrays([pa.array(1 / np.bincount(of)[of[cut]]), words], ["share", "words"])

    return docs.select("text").mapInArrow(run, "share double, words binary")


def _encoded(passages: DataFrame) -> DataFrame:
    """(weight, words) of (weight, text), each text one passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [_coded(h, np.zeros(len(h), np.int64)).tobytes() if len(h := _hashes(t or "")) else b"" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.binary())], ["weight", "words"])

    return passages.select("weight", "text").mapInArrow(run, "weight double, words binary")


def _stored_words(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of (weight, words): buckets, times and passage of each stored word, and weight of each passage; some rows at once."""
    raw, starts, ends = text_buffer(b.column(1))
    weight = np.asarray(b.column(0))
    for i, j in groups_of(starts, ends, 1 << 20, 4096):
        codes = np.frombuffer(raw[starts[i] : ends[j - 1]].tobytes(), np.uint32)  # rows stand side by side
        if len(codes):
            first = (codes & _FIRST) != 0
            row = np.repeat(np.arange(i, j), (ends[i:j] - starts[i:j]) // 4)
            yield (codes & np.uint32(BUCKETS - 1)).astype(np.int64), ((codes & ~_FIRST) >> np.uint32(_TIMES)).astype(np.int64), np.cumsum(first) - 1, weight[row[first]]


def _summed(table: np.ndarray, at: np.ndarray, group: np.ndarray, out: np.ndarray) -> None:
    """Adds table[at] to the rows `group` of out; equal groups stand together. The last row of table is 0."""
    if not len(at):
        return
    cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size, own = np.diff(np.append(cut, len(at))), group[cut]
    large = np.flatnonzero(size > _PIECE)
    if len(large):  # in pieces, whose sums are summed
        n = -(-size[large] // _PIECE)
        piece = np.arange(n.sum())
        of, skip = np.repeat(large, n), (piece - np.repeat(np.cumsum(n) - n, n)) * _PIECE
        parts = np.zeros((len(piece) + 1, table.shape[1]), table.dtype)
        _gathered(table, at, cut[of] + skip, np.minimum(_PIECE, size[of] - skip), piece, parts)
        _summed(parts, piece, own[of], out)
    small = size <= _PIECE
    _gathered(table, at, cut[small], size[small], own[small], out)


def _gathered(table: np.ndarray, at: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray, out: np.ndarray) -> None:
    """_summed() of groups of _PIECE rows at most: at[start] and the size - 1 after it; no group occurs twice.

    Groups are filled up to a power of two with the last row of table, as equal groups are summed at once; small steps
    keep the gathered rows in the cache.
    """
    buffer = np.empty((_GATHERED, table.shape[1]), table.dtype)
    width = 1
    while width <= _PIECE:
        some = np.flatnonzero((size <= width) & (2 * size > width))
        inside, step = np.arange(width), _GATHERED // width
        for a in range(0, len(some), step):
            k = some[a : a + step]
            rows = np.where(inside < size[k, None], at[np.minimum(start[k, None] + inside, len(at) - 1)], len(table) - 1).ravel()
            got = np.take(table, rows, axis=0, out=buffer[: len(rows)], mode="clip")
            out[group[k]] += got if width == 1 else np.matmul(np.ones((1, width), table.dtype), got.reshape(len(k), width, table.shape[1]))[:, 0]
        width *= 2


def randomised_svd(passages: DataFrame, weights: np.ndarray, rank: int, *, seed: int = 3, powers: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Features (buckets) and right singular vectors (features, rank) of the passages' TF-IDF matrix A.

    passages: (weight, text), a passage in each row, or (weight, words) as windows() has them; A has a row for each
    passage, of length 1 times its weight, and never exists as a whole. In each round every part of the rows works out its
    share of A'(A X), X orthonormal and at first random; Spark adds the shares in blocks of features, so the driver gets
    one table of features x rank numbers. Features are the words whose passages' squared weights sum to 2: those of
    passages of weight over 1.5, and those that documents of weight 2 hold in all their passages or more documents in
    some. As the squared weights of all documents' passages sum to CORPUS_WEIGHT at most, there are HALF * CORPUS_WEIGHT
    features besides the benchmark's at most. The last round's Gram matrix (A X)'(A X), summed likewise, turns X to the
    singular vectors. No passage, or none with a word, gives no features.
    """
    rows = (passages if "words" in passages.columns else _encoded(passages)).select("weight", "words")
    # a part's sums don't shrink with the part, so there are as many as the cores need
    rows = rows.coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism)

    @lean("decontam")
    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS)
        for b in batches:
            for at, _, passage, w in _stored_words(b):
                seen += np.bincount(at, (w * w)[passage], BUCKETS)
        seen[weights == 0] = 0
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["k", "n"])

    got = rows.mapInArrow(present, "k bigint, n double").groupBy("k").agg(F.sum("n").alias("n")).where("n >= 1.999999").toArrow()
    features = np.sort(np.asarray(got["k"], dtype=np.int64))
    rank = min(rank, len(features))
    if not rank:
        return features, np.zeros((len(features), 0))
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(features), min(rank + 8, len(features)))))[0].astype(np.float32)

    def shares(x: np.ndarray, gram: bool) -> np.ndarray:
        own = weights[features].astype(np.float32)[:, None]

        @lean("decontam")
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = np.full(BUCKETS, -1, np.int64)
            place[features] = np.arange(len(features))
            table, square = np.vstack([x * own, np.zeros((1, x.shape[1]), np.float32)]), weights * weights
            out = np.zeros((x.shape[1], x.shape[1]) if gram else x.shape)
            for b in batches:
                for at, times, passage, w in _stored_words(b):
                    norm = np.sqrt(np.bincount(passage, times * times * square[at], len(w)))
                    scale = np.divide(w, norm, out=np.zeros(len(w)), where=norm > 0).astype(np.float32)[:, None]
                    p = place[at]
                    ok = p >= 0
                    p, passage, times = p[ok], passage[ok], times[ok]
                    if times.max(initial=1) > 1:
                        p, passage = np.repeat(p, times), np.repeat(passage, times)
                    y = np.zeros((len(w) + 1, x.shape[1]), np.float32)
                    _summed(table, p, passage, y)
                    y[:-1] *= scale
                    if gram:
                        out += y.T @ y
                        continue
                    y[:-1] *= scale
                    order = np.argsort(p.astype(np.uint16) if len(features) <= 1 << 16 else p, kind="stable")  # short numbers sort faster
                    _summed(y, passage[order], p[order], out)
            if not gram:
                out *= own
            step = len(out) if gram else _BLOCK
            blocks = [out[a : a + step].astype(np.float64 if gram else np.float32).tobytes() for a in range(0, len(out), step)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], ["k", "y"])

        kind = np.float64 if gram else np.float32

        def added(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(y.as_py(), kind).astype(np.float64) for y in group["y"])
            return pa.table({"k": group["k"][:1], "y": pa.array([total.astype(kind).tobytes()], pa.binary())})

        total = np.zeros((x.shape[1], x.shape[1]) if gram else x.shape)
        step = len(total) if gram else _BLOCK
        for r in rows.mapInArrow(run, "k int, y binary").groupBy("k").applyInArrow(added, "k int, y binary").collect():
            total[r["k"] * step : (r["k"] + 1) * step] = np.frombuffer(r["y"], kind).reshape(-1, x.shape[1])
        return total

    for _ in range(powers):
        x = np.linalg.qr(shares(x, False))[0].astype(np.float32)
    _, turn = np.linalg.eigh(shares(x, True))
    return features, x @ turn[:, ::-1][:, :rank]


def _passages(text: str) -> list[str]:
    """The item, and if it has more than WHOLE words also its windows, which overlap by half."""
    raw = text.encode()
    starts, ends, _ = words_of(lowered(np.frombuffer(raw, np.uint8)), None, MARKS)
    if len(starts) <= WHOLE:
        return [text]
    at = sorted({*range(0, len(starts) - 2 * HALF, HALF), len(starts) - 2 * HALF})
    return [text, *(raw[starts[k] : ends[k + 2 * HALF - 1]].decode("utf-8", "replace") for k in at)]


def fit(docs: DataFrame, benchmark: DataFrame, *, rank: int = RANK) -> Iterator[Model]:
    """The models of the scans that the benchmark needs, one after another, each of about SCAN_ITEMS passages.

    Items are the different (item_id, text) with a word; an item_id may have any type, a null item_id is an id, equal ids with different texts are
    different items. Items are dealt to scans by hash, so the driver holds one scan's items and model at a time. An
    empty benchmark needs no scan. Without documents all words weigh alike.
    """
    items = benchmark.where(F.col("text").rlike("[\\p{L}\\p{N}]")).select("item_id", "text").distinct()
    words = F.size(F.split("text", "[\\x00-/:-@\\[-`{-\\x7F]+"))
    passages = F.when(words > WHOLE, F.ceil(words / HALF)).otherwise(1)
    total = items.agg(F.sum(passages).alias("n")).collect()[0]["n"] or 0
    if not total:
        return
    frequency, n = document_frequencies(docs)
    share, idf = frequency / max(1, n), np.log1p((n + 1) / (1 + frequency))
    corpus = stored(windows(docs), "passages")  # each is read several times for each scan
    corpus = corpus.select(F.sqrt(F.col("share") * min(1.0, CORPUS_WEIGHT / max(1, n))).alias("weight"), "words")
    scans = -(-total // SCAN_ITEMS)
    for k in range(scans):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(scans)) == k).collect()
        if own:
            yield _model(sorted(((r["item_id"], r["text"]) for r in own), key=lambda x: (x[0] is not None, 0 if x[0] is None else x[0], x[1])), corpus, share, idf, rank, benchmark.schema["item_id"].dataType)


def _model(items: list[tuple], corpus: DataFrame, share: np.ndarray, idf: np.ndarray, rank: int, id_type: T.DataType) -> Model:
    bucket = lambda h: (h & np.uint64(BUCKETS - 1)).astype(np.int64)
    hashes = [_hashes(t) for _, t in items]
    weights = np.where(share > COMMON, 0, idf)
    for h in hashes:  # an item that stands in a large group of copies would have common words only
        at = np.unique(bucket(h))
        if len(at) and (share[at] > COMMON).mean() > MOSTLY_COMMON:
            weights[at] = idf[at]
    texts = [(k, x) for k, (_, t) in enumerate(items) for x in _passages(t)]
    table = pa.table({"weight": pa.array([ITEM_WEIGHT] * len(texts)), "text": pa.array([x for _, x in texts], pa.string())})
    # one scan's passages, already here, join the corpus as a small table
    rows = _encoded(corpus.sparkSession.createDataFrame(table)).unionByName(corpus)
    features, basis = randomised_svd(rows, weights, max(1, min(rank, len(texts) // 2)))
    place = np.full(BUCKETS, len(features), np.int32)
    place[features] = np.arange(len(features))
    latent, captured = np.zeros((len(texts), basis.shape[1]), np.float32), np.zeros(len(texts), np.float32)
    for k, (at, v) in enumerate(_vectors(pa.array([x for _, x in texts], pa.string()), weights)):
        ok = place[at] < len(features)
        y = v[ok] @ basis[place[at[ok]]]
        captured[k] = np.linalg.norm(y)
        latent[k] = y / max(1e-9, captured[k])
    known = np.unique(np.concatenate([bucket(h) for h in hashes]))
    kinds = np.full(BUCKETS, len(known), np.int32)
    kinds[known] = np.arange(len(known))
    holds = np.zeros((len(known) + 1, len(items)), np.uint8)
    for k, h in enumerate(hashes):
        at, n = np.unique(kinds[bucket(h)], return_counts=True)
        holds[at, k] = np.minimum(n, 255)
    full = np.vstack([basis * weights[features, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)
    give_back()  # the driver keeps nothing of the decomposition but the model
    answers = [_answer_at(t, len(h)) for (_, t), h in zip(items, hashes, strict=True)]
    return Model(weights.astype(np.float32), place, full, latent, captured, np.array([k for k, _ in texts]), [i for i, _ in items], hashes, answers, kinds, holds, 2 * max(len(t.encode()) for _, t in items), id_type)


def _answer_at(text: str, n: int) -> int:
    """Words before the answer: the text after the last line break or question mark, else the last quarter; three words at least."""
    cut = max(text.rstrip().rfind("\n"), text.rstrip().rfind("?"))
    k = len(_hashes(text[: cut + 1])) if cut > 0 else n - n // 4
    return max(0, min(k, n - 3))


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two word sequences (one bit for each word of b)."""
    places: dict[int, int] = {}
    for k, x in enumerate(b.tolist()):
        places[x] = places.get(x, 0) | (1 << k)
    full = (1 << len(b)) - 1
    v = full
    for x in a.tolist():
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def _width(n: int) -> int:
    """Words of the document in which an item of n words must stand."""
    return n + max(4, n // 3)


def _overlaps(item: np.ndarray, found: np.ndarray, held: np.ndarray, width: int) -> np.ndarray:
    """For the span of `width` words from each held place: words of the item in it, each at most as often as the item has it.

    found are the words at the places held. No common subsequence of the span is longer.
    """
    kinds, most = np.unique(item, return_counts=True)
    kind = np.searchsorted(kinds, found)
    order = np.argsort(kind, kind="stable")
    k = np.arange(len(held))
    before = k - most[kind[order]]  # in the sorted list, the place of the same word that many times earlier
    same = (before >= 0) & (kind[order][np.maximum(before, 0)] == kind[order])
    since = np.zeros(len(held), np.int64)
    since[order] = np.where(same, order[np.maximum(before, 0)] + 1, 0)
    since = np.maximum(since, np.searchsorted(held, held - width, side="right"))  # place k counts in the spans from since to k
    step = np.bincount(since, minlength=len(held) + 1) - np.bincount(k + 1, minlength=len(held) + 1)
    return np.cumsum(step)[: len(held)]


def _leaked(share: float, answer: float) -> bool:
    return share >= VERBATIM or (share >= LEAK and answer >= ANSWER)


def _checked(item: np.ndarray, answer: int, words: np.ndarray, lo: int, hi: int) -> tuple[float, float]:
    """Share of the item's words and of its answer's words, in order, in the best span that touches words lo to hi.

    A span that is a leak comes before all others. Every span is compared unless a bound shows that it can't be better.
    """
    n = len(item)
    width = _width(n)
    region = words[max(0, lo - width) : hi + width]
    held = np.flatnonzero(np.isin(region, item))
    if len(held) < LEAK * n:
        return 0.0, 0.0
    most = _overlaps(item, region[held], held, width)
    upto = np.searchsorted(held, held + width)
    tail, place = item[answer:], np.arange(len(held))
    best, leak = (0.0, 0.0), False
    while True:
        k = int(np.argmax(most))
        if most[k] < LEAK * n or (leak and most[k] <= best[0] * n):
            return best
        span = region[held[k] : held[k] + width]
        got = common_subsequence(item, span)
        # a span beside this one can gain no more than the held words that only it has
        most = np.minimum(most, got + np.where(place > k, upto - upto[k], k - place))
        most[k] = -1
        if got >= LEAK * n:
            new = got / n, common_subsequence(tail, span) / max(1, len(tail))
            if (_leaked(*new), new) > (leak, best):
                best, leak = new, _leaked(*new)


def candidates(h: np.ndarray, of: np.ndarray, count: np.ndarray, model: Model, *, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number of the window in its text, passage, cosine) of the windows whose projection is near a passage.

    h: word hashes of consecutive texts; of: the text of each word; count: words of each text. Cosines are those of the
    whole window with the passage's projection.
    """
    bucket = (h & np.uint64(BUCKETS - 1)).astype(np.int64)
    weight = model.weights[bucket]
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    halves = np.maximum(1, -(-count // HALF))
    base = np.concatenate([[0], np.cumsum(halves)[:-1]])
    half = base[of] + (np.arange(len(h)) - first[of]) // HALF
    n_half = int(halves.sum())
    text = np.repeat(np.arange(len(count)), halves)
    follows = np.concatenate([text[1:] == text[:-1], [False]])
    norm = np.bincount(half, weight * weight, n_half)
    norm[follows] += norm[1:][follows[:-1]]
    norm = np.sqrt(np.maximum(norm, 1e-9)).astype(np.float32)
    row = model.rows[bucket]
    z = np.zeros((n_half, model.basis.shape[1]), np.float32)
    _summed(model.basis, row, half, z)
    x = z.copy()
    x[:-1][follows[:-1]] += z[1:][follows[:-1]]
    x /= norm[:, None]
    least = np.maximum(cosine * model.least, 1e-6)
    found = []
    for a in range(0, n_half, 4096):
        sims = x[a : a + 4096] @ model.latent.T
        w, k = np.nonzero(sims >= least)
        found.append((w + a, k, sims[w, k]))
    w, k, c = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    return text[w], w - base[text[w]], k, c


def most_overlap(h: np.ndarray, start: np.ndarray, stop: np.ndarray, item: np.ndarray, width: np.ndarray, model: Model) -> np.ndarray:
    """For each region of words start to stop: the most words of its item that any `width` words of it hold, each at most
    as often as the item has it. Words of a bucket count alike, so no common subsequence in the region is longer.
    """
    out = np.zeros(len(start), np.int64)
    kind = model.kinds[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]
    for a in range(0, len(start), 4096):
        lo, i, wide = start[a : a + 4096], item[a : a + 4096], width[a : a + 4096]
        size = stop[a : a + 4096] - lo
        ends = np.cumsum(size)
        who = np.repeat(np.arange(len(lo)), size)
        at = np.arange(ends[-1]) - np.repeat(ends - size - lo, size)
        most = model.holds[kind[at], i[who]]
        held = np.flatnonzero((most > 0) & (most < 255))
        free = np.bincount(who[most == 255], minlength=len(lo))  # too many to count: all of the region's are allowed
        if not len(held):
            out[a : a + 4096] = free
            continue
        who, at, most = who[held], at[held], most[held].astype(np.int64)
        # in order of region, bucket and place, the place of the same word that many times earlier
        key = who * len(model.holds) + kind[at]
        order = np.argsort(key, kind="stable")
        k = np.arange(len(order))
        before = k - most[order]
        same = (before >= 0) & (key[order][np.maximum(before, 0)] == key[order])
        since = np.zeros(len(order), np.int64)
        since[order] = np.where(same, order[np.maximum(before, 0)] + 1, 0)
        # a word counts in the spans that begin at held words since then, not more than `width` before it
        place = who * (len(h) + 1) + at
        since = np.maximum(since, np.searchsorted(place, np.maximum(place - wide[who], who * (len(h) + 1) - 1), side="right"))
        spans = np.cumsum(np.bincount(since, minlength=len(k) + 1) - np.bincount(k + 1, minlength=len(k) + 1))[: len(k)]
        first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        best = np.zeros(len(lo), np.int64)
        best[who[first]] = np.maximum.reduceat(spans, first)
        out[a : a + 4096] = best + free
    return out


def leaks(column: pa.Array, model: Model, *, cosine: float = COSINE) -> dict[int, dict[int, tuple[float, float, float]]]:
    """For each row with a leak: number of the item in the model -> (cosine, share of words, share of the answer)."""
    out: dict[int, dict[int, tuple[float, float, float]]] = {}
    n_words = np.array([len(x) for x in model.words])
    width = n_words + np.maximum(4, n_words // 3)
    group = np.maximum(4, width // HALF)  # windows that are searched at once
    for own, h, of in _steps(column, model.overlap):
        if not len(h):
            continue
        count = np.bincount(of, minlength=len(own))
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        d, k, passage, c = candidates(h, of, count, model, cosine=cosine)
        if not len(d):
            continue
        item = model.owner[passage]
        part = k // group[item]
        order = np.lexsort((-c, part, item, d))  # of each group of windows the best cosine first
        d, part, item, c = d[order], part[order], item[order], c[order]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (part[1:] != part[:-1]) | (item[1:] != item[:-1])])
        d, part, item, c = d[new], part[new], item[new], c[new]
        lo, hi = part * group[item] * HALF, (part * group[item] + group[item] + 1) * HALF
        start, stop = np.maximum(0, lo - width[item]), np.minimum(count[d], hi + width[item])
        ok = np.flatnonzero(most_overlap(h, first[d] + start, first[d] + stop, item, width[item], model) >= LEAK * n_words[item])
        for q in ok.tolist():
            t, i = int(own[d[q]]), int(item[q])
            found = out.get(t, {}).get(i)
            if found and found[1] >= 1:
                continue
            share, answer = _checked(model.words[i], model.answers[i], h[first[d[q]] : first[d[q]] + count[d[q]]], int(lo[q]), int(hi[q]))
            if _leaked(share, answer) and (not found or share > found[1]):
                out.setdefault(t, {})[i] = (min(1.0, float(c[q])), share, answer)
    return out


def _leak_type(id_type: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("item_id", id_type), T.StructField("cosine", T.DoubleType()), T.StructField("lcs", T.DoubleType()), T.StructField("answer", T.DoubleType())]))


def _scan(docs: DataFrame, model: Model, keep: list[str], out: str, leaking: bool) -> DataFrame:
    """The kept columns of the rows with a leak, and their leaks as `out`; of those without one, if not leaking."""
    width = len(keep)
    schema = T.StructType([*docs.select(*keep).schema.fields, *([T.StructField(out, _leak_type(model.id_type))] if leaking else [])])
    kind = pa.list_(pa.struct([("item_id", to_arrow_type(model.id_type)), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answer", pa.float64())]))

    @lean("decontam")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = leaks(b.column(width), model)
            at = pa.array([k for k in range(b.num_rows) if (k in found) == leaking], pa.int64())
            columns = [c.take(at) for c in b.columns[:width]]
            if leaking:
                columns.append(pa.array([[{"item_id": model.ids[i], "cosine": c, "lcs": s, "answer": a} for i, (c, s, a) in sorted(found[k].items())] for k in at.to_pylist()], kind))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    text = unused(docs, "text")[0]
    return docs.select(*keep, F.col("text").alias(text)).mapInArrow(run, schema)


def search(docs: DataFrame, models: Iterable[Model], *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs with __leaks: array<struct<item_id, cosine, lcs, answer>>; no shuffle.

    A row for each row of docs and model that finds a leak in it. Null and empty texts have none; repeated rows have the
    same leaks. An item_id has the benchmark's type (bigint for an empty benchmark, which finds nothing). A kept column named __leaks gives way. The documents are read once for
    each model; the driver holds one at a time, so that all results but the last go to the shared folder.
    """
    own = [c for c in keep if c.lower() != "__leaks"]
    out, last = None, None
    for m in models:
        if last is not None:
            found = stored(_scan(docs, last, own, "__leaks", True), "leaks")
            out = found if out is None else out.unionByName(found)
        last = m
    if last is None:
        return docs.select(*own).withColumn("__leaks", F.array().cast(_leak_type(T.LongType()))).where(F.lit(False))
    found = _scan(docs, last, own, "__leaks", True)
    return found if out is None else out.unionByName(found)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with their own columns and in their own number.

    Rows with a null or empty text stay, repeated rows stay or go together, and an empty benchmark keeps all. Of several
    models, each reads what the one before it has kept.
    """
    columns, last = docs.columns, None
    for m in fit(docs, benchmark):
        if last is not None:
            docs = stored(_scan(docs, last, columns, "", False), "clean")
        last = m
    return docs if last is None else _scan(docs, last, columns, "", False)
