"""Language ID: nearest of several clustered TF-IDF centroids for each language, by cosine, with rejection by distance.

Features are byte trigrams of lower-cased letters (anything else is one blank) hashed to a fixed number of buckets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP_BYTES, groups_of, held_out, kept_names, lean, lowered, text_buffer, unused

BUCKETS = 4096
#: Rows that centroids are fitted on at most, shared by all languages.
SAMPLE_ROWS = 2400
#: Rows of a language that are drawn at least, about, however many languages there are.
LEAST_ROWS = 30
#: Centroids of a language.
CLUSTERS = 3
#: Cosine to the nearest centroid under which a text counts as none of the learned languages.
REJECT_BELOW = 0.15

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_rng = np.random.default_rng(7)
_TABLES = _rng.integers(0, BUCKETS, (3, 256), dtype=np.uint16)
_TABLES[:, ~_LETTER] = _TABLES[:, 32:33]


def _trigrams(buf: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Counts (n, BUCKETS) of a buffer whose byte i belongs to text at[i]; texts are parted by blanks."""
    h = _TABLES[0][buf[:-2]] ^ _TABLES[1][buf[1:-1]] ^ _TABLES[2][buf[2:]]
    ok = _LETTER[buf[1:-1]]
    keys = at[1:-1][ok] * BUCKETS + h[ok]
    return np.bincount(keys, minlength=n * BUCKETS).reshape(n, BUCKETS)


def counted(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(i, j, trigram counts of texts i to j); a long text is read in steps, so memory is bounded by the step."""
    raw, starts, ends = text_buffer(column)
    blank = np.full(1, 32, np.uint8)
    for i, j in groups_of(starts, ends, STEP_BYTES, 128):
        n = j - i
        if n == 1 and ends[i] - starts[i] > STEP_BYTES:
            total = np.zeros((1, BUCKETS), np.int64)
            for a in range(int(starts[i]), int(ends[i]), STEP_BYTES):
                b = min(a + STEP_BYTES, int(ends[i]))
                left = raw[a - 1 : a] if a > starts[i] else blank
                right = raw[b : b + 1] if b < ends[i] else blank
                buf = lowered(np.concatenate([left, raw[a:b], right]))
                total += _trigrams(buf, np.zeros(len(buf), np.int64), 1)
            yield i, j, total
            continue
        parts = [blank]
        for k in range(i, j):
            parts += [raw[starts[k] : ends[k]], blank]
        sizes = ends[i:j] - starts[i:j] + 1
        sizes[0] += 1
        yield i, j, _trigrams(lowered(np.concatenate(parts)), np.repeat(np.arange(n), sizes), n)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: tuple[str, ...]
    prior: str | None


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def clusters(x: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    """Spherical k-means from a farthest-first start; at most one centroid for each row."""
    c = [x.mean(axis=0)]
    c[0] = c[0] / max(float(np.linalg.norm(c[0])), 1e-12)
    while len(c) < min(k, len(x)):
        c.append(x[int(np.argmin(np.max(x @ np.array(c).T, axis=1)))])
    c = np.array(c)
    for _ in range(steps):
        own = np.argmax(x @ c.T, axis=1)
        for m in range(len(c)):
            if (own == m).any():
                v = x[own == m].mean(axis=0)
                c[m] = v / max(float(np.linalg.norm(v)), 1e-12)
    return c


def fit(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS, k: int = CLUSTERS) -> Model:
    """Document frequencies over all training rows; centroids from a bounded sample of about sample_rows of them.

    Training rows: text and lang are not null and the id isn't held out. Without any, the model knows no language.
    """
    own = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(np.zeros(BUCKETS, np.float32), np.zeros((0, BUCKETS), np.float32), (), None)

    @lean("langid")
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, counts in counted(b.column(0)):
                total += (counts > 0).sum(axis=0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    df = np.zeros(BUCKETS)
    for r in own.select("text").mapInArrow(frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r["bucket"]] = r["n"]
    total = sum(sizes.values())
    idf = np.log1p(total / (1 + df)).astype(np.float32) + np.float32(0.1)
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, math.ceil(min(1.0, max(sample_rows / len(sizes), LEAST_ROWS) / n) * (1 << 20))).otherwise(share)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for _, _, counts in counted(b.column(0)):
                for row in counts:
                    at = np.flatnonzero(row)
                    out.append((at.astype(np.uint16).tobytes(), row[at].astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], ["lang", "at", "n"])

    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("text", "lang")
    got = picked.mapInArrow(vectors, "lang string, at binary, n binary").collect()
    names, rows = sorted({r["lang"] for r in got}), {}
    for r in sorted(got, key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"]))):
        x = np.zeros(BUCKETS, np.float32)
        x[np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["n"], np.uint32)
        rows.setdefault(r["lang"], []).append(x)
    cents, langs = [], []
    for name in names:
        c = clusters(_weighted(np.array(rows[name]), idf), k)
        cents += list(c)
        langs += [name] * len(c)
    return Model(idf, np.array(cents, np.float32).reshape(-1, BUCKETS), tuple(langs), max(sorted(sizes), key=sizes.get))


def predict(docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",), reject_below: float = REJECT_BELOW) -> DataFrame:
    """The kept columns of docs with __lang, __score (cosine, 0 to 1), __rejected and __cluster; no shuffle, rows stay.

    __lang is the nearest learned language, `und` for a null text, a text without a letter, or where no language was
    learned. A text like none of the centroids (cosine under reject_below) keeps its nearest language and is marked
    __rejected. Ties take the first language by name. Repeated rows get equal results. Kept columns with the names of the
    results give way.
    """
    keep = kept_names(keep, "__lang", "__score", "__rejected", "__cluster")
    letters, text = unused(docs, "letters", "text")
    own = docs.select(*keep, F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias(letters), F.col("text").alias(text))
    width = len(keep)
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType()), T.StructField("__rejected", T.BooleanType()), T.StructField("__cluster", T.IntegerType())])

    @lean("langid")
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], object)
        for b in batches:
            letters = np.asarray(b.column(width).to_pylist(), bool).reshape(-1)
            best, score = np.full(len(letters), len(names) - 1), np.zeros(len(letters))
            if len(model.languages):
                for i, j, counts in counted(b.column(width + 1)):
                    sims = _weighted(counts, model.idf) @ model.centroids.T
                    best[i:j] = np.argmax(sims, axis=1)
                    score[i:j] = np.clip(sims.max(axis=1), 0, 1)
            best[~letters], score[~letters] = len(names) - 1, 0.0
            own = [pa.array(names[best], pa.string()), pa.array(score), pa.array(letters & (score < reject_below)), pa.array(np.where(letters & (best < len(names) - 1), best, -1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], *own], schema.names)

    return own.mapInArrow(scored, schema)
