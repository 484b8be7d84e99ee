"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover the whole of it. Filters of WIDTH bytes slide over each
chunk, ReLU and max-pooling leave one value for each filter and chunk, and the mean and the maximum over all chunks
feed one logistic unit. A filter over one-hot bytes is a table of 256 weights for each of its places, so a convolution
is a sum of table rows; the gradient of a pooled filter touches only the bytes under its maximum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept_names, lean, sampled_texts, text_buffer, unused

#: Labelled rows that the network is fitted on at most; see also common.SAMPLE_BYTES.
SAMPLE_ROWS = 6000
FILTERS, WIDTH, STRIDE = 24, 6, 3
CHUNK, OVERLAP = 768, 96
_PLACES = (CHUNK - WIDTH) // STRIDE + 1


@dataclass
class Model:
    tables: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    out: np.ndarray  # (2 * FILTERS + 1,)


def chunks_of(raw: np.ndarray) -> np.ndarray:
    """(n, CHUNK) bytes, padded with 0; every byte is in a chunk. An empty text is one chunk of padding."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step)) if len(raw) > CHUNK else 1
    buf = np.zeros((n - 1) * step + CHUNK, np.uint8)
    buf[: len(raw)] = raw
    return np.lib.stride_tricks.as_strided(buf, (n, CHUNK), (step, 1))


def _activation(chunks: np.ndarray, m: Model) -> np.ndarray:
    """(n, places, filters) before the ReLU."""
    last = STRIDE * (_PLACES - 1) + 1
    z = m.tables[0][chunks[:, :last:STRIDE]]
    for k in range(1, WIDTH):
        z += m.tables[k][chunks[:, k : k + last : STRIDE]]
    z += m.bias
    return z


def _pooled(p: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.concatenate([np.add.reduceat(p, first, axis=0) / n[:, None], np.maximum.reduceat(p, first, axis=0)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(samples: list[tuple[str, int]], *, steps: int = 1000, batch: int = 32, rate: float = 0.01, seed: int = 1) -> Model:
    """Adam on the cross-entropy, classes weighted alike. Of one class only, or of nothing, it learns the base rate."""
    rng = np.random.default_rng(seed)
    m = Model((rng.standard_normal((WIDTH, 256, FILTERS)) * 0.1).astype(np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS + 1, np.float32))
    m.out[:-1] = rng.standard_normal(2 * FILTERS) * 0.1
    y = np.array([v for _, v in samples], np.float32)
    if not len(y) or y.min() == y.max():
        m.out[:] = 0
        m.out[-1] = 0 if not len(y) else 4 * (2 * y[0] - 1)
        return m
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    data = [chunks_of(np.frombuffer(t.encode(), np.uint8)) for t, _ in samples]
    params = [m.tables, m.bias, m.out]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    epochs = max(2, -(-steps * batch // len(y)))
    for epoch in range(epochs):
        for ids in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            x = np.concatenate([data[i] for i in ids])
            n = np.array([len(data[i]) for i in ids])
            at = np.concatenate([[0], np.cumsum(n)[:-1]])
            z = _activation(x, m)
            where = z.argmax(axis=1)  # (chunks, filters)
            top = np.take_along_axis(z, where[:, None, :], 1)[:, 0]
            p = np.maximum(top, 0)
            f = _pooled(p, at, n)
            g = (_sigmoid(f @ m.out[:-1] + m.out[-1]) - y[ids]) * weight[ids] / len(ids)
            d_out = np.concatenate([g @ f, [g.sum()]]).astype(np.float32) + 1e-4 * m.out
            d_f = g[:, None] * m.out[:-1]
            doc = np.repeat(np.arange(len(ids)), n)
            d_p = d_f[doc, :FILTERS] / n[doc, None] + d_f[doc, FILTERS:] * (p == f[doc, FILTERS:])
            d_p = (d_p * (top > 0)).astype(np.float32)
            d_tables = np.zeros_like(m.tables)
            rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
            for k in range(WIDTH):
                np.add.at(d_tables[k], (x[rows, where * STRIDE + k], np.broadcast_to(cols, where.shape)), d_p)
            grads, t = [d_tables, d_p.sum(axis=0), d_out], t + 1
            step = rate * (1 - epoch / epochs * 0.8) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for q, gr, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (gr - a)
                b += 0.001 * (gr * gr - b)
                q -= (step * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
    return m


def scores(column: pa.Array, m: Model) -> np.ndarray:
    """One probability for each text; long texts are read in steps of 64 chunks."""
    raw, starts, ends = text_buffer(column)
    n = len(starts)
    out, total, most, size = np.zeros(n), np.zeros((n, FILTERS)), np.zeros((n, FILTERS)), np.zeros(n)
    waiting: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def flush() -> None:
        if not waiting:
            return
        x, who = np.concatenate(waiting), np.concatenate(owners)
        p = np.maximum(_activation(x, m).max(axis=1), 0)
        first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        ids = who[first]
        total[ids] += np.add.reduceat(p, first, axis=0)
        most[ids] = np.maximum(most[ids], np.maximum.reduceat(p, first, axis=0))
        waiting.clear()
        owners.clear()

    held = 0
    for i in range(n):
        x = chunks_of(raw[starts[i] : ends[i]])
        size[i] = len(x)
        for a in range(0, len(x), 64):
            waiting.append(x[a : a + 64])
            owners.append(np.full(len(waiting[-1]), i))
            held += len(waiting[-1])
            if held >= 64:
                flush()
                held = 0
    flush()
    if n:
        out = _sigmoid(np.concatenate([total / size[:, None], most], axis=1) @ m.out[:-1] + m.out[-1])
    return out.astype(float)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Trained on the driver from a bounded labelled sample outside the held-out third."""
    return train(sampled_texts(docs, labels, label, sample_rows))


def score(docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs with __score (0 to 1); no shuffle, every row stays. Null and empty texts are one empty chunk,
    repeated rows get equal scores. A kept column named __score gives way."""
    keep = kept_names(keep, "__score")
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("__score", T.DoubleType())])
    width = len(keep)

    @lean("quality_cnn")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(scores(b.column(width), model))], schema.names)

    return docs.select(*keep, F.col("text").alias(unused(docs, "text")[0])).mapInArrow(run, schema)
