"""Embedding of texts by a model that the caller brings; a hashing embedder for tests and offline use."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import model_prefixes


class Embedder(Protocol):
    """Vectors of length 1 for passages and questions; must be picklable, and load its model where it is used."""

    name: str

    def documents(self, texts: list[str]) -> np.ndarray: ...

    def query(self, text: str) -> np.ndarray: ...


class HashingEmbedder:
    """Signed hashed counts of words, normalised: deterministic, no model.

    A text without words, or whose counts cancel each other, has the axis of its own hash, so that it too has length 1.
    """

    def __init__(self, dimensions: int = 64, document_prefix: str = "", query_prefix: str = ""):
        self.name, self.dimensions = f"hashing-{dimensions}", dimensions
        self.document_prefix, self.query_prefix = document_prefix, query_prefix

    def _one(self, text: str) -> np.ndarray:
        import zlib

        v = np.zeros(self.dimensions, np.float32)
        words = text.lower().split()
        for w in words:
            h = zlib.crc32(w.encode())
            v[h % self.dimensions] += 1 if h & 0x80000000 else -1
        if not v.any():
            v[zlib.crc32(" ".join(words).encode()) % self.dimensions] = 1
        return v / float(np.linalg.norm(v))

    def documents(self, texts: list[str]) -> np.ndarray:
        return np.array([self._one(self.document_prefix + t) for t in texts], np.float32).reshape(len(texts), self.dimensions)

    def query(self, text: str) -> np.ndarray:
        return self._one(self.query_prefix + text)


def query_vector(spark: SparkSession, embedder: Embedder, question: str) -> list[float]:
    """The vector of a question, with what the model wants before one."""
    prefix = spark.range(1).select(model_prefixes(F.lit(embedder.name))["query"]).first()[0]
    return np.asarray(embedder.query(prefix + question)).tolist()


def embed(chunks: DataFrame, embedder: Embedder, *, batch: int = 32) -> DataFrame:
    """(id, embedding array<float>) of each chunk; texts reach the embedder in batches, one after another in a task.

    A result of another shape than one vector a text fails the query. A null text is embedded as an empty one. What the
    model wants before a passage stands before each text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows: list[list[float]] = []
            for k in range(0, len(texts), batch):
                part = np.asarray(embedder.documents(texts[k : k + batch]), np.float32)
                if part.ndim != 2 or len(part) != len(texts[k : k + batch]):
                    raise ValueError(f"expected {len(texts[k : k + batch])} vectors, got an array of shape {part.shape}")
                rows += part.tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float32()))], ["id", "embedding"])

    text = F.concat(model_prefixes(F.lit(embedder.name))["document"], F.coalesce("text", F.lit("")))
    return chunks.select("id", text.alias("text")).mapInArrow(run, "id string, embedding array<float>")
