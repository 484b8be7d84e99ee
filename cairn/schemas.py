"""Schemas of the corpus: documents, chunks, registry rows and decisions. Metadata travel as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
DOCUMENT = T.StructType(
    [T.StructField(k, _S, False) for k in ("id", "source", "title", "text", "url")]
    + [T.StructField("date", _S), T.StructField("authors", T.ArrayType(_S))]
    + [T.StructField(k, _S) for k in ("place", "genre", "rights", "country", "language", "content_mode", "metadata")]
)
CHUNK = T.StructType([*DOCUMENT.fields, T.StructField("document_id", _S, False), T.StructField("ordinal", T.IntegerType())])
REQUIRED = ("id", "source", "title", "text", "url")
DEFAULTS = {"date": "", "place": "", "genre": "", "rights": "", "country": "america", "language": "en", "content_mode": "native", "metadata": "{}"}
REGISTRY = T.StructType(
    [T.StructField(k, _S) for k in ("id", "name", "language", "language_name", "native_query_default")]
    + [T.StructField("publication_cutoff", T.IntegerType()), T.StructField("cutoff_note", _S)]
    + [T.StructField("sources", T.ArrayType(T.StructType([T.StructField(k, _S) for k in ("id", "name", "protocol", "endpoint", "rights_note", "options")])))]
)


def as_documents(df: DataFrame, *keep: str) -> DataFrame:
    """df in the shape of DOCUMENT, and the columns to keep beside it: missing optional columns get their defaults, a null in one is its default too.

    A missing required column raises; a null in one fails the query when that row is read.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing document columns: {', '.join(missing)}")
    must = lambda c: F.when(F.col(c).isNotNull(), F.col(c).cast("string")).otherwise(F.raise_error(F.lit(f"document without {c}")))
    out = [must(c).alias(c) for c in REQUIRED]
    for c, default in DEFAULTS.items():
        out.append((F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in df.columns else F.lit(default)).alias(c))
    authors = F.coalesce(F.col("authors"), F.array()) if "authors" in df.columns else F.array()
    out.append(authors.cast("array<string>").alias("authors"))
    return df.select(*out, *keep).select(*[f.name for f in DOCUMENT.fields], *keep)


def place_of(kind: str, root: str, country: str, mode: str) -> str:
    """Where a country's `corpus` or `index` of a mode (native or english) lies below root; america's native ones have no mode."""
    names = {"corpus": ("corpus", ".jsonl"), "index": ("index", "")}
    name, end = names[kind]
    own = "" if (country, mode) == ("america", "native") else f".{mode}"
    return f"{root.rstrip('/')}/{country}/data/{name}{own}{end}"


def content_mode(mode: str) -> str:
    """The content_mode of documents of a mode."""
    return "native" if mode == "native" else "english_translation"
