"""Splitting documents into overlapping chunks that keep their citation columns; one fold per document, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import UNSPACED, paragraphs, stable_id, words


def word_windows(x: Column, target: int, overlap: int) -> Column:
    """Windows of `target` words that overlap, joined by blanks; the last ones may be shorter."""
    return _windows(words(x), target, overlap, " ")


def char_windows(x: Column, target: int, overlap: int) -> Column:
    """Windows of `target` code points that overlap."""
    return _windows(F.filter(F.split(x, ""), lambda c: c != ""), target, overlap, "")


def _windows(parts: Column, target: int, overlap: int, glue: str) -> Column:
    def cut(p: Column) -> Column:
        last = F.greatest(F.lit(0), F.size(p) - overlap - 1)
        return F.transform(F.sequence(F.lit(0), last, F.lit(target - overlap)), lambda i: F.array_join(F.slice(p, i + 1, F.lit(target)), glue))

    # the parts are bound first: inside the windows they would be made again for each
    return F.element_at(F.transform(F.array(parts), cut), 1)


def chunk_texts(text: Column, target: int = 350, overlap: int = 50) -> Column:
    """array<string>: the chunks of a text.

    Paragraphs are packed up to `target` words. A full chunk hands its last words (at most `overlap`, fewer if the next
    paragraph leaves no room) to the next one. A paragraph over the target is cut into windows of its own, of words, or
    of characters if it holds an unspaced script; nothing is carried over it. Null and blank texts have no chunks.
    """
    if target <= 0:
        raise ValueError("target must be positive")
    if not 0 <= overlap < target:
        raise ValueError("overlap must be from 0 to target - 1")
    none = F.array().cast("array<string>")

    def unit(p: Column) -> Column:
        n = F.size(words(p))
        by_char = p.rlike(UNSPACED) & (F.length(p) > target)
        cut = F.when(by_char, char_windows(p, target, overlap)).when(n > target, word_windows(p, target, overlap)).otherwise(none)
        return F.struct(p.alias("p"), n.alias("n"), cut.alias("cut"))

    empty = F.struct(none.alias("out"), none.alias("now"), F.lit(0).alias("n"))

    def step(a: Column, u: Column) -> Column:
        whole = F.array_join(a["now"], "\n\n")
        closed = F.when(F.size(a["now"]) > 0, F.array_append(a["out"], whole)).otherwise(a["out"])
        room = F.least(F.lit(overlap), F.greatest(F.lit(0), F.lit(target) - u["n"]))
        had = words(whole)
        tail = F.slice(had, F.greatest(F.size(had) - room + 1, F.lit(1)), room)
        carried = F.when(F.size(tail) > 0, F.array(F.array_join(tail, " "), u["p"])).otherwise(F.array(u["p"]))
        as_state = lambda out, now, n: F.struct(out.alias("out"), now.alias("now"), n.cast("int").alias("n"))
        return (
            F.when(F.size(u["cut"]) > 0, as_state(F.concat(closed, u["cut"]), none, F.lit(0)))
            .when((F.size(a["now"]) > 0) & (a["n"] + u["n"] > target), as_state(closed, carried, F.size(tail) + u["n"]))
            .otherwise(as_state(a["out"], F.array_append(a["now"], u["p"]), a["n"] + u["n"]))
        )

    def finish(a: Column) -> Column:
        return F.when(F.size(a["now"]) > 0, F.array_append(a["out"], F.array_join(a["now"], "\n\n"))).otherwise(a["out"])

    units = F.transform(paragraphs(F.coalesce(text, F.lit(""))), unit)
    return F.aggregate(units, empty, step, finish)


def chunk_documents(docs: DataFrame, target: int | None = 350, overlap: int = 50) -> DataFrame:
    """One row for each chunk: all columns of docs, with id the chunk's, document_id and ordinal (from 0).

    target None: each document is one chunk, its text as it is, however long, and blank or null (an empty text) too.
    """
    if target is None:
        a = docs.select("*", F.lit(0).alias("ordinal"), F.coalesce("text", F.lit("")).alias("__chunk"))
    else:
        a = docs.select("*", F.posexplode(chunk_texts(F.col("text"), target, overlap)).alias("ordinal", "__chunk"))
    keep = [c for c in docs.columns if c not in ("id", "text")]
    own = stable_id(F.col("id"), F.col("ordinal"), F.col("__chunk"))
    return a.select(own.alias("id"), F.col("id").alias("document_id"), F.col("__chunk").alias("text"), *keep, "ordinal")
