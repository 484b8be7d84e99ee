"""Harvests in source order that end early: ranges of candidates, each fetched in parallel, until enough have survived.

The candidates of a source have positions. Ranges of them are built one after another; inside a range everything runs in
parallel, and only the number of survivors reaches the driver. The next range is sized by the share that has survived so
far, so a limit of n costs about n / share fetches, not the whole source, and few rounds. Every range's documents are
written before they are counted: a lost executor repeats its own tasks of one range, and nothing is fetched twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DOCUMENT
from ..session import stored

#: Candidates of the first range at least, and how many times as many a range may have as the one before it.
FIRST, GROWTH = 16, 8
#: Candidates of a range at most.
MOST = 1 << 22

Build = Callable[[DataFrame], DataFrame]


def ranges(candidates: DataFrame, sizes: Iterable[int]) -> Iterator[DataFrame]:
    """Parts of the candidates by rising pos, each of about the next of the sizes (more where positions are equal)."""
    low = None
    for size in sizes:
        rest = candidates if low is None else candidates.where(F.col("pos") > low)
        high = rest.select("pos").orderBy("pos").limit(size).agg(F.max("pos")).first()[0]
        if high is None:
            return
        yield rest.where(F.col("pos") <= high)
        low = high


def first_documents(candidates: DataFrame, build: Build, limit: int | None = None, *, first: int = FIRST) -> DataFrame:
    """in_order() of candidates that are one table."""
    return in_order(iter([candidates]), build, limit, first=first)


def in_order(blocks: Iterator[DataFrame], build: Build, limit: int | None = None, *, first: int = FIRST) -> DataFrame:
    """The first `limit` documents of the candidates in source order; all without a limit.

    blocks: candidates as tables with rising positions, each made when it is needed (a page of a search, say); they have
    any columns and pos, a number that isn't null. build(part): the documents of a part of a block, with pos; it may drop
    candidates, and is called for one range after another until there are enough. Documents of equal pos come by id.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    sizes, empty = Sizes(max(first, limit or 0), limit or 0), None

    def parts() -> Iterator[DataFrame]:
        nonlocal empty
        for block in blocks:
            rows = stored(block, "candidates")
            empty = rows.limit(0) if empty is None else empty
            yield from (build(part) for part in ranges(rows, sizes.of(rows.count()))) if limit is not None else [build(rows)]

    found = first_of(parts(), limit, sizes)
    if found is not None:
        return found
    return SparkSession.active().createDataFrame([], DOCUMENT) if empty is None else build(empty).drop("pos")


class Sizes:
    """How many candidates each range takes: as many as should give what is still missing, by what has survived so far."""

    def __init__(self, first: int, limit: int):
        self.size, self.limit, self.asked, self.kept = first, limit, 0, 0

    def of(self, left: int) -> Iterator[int]:
        """The sizes of the ranges of a block with `left` candidates."""
        while left > 0:
            if self.asked:
                wanted = (self.limit - self.kept) * self.asked // self.kept + 1 if self.kept else MOST
                self.size = min(MOST, GROWTH * self.size, max(FIRST, wanted))
            self.asked += min(self.size, left)
            left -= self.size
            yield self.size


def first_of(parts: Iterator[DataFrame], limit: int | None, sizes: Sizes | None = None) -> DataFrame | None:
    """The first `limit` documents (all for None) of parts that come in order, each with pos; no part is built after they
    are enough. None without a part."""
    found, n = None, 0
    for part in parts:
        done = stored(part, "harvested")
        found = done if found is None else found.unionByName(done)
        if limit is not None:
            n += done.count()
            if sizes is not None:
                sizes.kept = n
            if n >= limit:
                break
    if found is None:
        return None
    found = found.orderBy("pos", "id")
    return (found if limit is None else found.limit(limit)).drop("pos")
