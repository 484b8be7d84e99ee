"""Helpers shared by the operators: sessions, spans, splits and byte buffers."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A blank as the word contracts define it: U+0020 and U+0009 to U+000D.
BLANK = "[\\x20\\x09-\\x0D]"
#: Bytes of text that one numpy step works on; bounds the memory of a Python worker.
STEP_BYTES = 1 << 20


_RELEASES: dict[str, list] = {}


def on_other_work(name: str, release) -> None:
    """Calls `release` in a Python worker that takes up another operator's work."""
    _RELEASES.setdefault(name, []).append(release)


def fresh_worker(name: str) -> None:
    """Frees what other operators keep in this worker process from task to task."""
    for other, releases in _RELEASES.items():
        if other != name:
            for release in releases:
                release()


def lean(name: str) -> Callable:
    """For a function of Arrow batches: frees what other operators keep, and gives unused memory back when a task ends.

    Workers stay for later tasks while the executor's Java part works, so that what they hold idle adds to its peak.
    """

    def wrap(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        @functools.wraps(run)
        def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fresh_worker(name)
            try:
                yield from run(batches)
            finally:
                give_back()

        return out

    return wrap


def give_back() -> None:
    """Returns memory that the allocators of this process hold unused to the system, where they can."""
    _POW.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """A column name like each of `names` that docs hasn't."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, /tmp/cairn-shared, but only on a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "/tmp/cairn-shared"
    return found.rstrip("/")


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the rows no model may learn from: crc32(doc_id as text) mod 3 is 1; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """All training ids with their label; ids labelled both ways count as 1. (doc_id, y)"""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    return own.groupBy("doc_id").agg(F.max((F.col(label) > 0).cast("int")).alias("y"))


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most `rows` training ids with their label, in hash order; see labelled()."""
    return labelled(labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


#: Bytes of labelled texts that the driver fits on at most.
SAMPLE_BYTES = 48 << 20


def sampled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """(text, label) of a bounded labelled sample on the driver: whole texts of `rows` ids at most, in hash order.

    Texts of any length take part; those with which the sample would pass most_bytes are left out. Both bounds concern
    fitting only; scoring covers every row and whole texts. Null texts and ids without a text are left out, of rows with
    one id the first by text stays.
    """
    ids = labelled_sample(labels, label, rows)
    own = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "y")).alias("x"))
    got = stored(own.select("doc_id", "x.*", F.octet_length("x.text").alias("n"), F.xxhash64("doc_id").alias("h")), "sample")
    picked, room = [], most_bytes
    for r in sorted(got.select("doc_id", "n", "h").collect(), key=lambda r: (r["h"], str(r["doc_id"]))):
        if r["n"] <= room:
            picked.append(r["doc_id"])
            room -= r["n"]
    chosen = set(picked)
    texts = {r["doc_id"]: (r["text"], r["y"]) for r in got.select("doc_id", "text", "y").toLocalIterator() if r["doc_id"] in chosen}
    return [texts[i] for i in picked]


def kept_names(keep: tuple[str, ...], *made: str) -> list[str]:
    """The kept columns but those that have the name of a made one, which give way."""
    return [c for c in keep if c.lower() not in made]


def literal_doubles(values) -> str:
    """SQL for a constant array<double>; the optimizer folds it into one literal."""
    return "cast(split('" + ",".join(f"{float(v):.9g}" for v in values) + "', ',') as array<double>)"


def regex_spans(text: str, pattern: str) -> str:
    """SQL: leftmost non-overlapping matches of pattern in column `text` as array<struct<s,e,m>> in code points.

    Gaps (split) and matches (regexp_extract_all) alternate; their lengths are summed in blocks of 256,
    so a text with very many matches costs far less than the square of their number. Null texts have none.
    """
    p = "r'" + pattern.replace("'", "\\x27") + "'"
    hits = f"regexp_extract_all({text}, {p}, 0)"
    pairs = f"transform(array({hits}), r -> zip_with(slice(split({text}, {p}, -1), 1, size(r)), r, (g, m) -> struct(length(g) AS g, length(m) AS n, m AS m)))[0]"
    block = "slice(x, b * 256 + 1, 256)"
    starts = f"aggregate(sequence(0, cast((size(x) - 1) div 256 as int)), array(0), (a, b) -> array_append(a, element_at(a, -1) + aggregate({block}, 0, (t, y) -> t + y.g + y.n)))"
    inner = (
        "aggregate(" + block + ", named_struct('at', element_at(st, b + 1), 'out', cast(array() as array<struct<s:int,e:int,m:string>>)),"
        " (a, y) -> named_struct('at', a.at + y.g + y.n, 'out', array_append(a.out, named_struct('s', a.at + y.g, 'e', a.at + y.g + y.n, 'm', y.m))), a -> a.out)"
    )
    body = f"transform(array({starts}), st -> flatten(transform(sequence(0, cast((size(x) - 1) div 256 as int)), b -> {inner})))[0]"
    empty = "cast(array() as array<struct<s:int,e:int,m:string>>)"
    return f"CASE WHEN {text} rlike {p} THEN transform(array({pairs}), x -> {body})[0] ELSE {empty} END"


def packed(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, t): the kept columns of docs (all by default) as one struct, and the text, empty for null. No name can clash."""
    return docs.select(F.struct(*[_own(docs, c) for c in (docs.columns if keep is None else keep)]).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("t"))


def _own(docs: DataFrame, name: str) -> Column:
    return docs["`" + name.replace("`", "``") + "`"]


def unpacked(frame: DataFrame, **made: Column) -> DataFrame:
    """The columns of `row` and those made; a column of the row that has the name of one made gives way to it."""
    names = {c.lower() for c in made}
    own = [c for c in frame.schema["row"].dataType.names if c.lower() not in names]
    return frame.select(*[F.col("row").getField(c).alias(c) for c in own], *[x.alias(c) for c, x in made.items()])


def running_max(values: str, lowest: str) -> str:
    """SQL for the greatest of each element of an array and those before it, in blocks of 256; lowest: of its type."""
    block = "slice(rx, rb * 256 + 1, 256)"
    blocks = "sequence(0, cast((size(rx) - 1) div 256 as int))"
    heads = f"aggregate({blocks}, array({lowest}), (ra, rb) -> array_append(ra, greatest(element_at(ra, -1), array_max({block}))))"
    inner = f"slice(aggregate({block}, array(element_at(rp, rb + 1)), (ra, ry) -> array_append(ra, greatest(element_at(ra, -1), ry))), 2, 256)"
    return f"transform(array({values}), rx -> transform(array({heads}), rp -> flatten(transform({blocks}, rb -> {inner})))[0])[0]"


def outside(items: str, spans: str, kind: str) -> str:
    """SQL for the items array<struct<s,e,m>>, m of that type, that overlap none of the spans array<struct<s,e,...>>.

    Items are in order and don't overlap each other. One sorted sweep: the work grows with both numbers, not their product.
    """
    merged = f"array_sort(concat(transform({spans}, x -> struct(x.s AS s, 0 AS k, x.e AS e, cast(null as {kind}) AS m)), transform({items}, x -> struct(x.s AS s, 1 AS k, x.e AS e, x.m AS m))))"
    ended = running_max("transform(ol, x -> if(x.k = 0, x.e, -1))", "-1")
    begun = f"reverse({running_max('transform(reverse(ol), x -> if(x.k = 0, -x.s, -2147483647))', '-2147483647')})"
    free = "filter(transform(ol, (x, i) -> struct(x AS x, ow.a[i] AS a, ow.b[i] AS b)), z -> z.x.k = 1 AND z.a <= z.x.s AND -z.b >= z.x.e)"
    body = f"transform(array({merged}), ol -> transform(array(struct({ended} AS a, {begun} AS b)), ow -> transform({free}, z -> struct(z.x.s AS s, z.x.e AS e, z.x.m AS m)))[0])[0]"
    return f"CASE WHEN size({spans}) = 0 THEN {items} ELSE {body} END"


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without a copy: bytes, start offsets, end offsets. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    _, off, data = column.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    starts, ends = offs[:-1].copy(), offs[1:].copy()
    if column.null_count:
        ends = np.where(np.asarray(column.is_valid()), ends, starts)
    return raw, starts, ends


def groups_of(starts: np.ndarray, ends: np.ndarray, most_bytes: int = STEP_BYTES, most_rows: int = 256):
    """Row ranges (i, j) whose texts hold about most_bytes at most; a longer text stands alone."""
    i, n = 0, len(starts)
    while i < n:
        j, size = i + 1, ends[i] - starts[i]
        while j < n and j - i < most_rows and size + ends[j] - starts[j] <= most_bytes:
            size += ends[j] - starts[j]
            j += 1
        yield i, j
        i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(buf: np.ndarray) -> np.ndarray:
    """Lower case of UTF-8 bytes for ASCII and U+00C0 to U+00DE; other letters stay as they are."""
    out = _LOWER[buf]
    if len(buf) > 1:
        at = np.flatnonzero(buf[:-1] == 0xC3) + 1
        second = out[at]
        out[at] = np.where((second >= 0x80) & (second <= 0x9E) & (second != 0x97), second + 32, second)
    return out


_BLANKS = np.zeros(256, bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII letters, digits and bytes of other scripts.
MARKS = np.ones(256, bool)
MARKS[48:58] = MARKS[65:91] = MARKS[97:123] = MARKS[128:] = False
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_POW: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words_of(buf: np.ndarray, cut: np.ndarray | None = None, blanks: np.ndarray = _BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a byte buffer, parted by the bytes that `blanks` marks: starts, ends and 64-bit hashes. cut: positions where a new text begins."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    full = np.concatenate(([False], ~blanks[buf], [False]))
    begins = full[1:-1] & ~full[:-2]
    stops = full[1:-1] & ~full[2:]
    if cut is not None and len(cut):
        at = cut[(cut > 0) & (cut < n)]
        both = at[full[1:-1][at] & full[:-2][at]]
        begins[both] = True
        stops[both - 1] = True
    s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    if len(_POW.get("p", ())) < n + 1:
        size = max(n + 1, STEP_BYTES + 1)
        _POW["p"], _POW["i"] = powers(_P, size), powers(_P_INV, size)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _POW["p"][:n], out=total[1:])
    h = (total[e] - total[s]) * _POW["i"][s]
    out = mixed(h + (e - s).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    if len(_POW["p"]) > 4 * STEP_BYTES:  # one very long text must not leave its tables behind
        _POW.clear()
    return s, e, out
