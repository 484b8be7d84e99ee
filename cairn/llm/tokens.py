"""Token ids in binary files: one wavelet matrix for each shard.

A shard file (WMX1) holds the ids of consecutive documents as bit planes. Plane l keeps bit l of every id in the order
that the planes before it leave; after each plane the ids are parted stably, zeros first. With cumulative counts of ones
for each 512 bits, an id is read, counted or located from the planes alone, without the ids. Planes, counts and the
index of documents are zstd frames of one file; the header has their places.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import groups_of, lean, on_other_work, shared_dir, text_buffer

MAGIC = b"WMX1"
#: The id after each document.
END_ID = 2
#: Ids of a shard, about; a longer document stands alone.
SHARD_IDS = 4_000_000
_BLOCK = 512
#: Ids that building and decoding move at a time.
_STEP = 1 << 17
#: Bytes of texts that are encoded at a time.
_TEXT_BYTES = 1 << 22


class WaveletMatrix:
    """Bit planes with rank and select over the codes of ids, their places in a sorted alphabet.

    Positions and ids are counted from 0; ends are exclusive.
    """

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray], alphabet: np.ndarray):
        self.n, self.planes, self.ranks, self.alphabet = n, planes, ranks, alphabet
        self.bits = len(planes)
        self.zeros = [n - int(r[-1]) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        a = np.asarray(ids)
        alphabet = np.flatnonzero(np.bincount(a)) if len(a) else np.zeros(0, np.int64)
        code = np.zeros(int(alphabet[-1]) + 1 if len(a) else 1, np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        code[alphabet] = np.arange(len(alphabet))
        a = code[a]
        n, bits = len(a), max(1, (len(alphabet) - 1).bit_length())
        planes, ranks = [], []
        after, b = np.empty_like(a), np.empty(n, bool)
        for k in range(bits - 1, -1, -1):
            for s in range(0, n, _STEP):
                np.not_equal(a[s : s + _STEP] & a.dtype.type(1 << k), 0, out=b[s : s + _STEP])
            packed = np.packbits(b)
            planes.append(packed)
            ranks.append(cls._directory(packed))
            zero, one = 0, n - int(np.count_nonzero(b))
            for s in range(0, n, _STEP):  # small steps keep the temporaries in the cache
                part, own = b[s : s + _STEP], a[s : s + _STEP]
                m = int(np.count_nonzero(part))
                after[one : one + m] = np.compress(part, own)
                after[zero : zero + len(own) - m] = np.compress(~part, own)
                zero, one = zero + len(own) - m, one + m
            a, after = after, a
        return cls(n, planes, ranks, alphabet.astype(np.uint32))

    @staticmethod
    def _directory(packed: np.ndarray) -> np.ndarray:
        """Ones before each block of 512 bits, and in all."""
        per = np.bitwise_count(packed).astype(np.uint32)
        width = _BLOCK // 8
        full = np.add.reduceat(per, np.arange(0, len(per), width)) if len(per) else np.zeros(0, np.uint32)
        return np.concatenate([[0], np.cumsum(full)]).astype(np.uint32)

    def _rank1(self, level: int, i: int) -> int:
        block = i // _BLOCK
        start, end = block * (_BLOCK // 8), i // 8
        out = int(self.ranks[level][block]) + int(np.bitwise_count(self.planes[level][start:end]).sum())
        if i % 8:
            out += (int(self.planes[level][end]) >> (8 - i % 8)).bit_count()
        return out

    def _bit(self, level: int, i: int) -> int:
        return (int(self.planes[level][i // 8]) >> (7 - i % 8)) & 1

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k in range(self.bits):
            b = self._bit(k, i)
            out = out * 2 + b
            i = self.zeros[k] + self._rank1(k, i) if b else i - self._rank1(k, i)
        return int(self.alphabet[out])

    def _code(self, c: int) -> int:
        k = int(np.searchsorted(self.alphabet, c))
        return k if k < len(self.alphabet) and self.alphabet[k] == c else -1

    def _range(self, c: int, lo: int, hi: int) -> tuple[int, int]:
        if c < 0 or c >> self.bits:
            return 0, 0
        for k in range(self.bits):
            if (c >> (self.bits - 1 - k)) & 1:
                lo, hi = self.zeros[k] + self._rank1(k, lo), self.zeros[k] + self._rank1(k, hi)
            else:
                lo, hi = lo - self._rank1(k, lo), hi - self._rank1(k, hi)
        return lo, hi

    def count(self, c: int, lo: int = 0, hi: int | None = None) -> int:
        """How often id c stands in positions lo to hi."""
        a, b = self._range(self._code(c), lo, self.n if hi is None else hi)
        return b - a

    def select(self, c: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of id c."""
        c = self._code(c)
        a, b = self._range(c, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(self.bits - 1, -1, -1):
            one = (c >> (self.bits - 1 - level)) & 1
            i = self._find(level, i - self.zeros[level] if one else i, one)
        return i

    def _find(self, level: int, k: int, one: int) -> int:
        """The position of the k-th bit of that value."""
        at = self.ranks[level].astype(np.int64)
        if not one:
            at = np.minimum(np.arange(len(at)) * _BLOCK, self.n) - at
        block = int(np.searchsorted(at, k, side="right")) - 1
        part = np.unpackbits(self.planes[level][block * (_BLOCK // 8) : (block + 1) * (_BLOCK // 8)])[: self.n - block * _BLOCK]
        return block * _BLOCK + int(np.flatnonzero(part == one)[k - int(at[block])])

    def locate(self, c: int) -> list[int]:
        """All positions of id c."""
        return [self.select(c, k) for k in range(self.count(c))]

    def decode(self) -> np.ndarray:
        """All ids (uint32), from the last plane to the first."""
        dtype = np.uint16 if self.bits <= 16 else np.uint32
        a, before = np.zeros(self.n, dtype), np.empty(self.n, dtype)
        for k in range(self.bits - 1, -1, -1):
            zero, one, bit = 0, self.zeros[k], dtype(1 << (self.bits - 1 - k))
            for s in range(0, self.n, _STEP):
                b = np.unpackbits(self.planes[k][s // 8 : (s + _STEP) // 8], count=min(_STEP, self.n - s)).view(bool)
                out, ones = before[s : s + _STEP], np.flatnonzero(b)
                m = len(ones)
                out[ones] = a[one : one + m] | bit
                out[np.flatnonzero(~b)] = a[zero : zero + len(b) - m]
                zero, one = zero + len(b) - m, one + m
            a, before = before, a
        return self.alphabet[a] if self.n else np.zeros(0, np.uint32)


def dump(ids: np.ndarray, doc_ids: list[int | None], sizes: list[int]) -> bytes:
    """A shard's file: ids of documents one after another, with their doc_ids (null allowed) and numbers of ids."""
    w = WaveletMatrix.build(ids)
    pack = zstandard.ZstdCompressor(level=1).compress
    index = pack(json.dumps([doc_ids, sizes]).encode())
    frames = [index, pack(w.alphabet.astype("<u4").tobytes()), *(pack(p.tobytes()) for p in w.planes), *(pack(r.tobytes()) for r in w.ranks)]
    head = struct.pack("<4sQI", MAGIC, w.n, w.bits) + struct.pack(f"<{len(frames)}Q", *map(len, frames))
    return head + b"".join(frames)


def load(data: bytes) -> tuple[WaveletMatrix, list[int | None], list[int]]:
    magic, n, bits = struct.unpack_from("<4sQI", data)
    if magic != MAGIC:
        raise ValueError("not a WMX1 file")
    lengths = struct.unpack_from(f"<{2 + 2 * bits}Q", data, 16)
    at, frames = 16 + 8 * len(lengths), []
    unpack = zstandard.ZstdDecompressor().decompress
    for x in lengths:
        frames.append(unpack(data[at : at + x]))
        at += x
    doc_ids, sizes = json.loads(frames[0])
    planes = [np.frombuffer(f, np.uint8) for f in frames[2 : 2 + bits]]
    ranks = [np.frombuffer(f, np.uint32) for f in frames[2 + bits :]]
    return WaveletMatrix(n, planes, ranks, np.frombuffer(frames[1], "<u4")), doc_ids, sizes


#: Words of Latin letters, maybe with marks after them: two pieces at most. An apostrophe could begin a piece of its own.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?|*#%$&]*)")


class Encoder:
    """Ids of whole texts, equal to the tokenizer's own, with a bounded memory of the words met before.

    The vocabulary's first step parts a text at white space, which no piece crosses, so a text's ids are its words' ids
    one after another. Unknown words are encoded together: plain ones with blanks between them, since the ids that end a
    piece part them again, others with a special token between them. Texts with U+001C to
    U+001F, which Python and the tokenizer part differently, or with the text of a special token, go through whole.
    """

    def __init__(self, path: str, most_words: int = 900_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.blanks = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.mark, self.mark_id = next(iter(added.items()))
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        vocab = self.tokenizer.get_vocab()
        closing = np.zeros(max(vocab.values()) + 1, bool)
        closing[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.closing = closing  # ids that end a piece
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.most = most_words

    def _plain_ids(self, text: str) -> list[int]:
        """Ids of plain pieces with blanks between them: nothing is left to normalise or to part but the blanks."""
        t = self.tokenizer
        whole = t.normalizer, t.pre_tokenizer
        t.normalizer, t.pre_tokenizer = None, self.blanks
        try:
            return t.encode(text, add_special_tokens=False).ids
        finally:
            t.normalizer, t.pre_tokenizer = whole

    def _learn(self, words: list[str]) -> None:
        """Encodes unknown words; words met lately but pushed out of `known` come back from `older`."""
        fresh: dict[str, None] = {}
        plain: dict[str, None] = {}
        later: list[tuple[str, str, str]] = []
        for w in words:
            raw = self.older.get(w)
            if raw is not None:
                self.known[w] = raw
                continue
            m = _PLAIN.fullmatch(w)
            if m is None:
                fresh[w] = None
                continue
            # the vocabulary is of lower case, and letters and the marks after them are pieces of their own
            stem, tail = m[1].lower(), m[2]
            if stem != w:
                later.append((w, stem, tail))
            for x in (stem, tail):
                if x and x not in self.known:
                    raw = self.older.get(x)
                    if raw is None:
                        plain[x] = None
                    else:
                        self.known[x] = raw
        width, pieces = self.dtype.itemsize, list(plain)
        for k in range(0, len(pieces), 1000):
            part = pieces[k : k + 1000]
            ids = np.array(self._plain_ids(" ".join(part)), self.dtype)
            cuts = np.flatnonzero(self.closing[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("a plain piece was parted")
            raw, edges = ids.tobytes(), [0, *cuts.tolist()]
            for w, a, b in zip(part, edges, edges[1:], strict=False):
                self.known[w] = raw[a * width : b * width]
        for w, stem, tail in later:
            self.known[w] = self.known[stem] + self.known[tail] if tail else self.known[stem]
        rest = list(fresh)
        for k in range(0, len(rest), 1000):
            part = rest[k : k + 1000]
            ids = np.array(self.tokenizer.encode(self.mark.join(part), add_special_tokens=False).ids, self.dtype)
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) != len(part) - 1:
                raise ValueError("a word held the mark")
            raw, edges = ids.tobytes(), [-1, *cuts.tolist(), len(ids)]
            for w, a, b in zip(part, edges, edges[1:], strict=False):
                self.known[w] = raw[(a + 1) * width : b * width]

    def encode_array(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each followed by `end` if given, and the number of ids of each.

        Words are found and numbered by Arrow, so that Python meets each distinct word of the batch once.
        """
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        odd = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"<\||[\x1c-\x1f]"), False)))
        plain = pc.if_else(pa.array(np.isin(np.arange(len(texts)), odd)), pa.scalar("", texts.type), texts) if len(odd) else texts
        lists = pc.utf8_split_whitespace(pc.fill_null(plain, ""))
        edges = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
        edges = edges - edges[0]
        words, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        rows = list(map(self.known.get, words))
        gaps = [k for k, r in enumerate(rows) if r is None]
        if gaps:
            self._learn([words[k] for k in gaps])
            for k in gaps:
                rows[k] = self.known[words[k]]
        # a batch holds far less than 2 ** 31 ids, unless one text alone does
        kind = np.int32 if texts.nbytes < 1 << 29 else np.int64
        size = np.fromiter(map(len, rows), kind, len(rows)) // kind(self.dtype.itemsize)
        first = np.cumsum(size, dtype=kind) - size
        pool = np.frombuffer(b"".join(rows), self.dtype)
        per = size[at]
        done = np.zeros(len(per) + 1, kind)
        np.cumsum(per, out=done[1:])
        ids = pool[np.repeat(first[at] - done[:-1], per) + np.arange(done[-1], dtype=kind)] if len(at) else np.zeros(0, self.dtype)
        counts = (done[edges[1:]] - done[edges[:-1]]).astype(np.int64)
        if len(odd):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k in odd.tolist():
                parts[k] = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, self.dtype)
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        if end is not None:
            ids, counts = np.insert(ids, np.cumsum(counts), end), counts + 1
        return ids, counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, counts = self.encode_array(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts)[:-1]) if texts else []


_ENCODERS: dict[str, Encoder] = {}
on_other_work("tokens", _ENCODERS.clear)


def encoder(path: str) -> Encoder:
    """One for each worker process; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write(docs: DataFrame, folder: str, *, tokenizer_path: str, end_id: int = END_ID, order: tuple[str, ...] = ("doc_id",), shard_ids: int = SHARD_IDS, partitions: int | None = None) -> DataFrame:
    """Writes all documents in ascending `order` as shard files; returns (file, start, n_ids), a row for each file.

    Documents are dealt by ranges, so that file order is document order; each task writes its own files under a name
    made of its partition and number, first to a temporary name, so a repeated task leaves the same files. A null text
    has only the end id; null ids come first; rows with equal keys are in order of a hash of the text, so that those of
    one id, or without one, don't meet in one task; all stay. An empty table writes no file. Other columns of docs play
    no part. The list of files is a table beside them; the driver holds none of it.
    """
    a = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], F.xxhash64("text").alias("h"))
    keys = [*(f"o{k}" for k in range(len(order))), "h"]
    a = a.repartitionByRange(partitions, *keys) if partitions else a.repartitionByRange(*keys)
    a = a.sortWithinPartitions(*keys).select("doc_id", "text", F.spark_partition_id().alias("p"))

    @lean("tokens")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        store, root = _store(folder)
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        sizes: list[int] = []
        rows: list[tuple[str, int, int, int]] = []
        size, part = 0, -1

        def flush() -> None:
            nonlocal size
            name = f"part-{part:08d}-{len(rows):06d}.wmx"
            data = dump(np.concatenate(held), ids, sizes)
            own = f"{root}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as f:
                f.write(data)
            store.move(own, f"{root}/{name}")
            rows.append((name, part, len(rows), size))
            held.clear(), ids.clear(), sizes.clear()
            size = 0

        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), b.column(1)
            part = b.column(2)[0].as_py() if b.num_rows else part
            _, starts, ends = text_buffer(texts)
            for i, j in groups_of(starts, ends, _TEXT_BYTES, 4096):
                got, counts = enc.encode_array(texts.slice(i, j - i), end_id)
                done, at = 0, 0
                while done < len(counts):
                    ends_at = np.cumsum(counts[done:])
                    k = int(np.searchsorted(ends_at, shard_ids - size, side="right"))
                    if not k and held:
                        flush()
                        continue
                    k = max(1, k)
                    n = int(ends_at[k - 1])
                    held.append(got[at : at + n])
                    ids += doc_ids[i + done : i + done + k]
                    sizes += counts[done : done + k].tolist()
                    size, done, at = size + n, done + k, at + n
        if held:
            flush()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["file", "part", "nth", "n_ids"])

    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    files = a.mapInArrow(run, "file string, part bigint, nth bigint, n_ids bigint")
    files.write.parquet(f"{folder}/_files")
    files = a.sparkSession.read.schema(files.schema).parquet(f"{folder}/_files")
    # one row for each partition goes through one task, its files through the partition's own window
    earlier = (Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("nth").rowsBetween(*earlier)), F.lit(0))
    return files.withColumn("inside", inside).join(parts, "part").select(F.concat(F.lit(f"{folder}/"), "file").alias("file"), (F.col("base") + F.col("inside")).alias("start"), "n_ids")


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder (file, hdfs, s3, gs, ...) and the path in it."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and shard of each document, decoded from the files that write() returned."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("shard", T.StringType())])
    # a number of its own keeps adaptive execution from gathering these small rows, each a file to decode, in one task
    files = shards.select("file", "start").repartition(max(1, min(shards.count(), 100_000)))

    @lean("tokens")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, path = _store(file)
                with store.open_input_stream(path) as f:
                    w, ids, sizes = load(f.read())
                all_ids = w.decode().astype("<u4", copy=False)
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(all_ids[e - n : e]) for e, n in zip(ends.tolist(), sizes, strict=True)]
                own = [pa.array(ids, pa.int64()), pa.array(start + ends - np.array(sizes)), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()), pa.array([path.rsplit("/", 1)[-1]] * len(ids))]
                yield pa.RecordBatch.from_arrays(own, schema.names)

    return files.mapInArrow(run, schema)


def encode(docs: DataFrame, *, tokenizer_path: str, folder: str | None = None, **kw) -> DataFrame:
    """Writes docs and reads them back; see write() and read(). folder: None takes a new one in the shared folder."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    return read(write(docs, folder, tokenizer_path=tokenizer_path, **kw))
