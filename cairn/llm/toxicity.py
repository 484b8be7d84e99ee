"""Toxicity: a noisy channel undoes leetspeak, spacing and repetition; the restored words are then scored.

A suspicious piece of text becomes a lattice of letters: each character offers the letters it may stand for with the
cost of that substitution, separators may vanish or part words, and runs of one letter may shrink. Viterbi decoding under a trigram
model of characters, counted over all documents, picks the restored word. A sparse logistic model with non-negative
weights over words and word beginnings, fitted on a bounded labelled sample, scores the plain and restored words.
"""

from __future__ import annotations

import functools
import math
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP_BYTES, groups_of, kept_names, lean, on_other_work, sampled_texts, text_buffer, unused

#: Labelled rows that the word weights are fitted on at most; see also common.SAMPLE_BYTES.
SAMPLE_ROWS = 9_000
#: Toxic sample texts that a word must stand in to get a weight.
LEAST_TEXTS = 3
#: A score from which a text is predicted to be toxic.
THRESHOLD = 0.7

# What a character may stand for besides itself.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
# Letters of other scripts that look like Latin ones.
LOOKALIKES = {"а": "a", "е": "e", "і": "i", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u"}
SEPARATORS = " .-_*~'’,:"
SUBSTITUTED, DROPPED, SHRUNK, PARTED = math.log(0.2), math.log(0.3), math.log(0.3), math.log(0.3)

_CLASSES = 64
_CLASS = np.zeros(0x180, np.uint8)
for _c in range(26):
    _CLASS[97 + _c] = 1 + _c
_others = [c for c in range(0xAA, 0x180) if chr(c).isalpha() and chr(c).lower() == chr(c)]
for _k, _c in enumerate(_others):
    _CLASS[_c] = 27 + _k % 37
_WORD = re.compile(r"[^\W\d_]+")
_MIX = "".join(LEET)
_SINGLE = r"(?!_)[\w" + re.escape("".join(c for c in LEET if not c.isdigit())) + "]"
_SPACED = re.compile(rf"(?<!\w){_SINGLE}(?:[ .\-_*~]{{1,2}}{_SINGLE}){{2,}}(?!\w)")
# Every match of _SPACED holds one of these from its second character on; texts without one are seen more quickly.
_SPACED_PART = re.compile(rf"[ .\-_*~]{_SINGLE}[ .\-_*~]{{1,2}}{_SINGLE}(?:[ .\-_*~]|(?!\w))")
_RUN = re.compile(r"\w+")
_LOOKALIKE = re.compile("[" + "".join(LOOKALIKES) + "]")
_LATIN = re.compile("[a-z]")
_DOUBLE, _TRIPLE = re.compile(r"([^\W\d_])\1"), re.compile(r"([^\W\d_])\1\1")
#: Runs of characters after which decoding fixes the letters that all its states share.
_FIXED = 64
_ENDS = "\"'()[]{}<>.,;:!?-_*~|…“”«»"


def classes_of(text: str) -> np.ndarray:
    """Character classes: 0 no letter, 1 to 26 a to z, 27 to 63 further letters (several may share a class)."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cp < 0x180, _CLASS[np.minimum(cp, 0x17F)], np.uint8(0))


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) as (64, 64, 64), from trigram counts over every character of all documents.

    Each task sums its own table before the exchange; the driver gets 262,144 counts at most. Add-0.1 smoothing.
    """

    @lean("toxicity")
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CLASSES**3, np.int64)
        for b in batches:
            waiting, size = [], 0

            def flush(waiting: list[str]) -> None:
                c = classes_of("  ".join(["", *waiting, ""])).astype(np.int64)
                keys = (c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:]
                np.add(total, np.bincount(keys, minlength=len(total)), out=total)

            for t in b.column(0).to_pylist():
                for k in range(0, len(t or ""), STEP_BYTES):
                    part = t[max(0, k - 2) : k + STEP_BYTES]
                    waiting.append(part)
                    size += len(part)
                    if size >= STEP_BYTES:
                        flush(waiting)
                        waiting, size = [], 0
            if waiting:
                flush(waiting)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["k", "n"])

    got = docs.select("text").mapInArrow(count, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full(_CLASSES**3, 0.1)
    counts[np.asarray(got["k"])] += np.asarray(got["n"])
    counts = counts.reshape(_CLASSES, _CLASSES, _CLASSES)
    return np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)


def options_of(c: str, n: int) -> list[tuple[str, float]]:
    """What n times the character c may stand for: letters and their cost (log-probability of the channel)."""
    out: list[tuple[str, float]] = []
    if c.isalpha():
        out += [(c * n, 0.0)] if n <= 2 else [(c, SHRUNK), (c * 2, SHRUNK * 2)]
        if n == 2:
            out.append((c, SHRUNK * 4))
    for x in LEET.get(c) or LOOKALIKES.get(c, ""):
        out += [(x * n, SUBSTITUTED * n)] if n <= 2 else []
        out += [(x, SUBSTITUTED + SHRUNK)] if n > 1 else []
    if c in SEPARATORS or c in "!|+(" or c.isdigit():
        out.append(("", DROPPED * (1 if c in SEPARATORS else 10)))
    return out or [("", DROPPED * 2)]


@functools.lru_cache(maxsize=4096)
def _coded(c: str, n: int) -> tuple[tuple[str, float, tuple[int, ...]], ...]:
    """options_of() with the classes of the letters."""
    return tuple((letters, cost, tuple(int(_CLASS[ord(ch)]) if ord(ch) < 0x180 else 0 for ch in letters)) for letters, cost in options_of(c, n))


#: The last character model and its numbers as a list, which Python reads faster than an array.
_LISTED: list = [None, []]


def _listed(lm: np.ndarray) -> list[float]:
    if _LISTED[0] is not lm:
        _LISTED[:] = lm, lm.ravel().tolist()
    return _LISTED[1]


def decode(piece: str, lm: np.ndarray, parted: bool = False) -> str:
    """The likeliest letters behind a lower-case piece. Ties take the alphabetically first string.

    parted: a separator may also end a word and begin the next, which a blank in the result shows. The time grows with
    the length of the piece, as letters that all states share are taken out of the comparison.
    """
    runs: list[tuple[str, int]] = []
    for c in piece:
        if runs and runs[-1][0] == c:
            runs[-1] = (c, runs[-1][1] + 1)
        else:
            runs.append((c, 1))
    p_of = _listed(lm)
    # a state is the classes of the last two letters, a * _CLASSES + b
    states: dict[int, tuple[float, str]] = {0: (0.0, "")}
    fixed: list[str] = []
    for i, (c, n) in enumerate(runs):
        if i % _FIXED == _FIXED - 1:
            fixed.append(os.path.commonprefix([x for _, x in states.values()]))
            states = {k: (p, x[len(fixed[-1]) :]) for k, (p, x) in states.items()}
        options = _coded(c, n)
        after: dict[int, tuple[float, str]] = {}
        for ab, (p, s) in states.items():
            for letters, cost, codes in options:
                xy, q = ab, p + cost
                for k in codes:
                    q += p_of[xy * _CLASSES + k]
                    xy = xy % _CLASSES * _CLASSES + k
                old = after.get(xy)
                if old is None or q > old[0] or (q == old[0] and s + letters < old[1]):
                    after[xy] = (q, s + letters)
            if parted and c in SEPARATORS:
                q = p + PARTED + p_of[ab * _CLASSES]
                old = after.get(0)
                if old is None or q > old[0] or (q == old[0] and s + " " < old[1]):
                    after[0] = (q, s + " ")
        states = after
    best = min(((-(p + p_of[ab * _CLASSES]), s) for ab, (p, s) in states.items()), default=(0, ""))
    return "".join(fixed) + best[1]


#: Words or pieces that a memory holds at most; then it begins anew.
_KNOWN_MOST = 200_000


@dataclass
class Known:
    """What has been found of words and tokens; it holds in whatever text they stand, for one model."""

    pieces: dict[str, tuple[str, ...]] = field(default_factory=dict)  # restored words of a piece
    plain: set[str] = field(default_factory=set)  # words that aren't suspicious
    calm: set[str] = field(default_factory=set)  # tokens between blanks that aren't
    weightless: set[str] = field(default_factory=set)  # words that add nothing to a score


def _remember(known: set[str], x: str) -> None:
    if len(x) <= 120:
        if len(known) >= _KNOWN_MOST:
            known.clear()
        known.add(x)


def restored(text: str, lm: np.ndarray, cache: dict[str, tuple[str, ...]], spaced: bool = True, tripled: bool = True, *, words: set[str] | None = None, known: Known | None = None) -> set[str]:
    """The words that decoding finds in the suspicious pieces of a text: mixed, stretched and spaced-out ones, whatever their length.

    words: those of the text, if they are there already; known: what earlier texts have shown.
    """
    low = text.lower()
    words = set(_WORD.findall(low)) if words is None else words
    known = Known() if known is None else known
    pieces, stretched = [], False
    for w in set(low.split()) - known.calm:
        core = w if w.isalpha() else w.strip(_ENDS) if w[:1] not in "@$!|" else w.rstrip(_ENDS)
        if 3 <= len(core) and not core.isalpha() and any(c.isalpha() for c in core) and any(c in _MIX or c in SEPARATORS for c in core):
            pieces.append(core)
        else:
            _remember(known.calm, w)
    for w in words - known.plain:
        if _DOUBLE.search(w):
            pieces.append(w)
            stretched = stretched or bool(_TRIPLE.search(w))
        elif _LOOKALIKE.search(w) and _LATIN.search(w):
            pieces.append(w)
        else:
            _remember(known.plain, w)
    if tripled and stretched:
        pieces += [w for w in set(_RUN.findall(low)) if _TRIPLE.search(w)]
    if spaced and _SPACED_PART.search(low):
        pieces += [m.group(0) for m in _SPACED.finditer(low) if any(c.isalpha() for c in m.group(0))]
    out: set[str] = set()
    for p in pieces:
        got = cache.get(p)
        if got is None:
            got = tuple(decode(p, lm).split())
            if not p.isalpha():  # both readings, as one long word or as several
                got = tuple({*got, *decode(p, lm, True).split()})
            if len(p) <= 120:
                if len(cache) >= _KNOWN_MOST:
                    cache.clear()
                cache[p] = got
        out.update(got)
    return out


@dataclass
class Model:
    lm: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)  # words, and beginnings as ^abcd
    bias: float = -3.0

    def score(self, words: set[str]) -> float:
        w = self.weights
        z = self.bias + sum(w[x] for x in words if x in w)
        heads = {x[:4] for x in words if len(x) > 4} | {x[:5] for x in words if len(x) > 5}
        z += sum(w["^" + h] for h in heads if "^" + h in w)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def features(words: set[str]) -> set[str]:
    return words | {"^" + x[:4] for x in words if len(x) > 4} | {"^" + x[:5] for x in words if len(x) > 5}


def train(samples: list[tuple[str, int]], lm: np.ndarray, *, steps: int = 200) -> Model:
    """Non-negative sparse logistic regression; copies of a text count once. One class only: no word gets a weight."""
    known = Known()
    samples = sorted(dict(reversed(samples)).items())
    n1 = sum(y for _, y in samples)
    n0 = len(samples) - n1
    if not n1 or not n0:
        return Model(lm, {}, 3.0 if n1 else -3.0)
    found = lambda t: features((words := set(_WORD.findall(t.lower()))) | restored(t, lm, known.pieces, words=words, known=known))
    seen: dict[str, int] = {}
    for t, y in samples:
        if y:
            for x in found(t):
                seen[x] = seen.get(x, 0) + 1
    hot = {x: [n, 0] for x, n in seen.items() if n >= LEAST_TEXTS}
    seen.clear()
    rows = [(found(t) & hot.keys(), y) for t, y in samples]
    for f, y in rows:
        if not y:
            for x in f:
                hot[x][1] += 1
    names = sorted(x for x, (a, b) in hot.items() if math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1)) > 2)
    index = {x: k for k, x in enumerate(names)}
    at, of = [], []
    for i, (f, _) in enumerate(rows):
        own = [index[x] for x in f if x in index]
        at += own
        of += [i] * len(own)
    at, of, y = np.array(at, np.int64), np.array(of, np.int64), np.array([v for _, v in rows], float)
    w, b, m, v, mb, vb = np.zeros(len(names)), -3.0, np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for t in range(1, steps + 1):
        z = b + np.bincount(of, w[at], minlength=len(y))
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gw, gb = np.bincount(at, g[of], minlength=len(names)) / len(y) + 2e-5 * w, g.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = 0.1 * math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w = np.maximum(0, w - fix * m / (np.sqrt(v) + 1e-9))
        b -= fix * mb / (math.sqrt(vb) + 1e-9)
    return Model(lm, {x: float(w[k]) for x, k in index.items() if w[k] > 0.05}, float(b))


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The character model from all documents, the word weights from a bounded labelled sample outside the held-out third."""
    return train(sampled_texts(docs, labels, label, sample_rows), character_model(docs))


def suspects(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text: does it hold a letter three times in a row; three single letters between separators?

    A quick look at the bytes: letters of several bytes and what stands for a letter aren't seen. Scores don't rely on it.
    """
    raw, starts, ends = text_buffer(column)
    triple, spaced = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    wide = np.zeros(256, bool)
    wide[65:91] = wide[97:123] = wide[128:] = True
    for i, j in groups_of(starts, ends, STEP_BYTES, 4096):
        for a in range(int(starts[i]), int(ends[j - 1]), STEP_BYTES):
            lo, hi = max(0, a - 80), min(len(raw), a + STEP_BYTES + 80)
            buf = raw[lo:hi]
            if len(buf) < 5:
                buf = np.concatenate([buf, np.full(5, 32, np.uint8)])
            low = buf | np.uint8(32)
            letter = wide[buf]
            t = np.flatnonzero((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & letter[1:-1]) + lo
            # single letters, of one or two bytes, take turns with one or two separators
            first = letter & ~np.concatenate([[False], letter[:-1]])
            stop = letter & ~np.concatenate([letter[1:], [False]])
            edge = starts[i:j] - lo  # texts stand side by side in the buffer
            edge = edge[(edge > 0) & (edge < len(buf))]
            first[edge] |= letter[edge]
            stop[edge - 1] |= letter[edge - 1]
            run, last = np.flatnonzero(first), np.flatnonzero(stop)
            short = (last == run) | ((last - run == 1) & (buf[run] >= 0xC0))
            near = np.concatenate([(run[1:] - last[:-1]) <= 3, [False]]) if len(run) else np.zeros(0, bool)
            s = run[:-2][short[:-2] & short[1:-1] & short[2:] & near[:-2] & near[1:-1]] + lo if len(run) > 2 else np.zeros(0, np.int64)
            for where, flag in ((t, triple), (s, spaced)):
                k = np.searchsorted(starts, where, side="right") - 1
                flag[k[(k >= 0)]] = True
    return triple, spaced


#: What this worker knows of one model's words, from task to task: the model's key and its Known.
_MEMORY: dict[str, Known] = {}
on_other_work("toxicity", _MEMORY.clear)


def score(docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The kept columns of docs with __score (0 to 1) and __predicted; no shuffle, every row stays.

    Whole texts are read. A null or empty text scores the model's bias. Repeated rows get equal scores. Kept columns
    with the names of the results give way.
    """
    keep = kept_names(keep, "__score", "__predicted")
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("__score", T.DoubleType()), T.StructField("__predicted", T.IntegerType())])
    width, key = len(keep), uuid.uuid4().hex

    @lean("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MEMORY:
            _MEMORY.clear()
            _MEMORY[key] = Known()
        known = _MEMORY[key]
        weights = model.weights
        for b in batches:
            out = np.zeros(b.num_rows)
            for i, value in enumerate(b.column(width)):
                t = value.as_py() or ""
                words = set(_WORD.findall(t.lower()))
                words |= restored(t, model.lm, known.pieces, words=words, known=known)
                own: set[str] = set()  # the features that have a weight
                for x in words - known.weightless:
                    some = {f for f in (x, "^" + x[:4] if len(x) > 4 else "", "^" + x[:5] if len(x) > 5 else "") if f in weights}
                    own |= some
                    if not some:
                        _remember(known.weightless, x)
                z = model.bias + math.fsum(weights[f] for f in own)
                out[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(out), pa.array((out >= threshold).astype(np.int32))], schema.names)

    return docs.select(*keep, F.col("text").alias(unused(docs, "text")[0])).mapInArrow(run, schema)
