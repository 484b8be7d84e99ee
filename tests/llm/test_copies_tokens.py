import collections
import random
import re
import zlib

import numpy as np
import pytest
from cairn.llm import neardup, tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

PATH = tokens and __import__("cairn.llm.queries", fromlist=["tokenizer_path"]).tokenizer_path()


def family(rng, n, length, change):
    base = ["w%d" % rng.randrange(10**6) for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = list(base)
        for _ in range(rng.randint(0, change)):
            w[rng.randrange(length)] = "v%d" % rng.randrange(10**6)
        out.append(" ".join(w))
    return out


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[i] = (tuple(w), frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    reps = {}
    for i, (w, _) in sorted(sets.items()):
        if w:
            reps.setdefault(w, i)
    ids = sorted(reps.values())
    links = {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(sets[a][1] & sets[b][1]) >= 0.8 * len(sets[a][1] | sets[b][1])}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in [*links, *((i, reps[w]) for i, (w, _) in sets.items() if w)]:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in sets}, collections.Counter(x for p in links for x in p), reps, sets


def test_classes_and_links_equal_brute_force(spark):
    rng = random.Random(7)
    texts = [t for k in range(40) for t in family(rng, rng.randint(1, 6), rng.randint(3, 150), 4)] + family(rng, 120, 200, 9) + ["same words here today again now"] * 30 + ["", None, " \n ", "one", "one", "two"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want, degree, reps, sets = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ends = sum(degree[reps[w]] for w, _ in sets.values() if w)
    for leaf, block in ((12, 512), (4, 16)):  # the second parts the large group into blocks that meet each other
        got = {r.doc_id: r for r in neardup.classes_of(docs, leaf=leaf, block=block).collect()}
        assert len(got) == len(rows)
        assert all(got[i].class_id == want[i] for i in want)
        assert all(got[i].n_links <= degree[reps[w]] for i, (w, _) in sets.items() if w)
        assert sum(got[i].n_links for i, (w, _) in sets.items() if w) >= 0.99 * ends
    assert sorted(r.doc_id for r in neardup.one_of_each(docs).collect()) == sorted(set(want.values()))


def test_repeated_and_null_ids(spark, awkward):
    got = neardup.classes_of(awkward).collect()
    assert len(got) == 9 and {r.class_id for r in got if r.n_copies == 3} == {4}
    kept = neardup.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id, len(r.text or "")) for r in kept.where("doc_id is not null").collect()) == [(1, 0), (2, 0), (4, 51), (5, 17), (6, 1500000), (7, 51), (8, 1)]
    assert kept.where("doc_id is null").count() == 0 and neardup.one_of_each(awkward.limit(0)).count() == 0 and neardup.classes_of(awkward.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(50)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)] + [(200, k) for k in range(201, 260)]
    got = {r.u: r.root for r in neardup.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert all(got.get(x, x) == find(x) for x in root)


def test_many_rows_without_an_id(spark):
    texts = [" ".join(f"w{k % 40}x{i}" for i in range(30)) for k in range(80)] + ["none of these words are twins"] * 20
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    feats = neardup.features(docs)
    wanted = feats.groupBy("node").agg(*[F.first(c).alias(c) for c in ("doc_id", "hash", "sig")])
    assert neardup.shingle_sets(docs, wanted).count() == 41
    assert neardup.classes_of(docs).count() == 100 and neardup.one_of_each(docs).count() == 41


def test_tries_know_the_longest_shared_prefix(spark):
    rng = np.random.default_rng(5)
    sigs = rng.integers(0, 3, (300, neardup.TREES, neardup.PART)).astype(np.uint32)
    rows = [(bytes([k // 256, k % 256]), sigs[k].tobytes()) for k in range(300)]
    for least in (1, 4):
        got = {(r.node, r.t): r.shared for r in neardup.tries(spark.createDataFrame(rows, "node binary, sig binary"), least).collect()}
        edges = 0
        for t in range(neardup.TREES):
            same = (sigs[:, None, t] == sigs[None, :, t]).cumprod(axis=2).sum(axis=2)
            np.fill_diagonal(same, 0)
            for k, want in enumerate(same.max(axis=1).tolist()):
                found = got.get((rows[k][0], t), 0)
                assert found == want or found == neardup.PART or (found == 0 and want < least)
                edges += found == neardup.PART != want
        assert edges <= 2 * 4  # the ends of four ranges


def test_recall_is_measured_by_band():
    none = np.zeros(neardup.BINS)
    assert neardup.measured_recall(none, 4) == neardup.met(0.8, 4) and neardup.measured_recall(none, 6) == neardup.met(0.8, 6)
    low, high = none.copy(), none + 1
    low[0] = 5
    assert abs(neardup.measured_recall(low, 5) - neardup.met(0.8, 5)) < 1e-12
    assert neardup.met(0.8, 5) < neardup.measured_recall(high, 5) < 1


def test_prefix_length_meets_the_recall():
    d = neardup.prefix_length(0.8, 0.9995)
    assert 1 - (1 - 0.8**d) ** neardup.TREES >= 0.9995 > 1 - (1 - 0.8 ** (d + 1)) ** neardup.TREES


def test_block_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 800)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert (neardup._common(sets[:4], sets[4:]) == np.array(want)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=1500))
def test_wavelet_matrix(ids):
    a = np.array(ids, np.uint32)
    w, doc_ids, sizes = tokens.load(tokens.dump(a, [None, 3], [len(a), 0]))
    assert (w.decode() == a).all() and doc_ids == [None, 3] and sizes == [len(a), 0]
    for i in range(0, len(a), 97):
        c = int(a[i])
        assert w.access(i) == c and w.count(c) == (a == c).sum() and w.count(c, i, len(a)) == (a[i:] == c).sum()
        assert w.locate(c) == np.flatnonzero(a == c).tolist()
    assert w.count(70001) == 0
    with pytest.raises(IndexError):
        w.access(len(a))


def test_encoder_equals_the_tokenizer():
    rng = random.Random(4)
    e = tokens.Encoder(PATH, 40)
    alphabet = "aAé́ ñÑßΣσ .,'s't   \x1c\x85\n\t0½²漢字İIı👍​-_<|end>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["a<|endoftext|>b c", "", "The don't   END."]
    for k in range(0, len(texts), 100):
        for t, ids in zip(texts[k : k + 100], e.encode(texts[k : k + 100]), strict=True):
            assert ids.tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_files_round_trip(spark, awkward, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    rows = sorted(awkward.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    got = tokens.encode(awkward, tokenizer_path=PATH, folder=str(tmp_path / "t"), shard_ids=50).orderBy("start").collect()
    at = 0
    for r, g in zip(rows, got, strict=True):
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 2]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len({g.shard for g in got}) > 1
    assert tokens.encode(awkward.limit(0), tokenizer_path=PATH, folder=str(tmp_path / "e")).count() == 0
