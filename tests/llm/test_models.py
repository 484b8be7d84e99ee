import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cairn.llm import decontam, langid, quality_cnn, toxicity
from cairn.llm.common import held_out, sampled_texts, words_of
from pyspark.sql import functions as F

WORDS = {"en": ["the", "thing", "and", "with", "other", "sheep"], "de": ["der", "schlich", "und", "mit", "zweig", "über"], "fr": ["le", "eaux", "et", "avec", "ménage", "où"]}


def corpus(spark, n=300):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        toxic = i % 4 == 0
        bad = i % 5 == 0
        w = [rng.choice(WORDS[lang]) for _ in range(rng.randint(8, 60))]
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scumbag", "loser"]))
        text = " ".join(w)
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if bad else text, lang, int(not bad), int(toxic)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3], r[4]) for r in rows], "doc_id bigint, quality int, toxic int"), rows


def test_split_is_the_contracts(spark):
    got = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


def test_word_hashes_agree_whatever_stands_around():
    s, e, h = words_of(np.frombuffer("ab cd ab\nxab  ab".encode(), np.uint8))
    assert list(s) == [0, 3, 6, 9, 14] and h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


def test_language_on_held_out_rows(spark):
    docs, _, rows = corpus(spark)
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    out = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(got) == len(rows) and sum(got[i]["__lang"] == rows[i][2] for i in out) / len(out) > 0.97
    odd = spark.createDataFrame([(1, "ЖЩЪЫЭЮ ЖЩЪ"), (2, "123 !"), (3, None), (4, "the thing and " * 90_000)], "doc_id bigint, text string")
    r = {x.doc_id: x for x in langid.predict(odd, langid.fit(docs)).collect()}
    assert r[1]["__rejected"] and r[2]["__lang"] == r[3]["__lang"] == "und" and r[4]["__lang"] == "en" and 0 <= r[4]["__score"] <= 1


def test_trigrams_of_long_texts_equal_short_steps(monkeypatch):
    text = "áb cd xyz. " * 500
    whole = next(langid.counted(pa.array([text])))[2]
    monkeypatch.setattr(langid, "STEP_BYTES", 997)
    assert abs(next(langid.counted(pa.array([text])))[2] - whole).sum() <= 12  # a letter of two bytes may be cut at a step


def test_decoding():
    counts = np.full((64, 64, 64), 0.1)
    for w in ("idiot", "stupid", "trash", "moron", "the", "other") * 20:
        c = toxicity.classes_of("  " + w + "  ").astype(int)
        for a, b, d in zip(c, c[1:], c[2:], strict=False):
            counts[a, b, d] += 1
    lm = np.log(counts / counts.sum(axis=2, keepdims=True))
    for piece, word in (("1d10t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("tr@sh", "trash"), ("mooooron", "moron"), ("i d i o t", "idiot")):
        assert toxicity.decode(piece, lm) == word
    assert toxicity.restored("you 1d10t and m o r o n, stuuupid", lm, {}) >= {"idiot", "moron", "stupid"}
    assert toxicity.decode("...", lm) == "" and toxicity.decode("", lm) == ""


def letters(*words):
    counts = np.full((64, 64, 64), 0.1)
    for w in words * 20:
        c = toxicity.classes_of("  " + w + "  ").astype(int)
        for a, b, d in zip(c, c[1:], c[2:], strict=False):
            counts[a, b, d] += 1
    return np.log(counts / counts.sum(axis=2, keepdims=True))


def test_whole_lattice_is_decoded():
    lm = letters("you", "are", "a", "moron", "idiot", "stupid", "the", "other", "idééfixe")
    find = lambda t: toxicity.restored(t, lm, {})
    for text, words in (
        ("you m 0 r 0 n", {"moron"}),
        ("an i d 1 o t.", {"idiot"}),
        ("you are a m o r o n", {"moron"}),
        ("a s t u p i d  m 0 r o n", {"stupid", "moron"}),
        ("the.1d10t", {"the", "idiot"}),
        ("an idiiot", {"idiot"}),
        ("an id" + "i" * 90 + "ot", {"idiot"}),
        ("m o r o n " * 40, {"moron"}),
        ("other-" * 20 + "1d10t", {"other", "idiot"}),
        ("ÉÉÉ idÉÉÉÉfixe", {"idééfixe"}),
    ):
        assert words <= find(text), (text, find(text))
    assert find("1 2 3 4, the other") == set()


def test_decoding_equals_all_paths_of_the_lattice():
    lm = letters("you", "are", "a", "moron", "idiot", "stupid", "the", "other")
    rng = random.Random(6)
    code = lambda ch: int(toxicity._CLASS[ord(ch)]) if ord(ch) < 0x180 else 0
    for _ in range(150):
        piece = "".join(rng.choice("idotmrn10|!@ .-о") for _ in range(rng.randint(1, 7)))
        runs = [(m.group(0)[0], len(m.group(0))) for m in re.finditer(r"(.)\1*", piece)]
        best = None
        for path in itertools.product(*(toxicity.options_of(c, n) for c, n in runs)):
            word = "".join(x for x, _ in path)
            at = [0, 0, *map(code, word), 0]
            p = sum(cost for _, cost in path) + sum(float(lm[a, b, c]) for a, b, c in zip(at, at[1:], at[2:], strict=False))
            best = max(best or (p, word), (p, word), key=lambda x: x[0])
        got = toxicity.decode(piece, lm)
        at = [0, 0, *map(code, got), 0]
        assert got == best[1] or abs(best[0] - max(sum(c for _, c in path) + sum(float(lm[a, b, c]) for a, b, c in zip(at, at[1:], at[2:], strict=False)) for path in itertools.product(*(toxicity.options_of(c, n) for c, n in runs)) if "".join(x for x, _ in path) == got)) < 1e-6


def test_letters_that_look_like_others():
    lm = letters("you", "are", "moron", "idiot", "the", "other")
    assert "moron" in toxicity.restored("you mоrоn", lm, {}) and toxicity.restored("это слово", lm, {}) == set()


def test_long_words_take_linear_work():
    lm = letters("you", "are", "moron", "idiot", "the", "other")
    began = time.time()
    toxicity.restored("ab" * 200_000 + "ccc " + "a.b-" * 20_000 + " " + "x y " * 20_000, lm, {})
    assert time.time() - began < 60


def test_language_scores_equal_brute_force(spark):
    docs, _, rows = corpus(spark)
    model = langid.fit(docs)
    texts = ["the thing and with", "Der Schlich, und", "où", "x", "12 !"]
    table = langid._TABLES
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).orderBy("doc_id").collect()
    for r, text in zip(got, texts, strict=True):
        raw = b" " + text.lower().encode() + b" "
        v = np.zeros(langid.BUCKETS)
        for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
            if langid._LETTER[b]:
                v[int(table[0][a]) ^ int(table[1][b]) ^ int(table[2][c])] += 1
        v *= model.idf
        if not v.any():
            assert r["__lang"] == "und" and r["__score"] == 0
            continue
        sims = model.centroids @ (v / np.linalg.norm(v))
        assert r["__lang"] == model.languages[int(np.argmax(sims))] and abs(r["__score"] - max(0, sims.max())) < 1e-5


def test_network_equals_a_direct_convolution():
    rng = np.random.default_rng(4)
    m = quality_cnn.train([("abc def " * 30, 1), ("x!! " * 40, 0)] * 6, steps=10)
    for n in (0, 5, 700, 769, 3000):
        raw = rng.integers(1, 255, n).astype(np.uint8)
        chunks = []
        step = quality_cnn.CHUNK - quality_cnn.OVERLAP
        for a in range(0, max(1, n - quality_cnn.OVERLAP), step):
            x = np.zeros(quality_cnn.CHUNK, np.uint8)
            x[: len(raw[a : a + quality_cnn.CHUNK])] = raw[a : a + quality_cnn.CHUNK]
            places = [sum(m.tables[k][x[p + k]] for k in range(quality_cnn.WIDTH)) + m.bias for p in range(0, quality_cnn.CHUNK - quality_cnn.WIDTH + 1, quality_cnn.STRIDE)]
            chunks.append(np.maximum(np.max(places, axis=0), 0))
        f = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
        want = 1 / (1 + np.exp(-(f @ m.out[:-1] + m.out[-1])))
        column = pa.array([bytes(raw)], pa.binary())
        assert abs(quality_cnn.scores(column, m)[0] - want) < 1e-4


def test_sample_has_long_texts_and_keeps_its_bound(spark):
    docs = spark.createDataFrame([(i, "w" * (50_000 if i % 2 else 10)) for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id bigint, quality int, toxic int")
    all_rows = sampled_texts(docs, labels, "toxic", 1000)
    assert {len(t) for t, _ in all_rows} == {10, 50_000} and all((len(t) > 10) == bool(y) for t, y in all_rows)
    some = sampled_texts(docs, labels, "toxic", 1000, 120_000)
    assert 50_000 in {len(t) for t, _ in some} and sum(len(t) for t, _ in some) <= 120_000 and len(some) < len(all_rows)


def test_long_pieces_are_decoded_as_a_whole(monkeypatch):
    lm = letters("you", "are", "a", "moron", "idiot", "stupid", "the", "other")
    rng = random.Random(4)
    pieces = ["".join(rng.choice("idotmrn10|! .-") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    got = [toxicity.decode(p, lm, k) for p in pieces for k in (False, True)]
    monkeypatch.setattr(toxicity, "_FIXED", 10**9)
    assert got == [toxicity.decode(p, lm, k) for p in pieces for k in (False, True)]


def test_suspects():
    triple, spaced = toxicity.suspects(pa.array(["aaa b", "a b", None, "x y z", "é é é q", "ab cd ef", "1.1.1", ""]))
    # a text at the edge of its neighbour may be looked at for nothing, but none is missed
    assert triple[0] and spaced[3] and spaced[4] and not triple[5:].any() and not spaced[5:].any()


def test_toxic_and_quality_on_held_out_rows(spark):
    docs, labels, rows = corpus(spark, 600)
    t = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    q = {r.doc_id: r["__score"] for r in quality_cnn.score(docs, quality_cnn.fit(docs, labels)).collect()}
    out = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(t[i]["__predicted"] == rows[i][4] for i in out) / len(out) > 0.97
    assert sum((q[i] >= 0.5) == bool(rows[i][3]) for i in out) / len(out) > 0.97
    hidden = spark.createDataFrame([(1, "the thing and 1d10t with l0ser"), (2, "the thing and other")], "doc_id bigint, text string")
    s = {r.doc_id: r["__score"] for r in toxicity.score(hidden, toxicity.fit(docs, labels)).collect()}
    assert s[1] > 0.7 > s[2]


def test_network_gradient_and_coverage():
    m = quality_cnn.train([("a" * 50, 1), ("b" * 50, 0)] * 8, steps=20)
    assert quality_cnn.scores(pa.array(["a" * 50]), m)[0] > 0.5 > quality_cnn.scores(pa.array(["b" * 50]), m)[0]
    for n in (0, 1, 767, 768, 769, 1440, 1441, 5000):
        c = quality_cnn.chunks_of(np.arange(n).astype(np.uint8) | 1)
        assert (c != 0).any(axis=1).all() or n == 0
        step = quality_cnn.CHUNK - quality_cnn.OVERLAP
        assert (len(c) - 1) * step + quality_cnn.CHUNK >= n
    one = quality_cnn.scores(pa.array(["x" * 9000, None, "", "x" * 9000]), m)
    assert one[0] == one[3] and one[1] == one[2]


def test_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(0, 20)), rng.integers(0, 5, rng.integers(0, 20))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert decontam.common_subsequence(a, b) == t[-1, -1]


def leaky(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["th", "er", "an", "ou", "st", "le"]) for _ in range(rng.randint(2, 4)))
    items = [(k, " ".join(word() for _ in range(rng.randint(15, 60)))) for k in range(30)]
    docs, truth = [], set()
    for i in range(200):
        w = [word() for _ in range(rng.randint(0, 300))]
        if i % 5 == 0:
            k = rng.randrange(30)
            own = items[k][1].split()
            if i % 10 == 0:  # a paraphrase: some words changed, one in six left out
                own = [x if rng.random() > 0.12 else word() for x in own if rng.random() > 0.06]
            at = rng.randrange(len(w) + 1)
            w[at:at] = own
            truth.add((i, k))
        docs.append((i, " ".join(w).capitalize() + "."))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), truth


def test_leaks(spark):
    docs, items, truth = leaky(spark)
    got = {(r.doc_id, x.item_id) for r in decontam.search(docs, decontam.fit(docs, items)).collect() for x in r["__leaks"]}
    exact = {(i, k) for i, k in truth if i % 10}
    assert exact <= got <= truth and len(got & truth) >= 0.9 * len(truth)
    assert {r.doc_id for r in decontam.clean(docs, items).collect()} == set(range(200)) - {i for i, _ in got}


def test_overlaps_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, region = rng.integers(0, 6, rng.integers(1, 12)), rng.integers(0, 9, rng.integers(0, 60))
        held, width = np.flatnonzero(np.isin(region, item)), decontam._width(len(item))
        want = [sum(min(int((region[k : k + width] == x).sum()), int((item == x).sum())) for x in set(item.tolist())) for k in held]
        assert decontam._overlaps(item, region[held], held, width).tolist() == want


def test_overlap_of_regions_is_the_most_of_their_spans(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(3, 20)))) for k in range(12)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id bigint, text string")
    model = next(decontam.fit(docs, spark.createDataFrame(items, "item_id bigint, text string")))
    h = decontam._hashes(" ".join(rng.choice([*words, "x", "y", "z"]) for _ in range(400)))
    regions = [(k % len(model.words), a, a + rng.randint(1, 90)) for k, a in enumerate(rng.randrange(300) for _ in range(200))]
    item, start, stop = (np.array(x) for x in zip(*regions, strict=True))
    width = np.array([decontam._width(len(model.words[i])) for i in item])
    got = decontam.most_overlap(h, start, stop, item, width, model)
    for k, (i, a, b) in enumerate(regions):
        region = h[a:b]
        held = np.flatnonzero(np.isin(region, model.words[i]))
        want = decontam._overlaps(model.words[i], region[held], held, int(width[k])).max() if len(held) else 0
        assert got[k] == want


def test_best_span_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(150):
        n = int(rng.integers(3, 14))
        item, region, answer = rng.integers(0, 8, n), rng.integers(0, 9, rng.integers(1, 80)), int(rng.integers(0, n))
        spans = [region[k : k + decontam._width(n)] for k in range(len(region))]
        both = [(decontam.common_subsequence(item, x) / n, decontam.common_subsequence(item[answer:], x) / (n - answer)) for x in spans]
        got = decontam._checked(item, answer, region, 0, len(region))
        assert decontam._leaked(*got) == any(decontam._leaked(*x) for x in both)
        if decontam._leaked(*got):
            assert got[0] == max(x[0] for x in both if decontam._leaked(*x))


@pytest.mark.parametrize("run", [60, 400])
def test_leak_beside_a_run_of_one_of_its_words(spark, run):
    item = "alpha de bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november"
    rows = [(0, "de " * run + item), (1, item + " de" * run), (2, "de " * run)] + [(10 + i, f"word{i} other{i % 7} de") for i in range(60)]
    docs, items = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = {r.doc_id: r["__leaks"][0] for r in decontam.search(docs, decontam.fit(docs, items)).collect()}
    assert sorted(got) == [0, 1] and all(x.lcs == 1 for x in got.values())


def test_many_scans_find_the_same(spark, monkeypatch):
    docs, items, _ = leaky(spark)
    pairs = lambda models: {(r.doc_id, x.item_id) for r in decontam.search(docs, models).collect() for x in r["__leaks"]}
    one, kept = pairs(decontam.fit(docs, items)), {r.doc_id for r in decontam.clean(docs, items).collect()}
    monkeypatch.setattr(decontam, "SCAN_ITEMS", 10)
    assert pairs(decontam.fit(docs, items)) == one and {r.doc_id for r in decontam.clean(docs, items).collect()} == kept
    assert len(list(decontam.fit(docs, items))) > 1 and not list(decontam.fit(docs, items.limit(0)))


def test_equal_and_missing_item_ids(spark):
    texts = ["one two three four five six seven eight nine ten", "red green blue white black pink brown grey gold lime", "a1 b2 c3 d4 e5 f6 g7 h8 i9 j0 k1"]
    docs = spark.createDataFrame([(k, f"some words before {t} and some after") for k, t in enumerate(texts)] + [(9, "nothing of it")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[2])], "item_id bigint, text string")
    got = {r.doc_id: r["__leaks"][0].item_id for r in decontam.search(docs, decontam.fit(docs, items)).collect()}
    assert got == {0: 1, 1: 1, 2: None}


def test_a_long_text_counts_once(spark, monkeypatch):
    from cairn.llm import common

    monkeypatch.setattr(decontam, "STEP_BYTES", 1000)
    monkeypatch.setattr(decontam, "OVERLAP", 100)
    docs = spark.createDataFrame([(1, "alpha beta " * 400), (2, "alpha"), (3, None), (4, "gamma " * 500)], "doc_id bigint, text string")
    column = docs.toArrow()["text"].combine_chunks()
    assert sum(1 for _ in decontam._steps(column)) > 5
    frequency, n = decontam.document_frequencies(docs)
    place = lambda w: int(decontam._hashes(w)[0]) & (decontam.BUCKETS - 1)
    assert (frequency[place("alpha")], frequency[place("beta")], frequency[place("gamma")], n) == (2, 1, 1, 4) and common.STEP_BYTES > 1000


def test_passages_cover_the_item():
    w = [f"w{i}é" for i in range(200)]
    for n in (1, 63, 64, 65, 80, 81, 200):
        whole, *parts = decontam._passages("-- " + ", ".join(w[:n]) + ".")
        assert whole.startswith("-- w0") and bool(parts) == (n > 64) and (not parts or {x for p in parts for x in p.split(", ")} == set(w[:n]))


@pytest.mark.parametrize("n", [200, 600, 1000])
def test_leaks_of_long_items(spark, n):
    rng = random.Random(n)
    syllables = ["th", "er", "an", "ou", "st", "le", "mi", "ka", "ro", "su"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(4))
    items = [[word() for _ in range(n)] for _ in range(4)]
    docs, truth = [(100 + i, " ".join(word() for _ in range(300))) for i in range(40)], set()
    for i, item in enumerate(items):
        own = [x if rng.random() > 0.3 else word() for x in item]  # seven words in ten stay, in order
        for k, leak in ((2 * i, item), (2 * i + 1, own)):
            docs.append((k, " ".join([word() for _ in range(57)] + leak + [word() for _ in range(90)])))
            truth.add((k, i))
    docs, items = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    assert {(r.doc_id, x.item_id) for r in decontam.search(docs, decontam.fit(docs, items)).collect() for x in r["__leaks"]} == truth


def dense(texts, weights, feats):
    out = np.zeros((len(texts), len(feats)))
    for k, (at, v) in enumerate(decontam._vectors(pa.array(texts), weights)):
        p = np.searchsorted(feats, at)
        ok = (p < len(feats)) & (feats[np.minimum(p, len(feats) - 1)] == at)
        out[k, p[ok]] = v[ok]
    return out


def test_svd_equals_the_dense_one(spark):
    _, items, _ = leaky(spark)
    texts = [r.text for r in items.collect()]
    weights = np.ones(decontam.BUCKETS)
    rows = spark.createDataFrame([(3.0, t) for t in texts[:10]] + [(1.0, t) for t in texts[10:]], "weight double, text string").repartition(4)
    feats, basis = decontam.randomised_svd(rows, weights, 8)
    a = dense(texts, weights, feats)
    a[:10] *= 3
    assert basis.shape == (len(feats), 8) and np.allclose(basis.T @ basis, np.eye(8), atol=1e-4)
    best = (np.linalg.svd(a)[1][:8] ** 2).sum()
    assert 0.97 * best <= ((a @ basis) ** 2).sum() <= best * 1.0001


def test_sums_of_groups_equal_plain_ones():
    rng = np.random.default_rng(4)
    for rank in (0, 1, 108):
        table = np.vstack([rng.standard_normal((300, rank)), np.zeros((1, rank))]).astype(np.float32)
        for sizes in ([], [1], [1, 2, 3, 4, 5, 31, 32, 33, 64, 65, 1024, 1025, 3000], rng.integers(1, 40, 500).tolist(), [1] * 5000):
            group = np.repeat(rng.permutation(6000)[: len(sizes)], sizes).astype(np.int64)
            at = rng.integers(0, 301, len(group))
            out, want = np.ones((6000, rank)), np.ones((6000, rank))
            np.add.at(want, group, table[at])
            decontam._summed(table, at, group, out)
            assert np.allclose(out, want, atol=1e-3)


def test_sums_of_many_small_groups_are_fast():
    table = np.vstack([np.random.default_rng(5).standard_normal((20_000, 108)), np.zeros((1, 108))]).astype(np.float32)
    group = np.repeat(np.arange(20_000), 3)
    at, out = group[::-1] * 7919 % 20_000, np.zeros((20_000, 108))

    def seconds(f):
        took = []
        for _ in range(3):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    # numpy pays for each group of a reduceat over rows, not only for its rows
    assert seconds(lambda: decontam._summed(table, at, group, out)) < 0.7 * seconds(lambda: np.add.reduceat(table[at], np.arange(0, 60_000, 3), axis=0))


def test_candidates_equal_brute_force(spark):
    docs, items, _ = leaky(spark)
    model = next(decontam.fit(docs, items))
    for own, h, of in decontam._steps(pa.array([r.text for r in docs.orderBy("doc_id").limit(60).collect()])):
        count = np.bincount(of, minlength=len(own))
        got = {(int(d), int(k), int(i)): float(c) for d, k, i, c in zip(*decontam.candidates(h, of, count, model), strict=True)}
        want, first = {}, np.concatenate([[0], np.cumsum(count)[:-1]])
        for d in range(len(own)):
            for k in range(-(-int(count[d]) // 16)):
                at = (h[first[d] : first[d] + count[d]][16 * k : 16 * k + 32] & np.uint64(decontam.BUCKETS - 1)).astype(np.int64)
                half = [(at[:16] if x == 0 else at[16:]) for x in (0, 1)]
                norm = np.sqrt(sum((model.weights[x] ** 2).sum() for x in half))
                sims = model.basis[model.rows[at]].sum(axis=0) @ model.latent.T / max(norm, 1e-9)
                for i in np.flatnonzero(sims >= 0.25 * model.least):
                    want[d, k, int(i)] = float(sims[i])
        assert got.keys() ^ want.keys() <= {x for x in got.keys() | want.keys() if abs((got.get(x) or want[x]) - 0.25 * model.least[x[2]]) < 1e-4}
        assert all(abs(got[x] - want[x]) < 1e-4 for x in got.keys() & want.keys())
        assert model.latent.shape[1] <= len(model.owner) // 2


def test_latent_space_finds_synonyms_that_shared_words_miss(spark):
    rng = random.Random(6)
    # each concept has two words, which the documents use side by side; each topic has twelve concepts
    topics = [[(f"car{t}x{c}", f"auto{t}x{c}") for c in range(12)] for t in range(30)]
    docs = [(n, " ".join(w for c in rng.sample(topics[n % 30], 10) for w in rng.sample(c, 2))) for n in range(900)]
    items = [(t, " ".join(c[0] for c in topic)) for t, topic in enumerate(topics)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = next(decontam.fit(frame, spark.createDataFrame(items, "item_id bigint, text string")))
    other = [" ".join(c[1] for c in topic) for topic in topics]  # no word in common with the item
    found = hit = 0
    for own, h, of in decontam._steps(pa.array(other)):
        d, _, passage, _ = decontam.candidates(h, of, np.bincount(of, minlength=len(own)), model)
        pairs = {(int(own[a]), model.ids[model.owner[b]]) for a, b in zip(d, passage, strict=True)}
        hit += len({a for a, b in pairs if a == b})
        found += len(pairs)
    assert hit >= 27 and found <= 300
    weights = np.ones(decontam.BUCKETS)
    feats = np.unique(np.concatenate([a for a, _ in decontam._vectors(pa.array([t for _, t in items] + other), weights)]))
    assert (np.diag(dense([t for _, t in items], weights, feats) @ dense(other, weights, feats).T) < 0.1).all()


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_rows(spark, awkward, labels, empty):
    docs, labs = (awkward.limit(0), labels.limit(0)) if empty else (awkward, labels)
    n = 0 if empty else 9
    items = spark.createDataFrame([(1, "the cat sat on the mat and the dog ran away from it"), (1, None), (None, "x y z"), (2, "")], "item_id bigint, text string")
    taken = docs.withColumns({"__lang": F.lit(1), "__SCORE": F.lit(2), "text_": F.lit(3), "letters": F.lit(4)})
    for a in (langid.predict(taken, langid.fit(taken), keep=tuple(taken.columns)), toxicity.score(taken, toxicity.fit(taken, labs), keep=tuple(taken.columns)), quality_cnn.score(taken, quality_cnn.fit(taken, labs), keep=tuple(taken.columns))):
        assert len({c.lower() for c in a.columns}) == len(a.columns) and a.count() == n and (empty or a.first()["letters"] == 4)
    assert langid.predict(docs, langid.fit(docs), keep=tuple(docs.columns)).count() == n
    assert toxicity.score(docs, toxicity.fit(docs, labs), keep=tuple(docs.columns)).count() == n
    assert quality_cnn.score(docs, quality_cnn.fit(docs, labs), keep=tuple(docs.columns)).count() == n
    found = decontam.search(docs, decontam.fit(docs, items), keep=("doc_id", "score")).collect()
    assert sorted(str(r.doc_id) for r in found) == ([] if empty else ["4", "4", "None"])
    assert decontam.clean(docs, items).count() == (0 if empty else 6)
    assert decontam.clean(docs, items.limit(0)).count() == n and decontam.clean(docs, items).columns == docs.columns


def test_leaks_of_items_of_any_id_and_length(spark):
    rng = random.Random(11)
    word = lambda low=3, high=9: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high)))
    long = " ".join(word(90, 110) for _ in range(800))  # about 80 KB
    short = " ".join(word() for _ in range(40))
    filler = [word() for _ in range(3000)]
    fill = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    before = fill(140_000)
    before = before[: (1 << 20) - len(long) // 2]  # the item stands across the end of the first step
    docs = spark.createDataFrame([(1, f"{before} {long} {fill(500)}"), (2, fill(300)), (3, f"{fill(50)} {short} {fill(50)}")], "doc_id bigint, text string")
    bench = spark.createDataFrame([("q-1", long), ("", short), (None, "nothing of this is there at all")], "item_id string, text string")
    got = sorted((r.doc_id, x.item_id) for r in decontam.search(docs, decontam.fit(docs, bench)).collect() for x in r["__leaks"])
    assert got == [(1, "q-1"), (3, "")]
    assert sorted(r.doc_id for r in decontam.clean(docs, bench).collect()) == [2]


def test_basis_is_fitted_on_all_passages(spark, monkeypatch):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    texts = [" ".join(rng.choice(words[n % 5 * 30 :][:40]) for _ in range(rng.choice([0, 5, 32, 33, 200]))) for n in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = [" ".join(rng.choice(words) for _ in range(20)) for _ in range(12)]
    monkeypatch.setattr(decontam, "CORPUS_WEIGHT", 100)
    seen = {}
    real = decontam.randomised_svd
    monkeypatch.setattr(decontam, "randomised_svd", lambda rows, *a: seen.setdefault("svd", (a[0], *real(rows, *a)))[1:])
    next(decontam.fit(docs, spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")))
    weights, feats, basis = seen["svd"]
    passages = [(" ".join(w[k : k + 32]), (100 / 150 / -(-len(w) // 32)) ** 0.5) for w in (t.split() for t in texts) for k in range(0, len(w), 32)]
    assert len(passages) > 300  # a document weighs 1 and all of them 100, whatever their length
    a = np.vstack([3 * dense(items, weights, feats), np.array([[w] for _, w in passages]) * dense([t for t, _ in passages], weights, feats)])
    best = (np.linalg.svd(a)[1][: basis.shape[1]] ** 2).sum()
    assert 0.97 * best <= ((a @ basis) ** 2).sum() <= best * 1.0001
    # the last Gram matrix is that of all passages: the directions stand in its order and don't mix
    gram = (a @ basis).T @ (a @ basis)
    assert np.abs(gram - np.diag(np.diag(gram))).max() < 1e-4 * gram.max()


def test_passages_hold_every_word_once(spark, monkeypatch):
    monkeypatch.setattr(decontam, "STEP_BYTES", 1000)  # a long text comes in steps, which begin new windows
    texts = [None, "", "a b a", " ".join(f"w{k % 70}" for k in range(2000)), "x" * 5000 + " y", " ".join(["z"] * 40)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    found, total = np.zeros(decontam.BUCKETS, np.int64), 0.0
    for r in decontam.windows(docs).collect():
        codes = np.frombuffer(r.words, np.uint32)
        assert codes[0] & decontam._FIRST and ((codes & decontam._FIRST) != 0).sum() <= 64
        total += r.share * ((codes & decontam._FIRST) != 0).sum()
        np.add.at(found, codes & np.uint32(decontam.BUCKETS - 1), (codes & ~decontam._FIRST) >> np.uint32(18))
    want = np.zeros(decontam.BUCKETS, np.int64)
    for t in texts:
        np.add.at(want, (decontam._hashes(t or "") & np.uint64(decontam.BUCKETS - 1)).astype(np.int64), 1)
    assert (found == want).all() and abs(total - 4) < 1e-9  # a document with words weighs 1


def test_known_words_and_tokens_are_looked_at_once(monkeypatch):
    lm = np.zeros((64, 64, 64), np.float32)
    text = "plain words, a b and m o r o n 1d10t stuuupid good (calm) 12:30"
    known = toxicity.Known()
    first = toxicity.restored(text, lm, known.pieces, known=known)
    looked = []
    real = toxicity._DOUBLE
    monkeypatch.setattr(toxicity, "_DOUBLE", type("Seen", (), {"search": staticmethod(lambda w: looked.append(w) or real.search(w))}))
    monkeypatch.setattr(toxicity, "decode", None)  # nothing is decoded again
    assert toxicity.restored(text, lm, known.pieces, known=known) == first == toxicity.restored(text, lm, known.pieces, known=known)
    assert set(looked) == {"stuuupid", "good"} and {"plain", "words,", "(calm)", "12:30"} <= known.calm


def test_every_spaced_word_is_seen():
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice("ab1é .-_*~$(,\n") for _ in range(rng.randint(3, 14)))
        assert not toxicity._SPACED.search(t) or toxicity._SPACED_PART.search(t)
