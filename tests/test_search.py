import random
import zlib

import numpy as np
from cairn.operators import blocks, pivots
from cairn.operators import search as s
from cairn.operators.embed import HashingEmbedder, embed
from pyspark.sql import functions as F

COLUMNS = "id string, document_id string, pos bigint, title string, text string, source string, date string, url string, content_mode string, metadata string, country string, language string"


def chunks(spark, rows):
    return spark.createDataFrame([(i, i, k, t, x, src, d, "u", "native", "{}", "c", "l") for k, (i, t, x, src, d) in enumerate(rows)], COLUMNS)


def test_case_doubles_and_index_agrees(spark, tmp_path):
    c = chunks(spark, [("a", "", "food market", "s", ""), ("b", "", "food food other words", "s", ""), ("c", "", "nothing", "s", "")])
    once = {r.id: r.bm25 for r in s.lexical_scores(c, s.query_terms(spark, "food")).collect()}
    twice = {r.id: r.bm25 for r in s.lexical_scores(c, s.query_terms(spark, "Food food")).collect()}
    assert twice == {k: 2 * v for k, v in once.items()}
    index = blocks.kept(c, str(tmp_path / "index"), str(tmp_path))
    other = {r.id: r.bm25 for r in blocks.top(index, s.query_terms(spark, "Food food")).collect()}
    assert set(other) == set(twice) and all(abs(other[k] - twice[k]) < 1e-12 for k in twice)


def test_blocks_rank_as_all_chunks_do_and_read_less(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "FIRST_RANGES", 1)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    # neighbouring chunks have words in common, as those of one document do
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(5, 60)) + [f"topic{k // 150}"] * rng.randint(0, 4)) for k in range(3000)]
    c = chunks(spark, [(str(k), "", t, "s", "") for k, t in enumerate(texts)] + [("none", "", "", "s", "")])
    index = blocks.kept(c, str(tmp_path / "index"), str(tmp_path / "absent"))
    assert index.n == 3001 and index.blocks.agg(F.max("n")).first()[0] <= blocks.RANGE
    for question, k in (("topic7 w300", 20), ("w0 topic3 topic3", 10), ("w1 w2 w399", 100), ("w5", 5000), ("absent", 5), ("", 5)):
        terms, log = s.query_terms(spark, question), {}
        got = [(r.id, round(r.bm25, 9)) for r in blocks.top(index, terms, k, log).collect()]
        assert got == [(r.id, round(r.bm25, 9)) for r in s.lexical_top(c, terms, k).orderBy(F.desc("bm25"), "pos").collect()]
        assert log["scored"] <= log["postings"]
        if question == "w0 topic3 topic3":  # elsewhere w0 alone can't reach the tenth score
            assert log["scored"] < 0.3 * log["postings"]
    plan = blocks.top(index, ["w0"], 5)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan


def test_a_kept_index_is_written_anew_when_its_input_changes(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "index")
    source.mkdir()
    (source / "a").write_text("x")
    one = chunks(spark, [("a", "", "food", "s", "")])
    assert blocks.kept(one, path, str(source)).n == 1
    two = chunks(spark, [("a", "", "food", "s", ""), ("b", "", "food", "s", "")])
    assert blocks.kept(two, path, str(source)).n == 1  # as the files are the same
    (source / "b").write_text("y")
    assert blocks.kept(two, path, str(source)).n == 2


def test_accents_and_unspaced_scripts(spark):
    c = chunks(spark, [("m", "", "O preço do açúcar subiu", "s", ""), ("k", "", "帝国工人生活史料汇编", "s", ""), ("h", "", "조선노동자생활사기록", "s", ""), ("x", "", "other", "s", "")])
    for q, want in (("acucar", "m"), ("工人生活", "k"), ("노동자", "h")):
        assert s.lexical_top(c, s.query_terms(spark, q)).first().id == want


def test_fusion_cap_and_top(spark):
    r = lambda *ids: spark.createDataFrame([(i, k + 1) for k, i in enumerate(ids)], "id string, rank int")
    fused = {x.id: x.score for x in s.reciprocal_ranks([r("1", "2"), r("1", "3")]).collect()}
    assert fused["1"] == 2 / 61 and fused["2"] == fused["3"] == 1 / 62
    rows = spark.createDataFrame([("a", 3.0, 1), ("a", 2.0, 2), ("a", 1.0, 3), ("b", 0.5, 4)], "document_id string, score double, seen int")
    assert [x.document_id for x in s.diversified(rows, 3, 2).collect()] == ["a", "a", "b"]
    assert s.diversified(rows, 0, 2).count() == 1 and s.diversified(rows, 3, 0).count() == 0


def test_search_filters_and_prompt(spark):
    c = chunks(spark, [("a", "T1", "food market", "s1", "1898"), ("b", "T2", "food", "s2", "1700"), ("c", "T3", "food", "s1", ""), ("d", "T4", "other", "s1", "1950")])
    e = HashingEmbedder(16)
    v = embed(c, e)
    got = s.search(c, v, "food", e.query("food").tolist(), source="s1", date_to=1900)
    assert {r.id for r in got.collect()} == {"a", "c"}
    text = s.context_prompt("Q?", got).first().prompt
    assert "[S1]" in text and "(undated)" in text and "Document ID: a" in text and "MACHINE TRANSLATION" not in text
    assert s.search(c, v, "", e.query("").tolist(), top_k=2).count() == 2


def test_every_text_has_a_vector_of_length_1(spark):
    e = HashingEmbedder(16)
    sign = lambda w: 1 if zlib.crc32(w.encode()) & 0x80000000 else -1
    words = [f"w{k}" for k in range(200)]
    a, b = next((a, b) for a in words for b in words if zlib.crc32(a.encode()) % 16 == zlib.crc32(b.encode()) % 16 and sign(a) != sign(b))
    rows = spark.createDataFrame([("cancelled", f"{a} {b}"), ("empty", ""), ("blank", " \n"), ("null", None), ("plain", "one two")], "id string, text string")
    got = embed(rows, e).select("id", F.round(F.sqrt(s.dot(F.col("embedding"), F.col("embedding"))), 3).alias("norm")).collect()
    assert {r.id: r.norm for r in got} == dict.fromkeys(["cancelled", "empty", "blank", "null", "plain"], 1.0)
    assert np.linalg.norm(e.query("")) == 1


def clustered(n, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dim)) * 3
    return [(str(k), k, [float(np.float32(x)) for x in centre[k % 12] + rng.normal(size=dim) * 0.3]) for k in range(n)]


def test_pivots_give_the_nearest_and_read_few_blocks(spark, tmp_path):
    rows = clustered(4000)
    v = spark.createDataFrame(rows, "id string, pos bigint, embedding array<float>").repartition(4)
    index = pivots.kept(v, str(tmp_path / "p"), str(tmp_path / "none"), rows=100)
    assert index.blocks.agg(F.max("n")).first()[0] < 400
    for k, q in ((10, rows[7][2]), (100, rows[30][2]), (1, [0.0] * 16), (5000, rows[1][2])):
        log = {}
        got = [(r.id, round(r.dense_score, 9)) for r in pivots.top(index, q, k, log).collect()]
        assert got == [(r.id, round(r.dense_score, 9)) for r in s.dense_top(v, q, k).orderBy("rank").collect()]
        if k == 10:
            assert log["read"] < 0.4 * log["blocks"]


def test_pivots_of_awkward_vectors(spark, tmp_path):
    same = [1.0, 0.0, 2.0]
    rows = [(str(k), k, same) for k in range(300)] + [("short", 300, [5.0]), ("none", 301, None), ("empty", 302, []), ("part", 303, [None, 1.0, None])]
    v = spark.createDataFrame(rows, "id string, pos bigint, embedding array<float>")
    index = pivots.kept(v, str(tmp_path / "p"), rows=20)
    assert index.blocks.agg(F.max("n")).first()[0] < 100  # equal vectors don't meet in one block
    got = [(r.id, r.dense_score) for r in pivots.top(index, [1.0, 1.0, 0.0], 400).collect()]
    assert got == [("short", 5.0), *[(str(k), 1.0) for k in range(300)], ("part", 1.0), ("empty", 0.0)]
    nothing = pivots.kept(v.limit(0), str(tmp_path / "q"), str(tmp_path / "none"))
    assert pivots.top(nothing, [1.0], 5).count() == 0


def test_tokens_and_postings_are_sorted_natively(spark, tmp_path):
    c = chunks(spark, [(str(k), "T", "food market food " + "ab cd " * (k % 3), "s", "") for k in range(300)])
    plan = s.token_runs(c)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "sort_array" in plan  # a comparator in SQL takes most of the time of a build
    index = blocks.kept(c, str(tmp_path))
    got = index.blocks.collect()
    assert all([p.pos for p in r.postings] == sorted(p.pos for p in r.postings) and len(r.postings) == r.n <= blocks.RANGE for r in got)
    assert {r.term: r.df for r in index.terms.collect()} == {"food": 300, "market": 300, "t": 300, "ab": 200, "cd": 200}
