import json
import os

import duckdb
import pytest
from cairn.files import Files
from cairn.operators import derive, index
from cairn.operators.chunking import chunk_documents
from cairn.operators.embed import HashingEmbedder
from cairn.plans import corpus
from cairn.schemas import as_documents
from cairn.streaming.incremental import chunk_stream, derive_stream, document_stream
from pyspark.sql import functions as F


def docs(spark, n=5, text="Wort eins zwei.", **over):
    rows = [(str(i), "loc_chronicling_america" if i == 1 else "s", f"t{i}", (text + f" {i}") if i != 1 else "To be continued. x", "u", over.get("rights", "Public domain"), over.get("country", "spain"), "es") for i in range(n)]
    return as_documents(spark.createDataFrame(rows, "id string, source string, title string, text string, url string, rights string, country string, language string")).withColumn("pos", F.col("id").cast("bigint"))


def test_build_guard_promote(spark, tmp_path):
    path = str(tmp_path / "index")
    config = index.build(docs(spark).drop("pos"), path, HashingEmbedder(8), country="spain", content_mode="native")
    assert config["chunks"] == 4 and config["excluded_chunks"] == 1 and config["country"] == "spain"
    assert config["integrity"] == {"chunk_rows": 4, "embedding_rows": 4, "embedding_dimensions": 8, "lexical_rows": 4, "lexical_tokens": config["integrity"]["lexical_tokens"]}
    assert [r.pos for r in spark.read.parquet(path + "/chunks").orderBy("document_id").collect()] == [0, 1, 2, 3]
    index.check_index(config, "spain", "native")
    with pytest.raises(ValueError):
        index.check_index(config, "france")
    before = json.load(open(path + "/config.json"))
    with pytest.raises(Exception, match="mismatch"):
        index.build(docs(spark).drop("pos"), path, HashingEmbedder(8), country="france")
    with pytest.raises(ValueError):
        index.build(docs(spark, 0).drop("pos"), path, HashingEmbedder(8))
    assert json.load(open(path + "/config.json")) == before and [p for p in os.listdir(tmp_path) if p.startswith(".") and not p.endswith(".crc")] == []
    os.makedirs(tmp_path / ".index.backup")
    with pytest.raises(RuntimeError):
        index.promote(Files(spark), path, path)
    os.rmdir(tmp_path / ".index.backup")
    with pytest.raises(RuntimeError):  # nothing is staged: the old index comes back
        index.promote(Files(spark), str(tmp_path / "none"), path)
    assert json.load(open(path + "/config.json")) == before
    with pytest.raises(ValueError):
        index.open_index(spark, path, "france")
    assert index.open_index(spark, path, "spain")[0].count() == 4


def test_whole_documents_are_indexed_as_sql_counts_them(spark, tmp_path):
    texts = ["", " ", "\n\n", "one\n\ntwo", "to be continued", " \t\n", "To be continued.\n\nx", "!", "w " * 1_000_001]
    rows = [(k, t, "deen"[k % 2 * 2 :][:2], "s") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus.built_index(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(corpus.ORACLE["built_index"])
    assert got.columns == want.columns and [tuple(r) for r in got.collect()] == want.fetchall() == [(7, 2, 7, 8, 7, "america", "de|en")]
    kept = chunk_documents(spark.createDataFrame([(str(k), t) for k, t in enumerate([*texts[:4], None])], "id string, text string"), None)
    assert sorted((r.document_id, r.ordinal, r.text) for r in kept.collect()) == [("0", 0, ""), ("1", 0, " "), ("2", 0, "\n\n"), ("3", 0, "one\n\ntwo"), ("4", 0, "")]


def upper(batch):
    return [{**r, "title": r["title"].upper()} for r in reversed(batch)]


def test_batches_equal_a_model(spark):
    d = docs(spark, 40, "x" * 50)
    sizes = {r.id: r.n for r in d.select("id", derive.request_size().alias("n")).collect()}
    got = {r.id: (r.batch, r.batch_chars) for r in derive.batches(d, size=4, max_batch=420).collect()}
    want, batch, rows, chars = {}, -1, 0, 0
    for i in map(str, range(40)):
        n = sizes[i]
        if batch < 0 or rows >= 4 or chars + n + 1 > 420:
            batch, rows, chars = batch + 1, 1, n + 2
        else:
            rows, chars = rows + 1, chars + n + 1
        want[i] = batch
    assert {k: b for k, (b, _) in got.items()} == want
    with pytest.raises(Exception, match="too long"):
        derive.batches(d, max_document=10).collect()


def test_ranges_link_to_the_same_batches(spark):
    rows = [(str(i), "abcde"[i * i % 5], i, "x" * (i * 7919 % 160)) for i in range(300)]
    d = spark.createDataFrame(rows, "id string, source string, pos bigint, text string").withColumns({k: F.lit("") for k in ("title", "place", "genre", "language")})
    for group in (None, F.col("source")):
        one = sorted(map(tuple, derive.batches(d, size=6, max_batch=700, group=group).collect()))
        assert len(one) == 300
        for n in (3, 17, 100):
            assert sorted(map(tuple, derive.batches(d, size=6, max_batch=700, group=group, task_rows=n).collect())) == one
    assert derive.batches(d.limit(0)).count() == 0


def test_run_is_resumable_and_idempotent(spark, tmp_path):
    d, m = docs(spark, 7), derive.Method("up", upper)
    run = derive.Run(spark, str(tmp_path))
    assert run.execute(d, m, size=3, limit=4) == 4
    assert derive.Run(spark, str(tmp_path)).execute(d, m, size=3) == 3
    assert derive.Run(spark, str(tmp_path)).execute(d, m) == 0
    changed = d.withColumn("text", F.when(F.col("id") == "2", "new").otherwise(F.col("text")))
    assert derive.Run(spark, str(tmp_path)).execute(changed, m) == 1
    out = derive.Run(spark, str(tmp_path)).table("output")
    assert out.count() == 7 and out.where("source_document_id = '2'").first().text == "new" and out.where("source_document_id = '3'").first().title == "T3"


def test_many_batches_leave_few_files_and_a_small_marker(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derive, "SEGMENTS", 3)
    d, m = docs(spark, 16), derive.Method("up", upper)
    run = derive.Run(spark, str(tmp_path), "spain")
    sizes = []
    for k in range(2):  # every document twice: the second time its text has changed
        now = d.withColumn("text", F.concat("text", F.lit(" " * k + "x" * k)))
        assert run.execute(now, m, size=1) == 16
        sizes.append(len((tmp_path / "marker.json").read_text()))
    assert run.marker["batches"] == 32 and len(run.marker["segments"]) <= 3 and len(os.listdir(tmp_path / "segments")) <= 3
    assert sizes[1] <= sizes[0] + 20 and sum(s["rows"] for s in run.marker["segments"]) <= 32
    again = derive.Run(spark, str(tmp_path), "spain")
    out = again.table("output")
    assert out.count() == 16 and out.where("text LIKE '% x'").count() == 16
    again.compact(most=0)
    assert again.marker["segments"][0]["rows"] == 16 and derive.Run(spark, str(tmp_path)).table("output").count() == 16
    assert again.execute(now, m) == 0
    with pytest.raises(ValueError, match="belongs to spain"):
        derive.Run(spark, str(tmp_path), "france")


def test_bulk_gives_what_one_batch_at_a_time_gives(spark, tmp_path):
    d, m = docs(spark, 30), derive.Method("up", lambda rows: [{**r, "title": r["title"].upper()} for r in reversed(rows)])
    one, all_ = derive.Run(spark, str(tmp_path / "a")), derive.Run(spark, str(tmp_path / "b"))
    assert one.execute(d, m, size=10) == all_.execute(d, m, size=10, bulk=True) == 30
    assert sorted(map(tuple, one.table("output").collect())) == sorted(map(tuple, all_.table("output").collect()))
    assert one.verify() == all_.verify() == 3 and len(all_.marker["segments"]) == 1 and all_.marker["batches"] == 3
    assert all_.execute(d, m, bulk=True) == 0
    with pytest.raises(ValueError, match="ceiling"):
        derive.Run(spark, str(tmp_path / "c")).execute(d, m, bulk=True, max_input=10)


def test_changed_or_repeated_rows_raise(spark, tmp_path):
    run = derive.Run(spark, str(tmp_path / "run"))
    run.execute(docs(spark, 3), derive.Method("up", upper))
    name = run.marker["segments"][0]["name"]
    path = str(tmp_path / "run" / "segments" / name)
    good = spark.createDataFrame(spark.read.parquet(path).collect(), run.ROWS)
    for bad, what in ((good.withColumn("text", F.lit("other")), "has changed"), (good.unionByName(good), "twice in a batch")):
        bad.write.mode("overwrite").parquet(path)
        with pytest.raises(Exception, match=what):
            derive.Run(spark, str(tmp_path / "run")).table("output").collect()
    good.write.mode("overwrite").parquet(path)
    assert run.table("output").count() == 3 and run.verify() == 1


@pytest.mark.parametrize("over", [{"input_sha256": "0"}, {"output_sha256": "0"}])
def test_replies_whose_hashes_differ_raise(spark, tmp_path, over):
    def reply(rows):
        return derive.Reply(**{"rows": rows, "input_sha256": derive.digest(rows), "output_sha256": derive.digest(rows), **over})

    with pytest.raises(RuntimeError, match="hash"):
        derive.Run(spark, str(tmp_path)).execute(docs(spark, 2), derive.Method("m", reply))


@pytest.mark.parametrize("reply", [lambda b: b[:-1], lambda b: b + b[:1], lambda b: [{**r, "x": "1"} for r in b], lambda b: [{**r, "text": 1} for r in b], lambda b: "no", lambda b: [{**r, "id": "z"} for r in b], lambda b: [{"id": r["id"]} for r in b]])
def test_malformed_replies_write_nothing_and_need_a_retry(spark, tmp_path, reply):
    d, run = docs(spark, 2), derive.Run(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        run.execute(d, derive.Method("m", reply))
    again = derive.Run(spark, str(tmp_path))
    assert again.table("output").count() == 0
    with pytest.raises(RuntimeError, match="may have run"):
        again.execute(d, derive.Method("m", upper))
    assert again.execute(d, derive.Method("m", upper), retry=True) == 2


def test_output_is_checked(spark, tmp_path):
    run = derive.Run(spark, str(tmp_path / "run"))
    run.execute(docs(spark, 3), derive.Method("up", upper))
    run.publish(str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    rows = run.table("output")
    for bad in (rows.unionByName(rows), rows.withColumn("id", F.lit("")), rows.withColumn("source_document_id", F.lit("1"))):
        with pytest.raises(RuntimeError, match="refusing"):
            derive.unique_rows(bad)
    for text in ("{", "[]", "{}"):
        (tmp_path / "run" / "marker.json").write_text(text)
        (tmp_path / "run" / ".marker.json.crc").unlink(missing_ok=True)
        with pytest.raises(RuntimeError, match="marker"):
            derive.Run(spark, str(tmp_path / "run"))


def test_validation(spark):
    assert derive.validated(docs(spark), "spain", "es").count() == 5
    for bad in (docs(spark, rights="All rights reserved"), docs(spark, country="france"), docs(spark).unionByName(docs(spark))):
        with pytest.raises(ValueError):
            derive.validated(bad, "spain", "es")


def test_streams(spark, tmp_path):
    docs(spark, 4).drop("pos").write.json(str(tmp_path / "in"))
    chunk_stream(document_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    m = derive.Method("up", upper)
    for k in range(2):
        derive_stream(document_stream(spark, str(tmp_path / "in")), str(tmp_path / "run"), m, str(tmp_path / f"d{k}")).awaitTermination()
    assert derive.Run(spark, str(tmp_path / "run")).table("output").count() == 4


def test_texts_are_shuffled_once_for_the_output_and_not_for_the_state(spark, tmp_path):
    run = derive.Run(spark, str(tmp_path))
    assert run.execute(docs(spark, 6), derive.Method("up", lambda rows: [{**r, "title": r["title"].upper()} for r in rows]), bulk=True) == 6
    plans = {k: run.table(k)._jdf.queryExecution().executedPlan().toString() for k in ("output", "state")}
    assert [p.count("Exchange hashpartitioning") for p in plans.values()] == [1, 1]
    kept = [x for x in plans["state"].splitlines() if "Aggregate" in x]
    assert kept and not any("text" in x or "title" in x for x in kept)
    assert not os.path.exists(tmp_path / "todo")  # a bulk run keeps no second copy of its texts
