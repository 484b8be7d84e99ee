import re

import corpus_pipeline as pipeline
import pytest
from cairn.llm import quality_rules


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, items = spark.read.parquet(f"{sf}/labels.parquet"), [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns, seen = docs.columns, []
    for name, f in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        f(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        ids = [r.doc_id for r in after]
        assert len(set(ids)) == len(ids) and set(ids) <= set(before)
        if name == "quality_rules":
            v = {r.doc_id: r["__kept"] for r in quality_rules.verdicts(spark.read.parquet(f"{sf}/documents.parquet"), quality_rules.fit(spark.read.parquet(f"{sf}/documents.parquet"), labels)).collect()}
            assert set(ids) == {i for i, k in v.items() if k}
        if name == "ngram_jaccard_join":
            grams = {}
            for i, r in before.items():
                w = re.findall(r"[^\x20\x09-\x0D]+", r.text)
                grams[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
            near = lambda a, b: len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])
            assert not any(near(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
            assert all(any(near(i, j) for j in before if j != i) for i in set(before) - set(ids))
        if name == "benchmark_decontamination":
            plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
            for i, r in before.items():
                if any(plain(x) in plain(r.text) for x in items):
                    assert i not in ids
        if name == "mixing":
            assert set(ids) == set(before)
            order = [r.doc_id for r in docs.selectExpr("doc_id", "_metadata.file_name AS f", "_metadata.row_index AS r").orderBy("f", "r").collect()]
        if name == "token_files":
            assert [r.doc_id for r in docs.orderBy("start").collect()] == order
        else:
            assert docs.columns == columns
        seen.append(name)
    assert len(seen) == 5


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES])
def test_stage_on_no_rows(spark, stage, tmp_path):
    sf = "/root/testdata/sf0.001"
    assert stage(spark, spark.read.parquet(f"{sf}/documents.parquet").limit(0), sf).count() == 0


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stage_on_awkward_rows(spark, awkward, name, stage, tmp_path):
    """Nulls in all columns, empty and long texts, repeated rows and columns with clashing names."""
    sf = "/root/testdata/sf0.001"
    docs = awkward.withColumnRenamed("score", "__slot").withColumnRenamed("n", "file")
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    stage(spark, docs, sf).write.parquet(str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    ids = sorted(str(r.doc_id) for r in got.collect())
    if name != "token_files":
        assert got.columns == docs.columns
    want = {"quality_rules": None, "ngram_jaccard_join": ["1", "2", "4", "5", "6", "7", "8"]}.get(name, sorted(["1", "2", "4", "4", "5", "6", "7", "8", "None"]))
    assert ids == want if want else not {"1", "2", "8"} & set(ids)
