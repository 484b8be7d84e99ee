import duckdb
import pytest
from cairn.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
FIRST = {  # the columns that the contracts fix, and their types
    "op1_langid": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op3_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op4_secrets": [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op5_pii": [("doc_id", "bigint"), ("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op6_quality_rules": [("doc_id", "bigint"), *((k, "bigint") for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", "boolean"), ("kept", "boolean")],
    "op7_token_files": [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")],
    "op10_quality_cnn": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op11_ranked_search": [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")],
    "op12_hard_negatives": [(k, "int" if k == "rank" else "bigint") for k in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")],
    "op13_page_text": [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_and_columns(spark, name):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    got = QUERIES[name](spark, SF)
    rows = got.collect()
    if name in FIRST:
        assert got.dtypes[: len(FIRST[name])] == FIRST[name] and all(v is not None for r in rows for v in r[: len(FIRST[name])])
    if name in ("op11_ranked_search", "op12_hard_negatives", "op13_page_text"):
        assert rows and (name != "op13_page_text" or len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count())
        return
    if name == "op9_decontam":
        assert {r.doc_id for r in rows} <= set(ids)
    else:
        assert sorted(r.doc_id for r in rows) == ids
    for r in rows:
        assert 0 <= r["score"] <= 1 if "score" in got.columns else True
        if name == "op3_toxicity":
            assert r.predicted == int(r.score >= 0.7)
        if name == "op10_quality_cnn":
            assert r.predicted == int(r.score >= 0.5)
        if name == "op6_quality_rules":
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for table in ("benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    want = db.execute(ORACLE[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r) for r in got.select(*names).collect()) == key(want.fetchall())
