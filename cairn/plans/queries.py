"""The library's operators over the driver tables, and the same results in DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import classify, text
from ..operators import audit, blocks, chunking, derive, pivots, search
from ..session import shared_folder
from ..sources import bronze, catalogue, harvest, markup
from . import corpus

QUESTION = "the thing and the erhation of That"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cycle(values: list[str], key: str = "doc_id"):
    """A column that takes the values in turn by key."""
    return F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_cycle(values: list[str], key: str = "doc_id") -> str:
    return f"{_sql_list(values)}[{key} % {len(values)} + 1]"


DATES = ["1898-05-01", "unknown", "about 1723, again 1650", "", "2031", "12 May 1901"]
RIGHTS = ["Public Domain", "All rights reserved", "not in the public domain", "CC BY-SA 4.0", "dominio público", "CC BY-ND, no derivatives", " Gemeinfrei ", ""]
TITLES = ["A novel of the sea", "Annual report of the mines", "Letters of a farmer", "The Literary Magazine", "Daily Tribune", "Hymns and psalms", "Untitled"]
SUBJECTS = ["Domestic fiction", "Labor -- Social conditions", "Novelty goods", "", "Poetry", "History"]
SHELF = ["PZ3 .A1", "HD8051 .A2", "PS1000 .A1", "", "e 178"]
GENRES = ["Newspapers", "Periodicals", ""]
MARKS = ["CHAPTER XII\nfoo", "To be continued.", "copyright 1899 by x", "copyrighted, 1901 by y; continued from last week", "plain prose", "Poetry\nroses"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table in the shape of the corpus: ids, titles, dates and rights are derived from doc_id."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"), "doc_id", "source", _cycle(TITLES).alias("title"), "text", F.concat(F.lit("https://example.org/"), "doc_id").alias("url"),
        _cycle(DATES).alias("date"), _cycle(RIGHTS).alias("rights"), F.lit("").alias("place"), F.lit("").alias("genre"), F.lit("america").alias("country"), F.col("lang").alias("language"),
        F.lit("native").alias("content_mode"), F.lit("{}").alias("metadata"), F.col("doc_id").alias("pos"),
    )


def clean_texts(spark, d):
    x = F.concat(F.lit(" pre-\nfix\r\n"), F.replace("text", F.lit(". "), F.lit("-\n")), F.lit("\t\tend \n\n\n\n "), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", F.md5(text.clean_text(x)).alias("h"), F.length(text.clean_text(x)).cast("bigint").alias("n"))


def stable_ids(spark, d):
    c = text.canonical_json(id=F.col("doc_id").cast("string"), text=F.col("text"), language=F.col("lang"))
    return table(spark, d, "documents").select("doc_id", text.stable_id(F.col("doc_id"), F.col("source"), F.col("text")).alias("sid"), F.sha2(c, 256).alias("h"), F.length(c).cast("bigint").alias("chars"))


def years(spark, d):
    a = table(spark, d, "documents").withColumn("date", _cycle(DATES))
    y, e = text.first_year(F.col("date")), text.earliest_year(F.array("date", F.lit("1999-2005")))
    return a.select("doc_id", y.alias("first"), e.alias("earliest"), F.coalesce(y.between(1700, 1929), F.lit(True)).alias("kept_if_unknown"), F.coalesce(y <= 1929, F.lit(False)).alias("dropped_if_unknown"))


def search_terms(spark, d):
    a = table(spark, d, "documents").select("doc_id", F.concat(F.lit("工人生活 가나 "), "text").alias("t"))
    w = text.search_terms(F.col("t"))
    return a.select("doc_id", F.size(w).cast("bigint").alias("n"), F.md5(F.array_join(w, "|")).alias("h"))


def word_chunks(spark, d):
    """Every document as one paragraph, in windows of 50 words that overlap by 10."""
    a = table(spark, d, "documents").select("doc_id", text.strip(F.regexp_replace("text", "[ \n]+", " ")).alias("t"))
    a = a.select(F.col("doc_id").cast("string").alias("id"), F.col("t").alias("text"))
    c = chunking.chunk_documents(a, 50, 10)
    return c.select("document_id", "ordinal", "id", F.md5("text").alias("h"))


def packed_chunks(spark, d):
    """Lines as paragraphs, packed to 60 words with 12 carried over."""
    a = table(spark, d, "documents").select("doc_id", F.posexplode(chunking.chunk_texts(F.replace("text", F.lit("\n"), F.lit("\n\n")), 60, 12)).alias("ordinal", "c"))
    return a.select("doc_id", "ordinal", F.size(text.words(F.col("c"))).cast("bigint").alias("n_words"), F.md5(F.col("c")).alias("h"))


def rights(spark, d):
    return table(spark, d, "documents").withColumn("r", _cycle(RIGHTS)).select("doc_id", classify.rights_eligible(F.col("r")).alias("ok"))


def book_decisions(spark, d):
    a = table(spark, d, "part").select("p_partkey", _cycle(TITLES, "p_partkey").alias("t"), F.array(_cycle(SUBJECTS, "p_partkey"), "p_type").alias("s"), F.array(_cycle(SHELF, "p_partkey")).alias("c"))
    x = classify.book_decision(F.col("t"), F.col("s"), F.col("c"))
    return a.select("p_partkey", x["status"].alias("status"), x["confidence"].alias("confidence"), F.size(x["reasons"]).cast("bigint").alias("n_reasons"))


def periodical_decisions(spark, d):
    a = table(spark, d, "part").select("p_partkey", _cycle(TITLES, "p_partkey").alias("t"), F.array(_cycle(SUBJECTS, "p_partkey")).alias("s"), F.array(_cycle(GENRES, "p_partkey")).alias("g"))
    x = classify.periodical_decision(F.col("t"), F.col("s"), F.col("g"), F.array("t"))
    return a.select("p_partkey", x["status"].alias("status"), F.array_join(classify.review_reasons(F.col("t"), F.col("s")), "; ").alias("review"))


def serial_decisions(spark, d):
    x = classify.serial_decision(F.concat(_cycle(MARKS), F.lit("\n"), F.col("text")))
    return table(spark, d, "documents").select("doc_id", x["status"].alias("status"), x["confidence"].alias("confidence"))


def field_coverage(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("record"), F.explode(F.map_from_arrays(F.array(F.lit("type"), F.lit("k"), F.lit("odd")), F.array("event_type", F.get_json_object("props", "$.k"), F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.lit(""))))).alias("field", "v"))
    return audit.field_coverage(e.select("record", "field", F.when(F.col("v").isNotNull(), F.to_json(F.struct("v")).substr(F.lit(6), F.length(F.to_json(F.struct("v"))) - 6)).alias("value")))


def frequent_values(spark, d):
    e = table(spark, d, "events").select(F.lit("hour").alias("field"), F.date_format("ts", "yyyy-MM-dd HH").alias("value"), F.col("event_id").alias("pos"))
    t = table(spark, d, "events").select(F.lit("type").alias("field"), F.col("event_type").alias("value"), F.col("event_id").alias("pos"))
    return audit.frequent_values(e.unionByName(t)).select("field", "value", "n", F.col("nth").cast("bigint").alias("nth"))


def _query_vector(spark, d) -> list[float]:
    return list(table(spark, d, "embeddings").where("vec_id = 7").select("embedding").first()[0])


def dense_topk(spark, d):
    v = table(spark, d, "embeddings").withColumn("pos", F.col("vec_id"))
    top = search.dense_top(v, _query_vector(spark, d), 50, key="vec_id")
    return top.select("vec_id", F.round("dense_score", 6).alias("dense_score"), F.col("rank").cast("bigint").alias("rank"))


def dense_pivots(spark, d):
    """The same from a stored index of blocks around pivots, of which blocks that can't matter aren't read."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("vec_id").alias("pos"), "embedding")
    index = pivots.kept(v, f"{shared_folder(spark)}/pivot-index", f"{d}/embeddings.parquet", rows=256)
    top = pivots.top(index, _query_vector(spark, d), 50)
    return top.select(F.col("id").alias("vec_id"), F.round("dense_score", 6).alias("dense_score"))


def bm25_topk(spark, d):
    c = documents(spark, d)
    top = search.lexical_top(c, search.query_terms(spark, QUESTION))
    return top.select("id", F.round("bm25", 6).alias("bm25"))


def _lexical_index(spark, d) -> blocks.BlockIndex:
    """The stored index of all documents; the first query that needs it writes it."""
    return blocks.kept(documents(spark, d), f"{shared_folder(spark)}/lexical-index", f"{d}/documents.parquet")


def lexical_index(spark, d):
    """Every term of the stored index with its documents, occurrences and blocks."""
    index = _lexical_index(spark, d)
    held = index.blocks.groupBy("term").agg(F.sum(F.aggregate("postings", F.lit(0).cast("bigint"), lambda t, p: t + p["tf"])).alias("occurrences"), F.count("*").alias("blocks"))
    return index.terms.join(held, "term").select("term", "df", "occurrences", "blocks")


def bm25_indexed(spark, d):
    """The same ranking from the stored index, of which blocks that can't matter aren't read."""
    top = blocks.top(_lexical_index(spark, d), search.query_terms(spark, QUESTION))
    return top.select("id", F.round("bm25", 6).alias("bm25"))


def hybrid_search(spark, d):
    """Fused ranking of documents that have a vector, in a range of years, at most two of a source."""
    c = documents(spark, d).withColumn("document_id", F.col("source"))
    v = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")
    r = search.search(c, v, QUESTION, _query_vector(spark, d), top_k=8, date_from=1700, date_to=2000, lexical_index=_lexical_index(spark, d))
    return r.select("id", F.round("score", 9).alias("score"), F.round("dense_score", 6).alias("dense_score"), "document_id")


def context_prompt(spark, d):
    """The prompt over the eight best documents."""
    c = documents(spark, d).withColumn("document_id", F.col("id"))
    top = search.lexical_top(c, search.query_terms(spark, QUESTION), 8)
    rows = c.join(F.broadcast(top.select("id", F.col("bm25").alias("score"))), "id").withColumn("seen", F.col("pos"))
    return search.context_prompt("What was it?", rows).select(F.md5("prompt").alias("h"), F.length("prompt").cast("bigint").alias("n"))


def derive_pending(spark, d):
    """Documents whose label is missing or stale count as pending: the three-way anti-join."""
    c = documents(spark, d)
    done = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("document_id"), "quality").dropDuplicates(["document_id"])
    keyed = done.join(c.select("id", derive.identity("m").alias("identity")), done.document_id == F.col("id")).select("document_id", F.when(F.col("quality") == 1, F.col("identity")).otherwise("stale").alias("identity"), F.concat(F.lit("d"), "document_id").alias("derived_id"))
    out = keyed.select(F.col("derived_id").alias("id"), F.col("document_id").alias("source_document_id"), "identity")
    return derive.pending(c, keyed, out, "m").select("id")


def derive_batches(spark, d):
    """Greedy batches of each source: at most 50 documents and 200,000 characters."""
    b = derive.batches(documents(spark, d), size=50, max_document=200_000, max_batch=200_002, group=F.col("source"))
    return b.select("id", F.col("grp").alias("source"), F.col("batch").cast("bigint").alias("batch"), "batch_chars")


def derive_merge(spark, d):
    c = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_document_id"), F.lit("old").alias("version"), F.length("text").cast("bigint").alias("n"))
    new = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("source_document_id"), F.lit("new").alias("version"), F.col("quality").cast("bigint").alias("n")).dropDuplicates(["source_document_id"])
    return derive.merged(c, new)


def catalogue_join(spark, d):
    """Documents joined to labels by the last address segment; of two records with a key the last one wins."""
    files = table(spark, d, "documents").select("doc_id", F.concat(F.lit("https://x.org/f/"), "doc_id", F.lit(".txt")).alias("url"))
    records = table(spark, d, "labels").select(F.concat(F.lit("/item/"), "doc_id", F.lit("/")).alias("a"), F.concat(F.lit("http://y/"), F.col("doc_id") + 1).alias("b"), "quality", F.col("doc_id").alias("pos"))
    j = catalogue.with_records(files, records, ["a", "b"])
    return j.select("doc_id", F.col("record.quality").alias("quality"), F.col("record.pos").alias("record_pos"))


def period_audit(spark, d):
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate") - 100)
    p = audit.by_period(o, F.col("year"))
    return p.groupBy("period", "o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


def first_urls(spark, d):
    p = table(spark, d, "pages").withColumn("host", F.parse_url(audit.secure(F.col("url")), F.lit("HOST")))
    return audit.first_of_each(p.select("host", "url", F.col("page_id").alias("pos")), "host", "pos")


def seen_urls(spark, d):
    """Addresses that a reader keeps who looks them up as they are and stores them rewritten."""
    host = F.element_at(F.array(F.lit("http://www.loc.gov/"), F.lit("https://www.loc.gov/"), F.lit("http://x.org/")), (F.col("page_id") % 7 % 3 + 1).cast("int"))
    p = table(spark, d, "pages").select(F.col("page_id").alias("pos"), F.concat(host, (F.col("page_id") % 40).cast("string")).alias("raw"))
    return audit.first_seen(p.withColumn("url", harvest.canonical_item(F.col("raw"))), "raw", "url", "pos")


def page_numbers(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("issue"), F.col("turn").alias("pos"), F.when(F.col("role") == "user", F.col("text")).alias("href"))
    return catalogue.page_numbers(c).select("issue", "pos", F.col("page").cast("bigint").alias("page"))


def oai_records(spark, d):
    """Every benchmark item as a record of a catalogue page, parsed back."""
    b = table(spark, d, "benchmark")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    xml = F.concat(
        F.lit('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords><record><header><identifier>oai:'), F.col("item_id").cast("string"),
        F.lit('</identifier></header><metadata><dc xmlns="http://purl.org/dc/elements/1.1/"><title>'), esc(F.col("text")), F.lit("</title><date>1850</date></dc></metadata></record><resumptionToken> t1 </resumptionToken></ListRecords></OAI-PMH>"),
    )
    a = markup.parse_oai(b.select("item_id", xml.alias("xml")))
    return a.select("item_id", "oai_identifier", "token", F.length(F.element_at(F.element_at("fields", "title"), 1)).cast("bigint").alias("n"))


def unfetched_urls(spark, d):
    """Addresses of pages that a table of replies, which has the long ones, doesn't have."""
    p = table(spark, d, "pages")
    replies = bronze.Bronze(spark, f"{shared_folder(spark)}/replies-{uuid.uuid4().hex}")
    replies.add(p.where(F.length("html") > 3000).select("url", F.col("html").alias("text")))
    return replies.missing(p.select("url"))


QUERIES = {
    f.__name__: f
    for f in (
        clean_texts, stable_ids, years, search_terms, word_chunks, packed_chunks, rights, book_decisions, periodical_decisions, serial_decisions, field_coverage,
        frequent_values, dense_topk, dense_pivots, bm25_topk, lexical_index, bm25_indexed, hybrid_search, context_prompt, derive_pending, derive_batches, derive_merge, catalogue_join, period_audit,
        first_urls, seen_urls, page_numbers, oai_records, unfetched_urls,
    )
}

# ---- the same in SQL ---------------------------------------------------------------------------------------------

_CLEAN = "' pre-' || chr(10) || 'fix' || chr(13) || chr(10) || replace(text, '. ', '-' || chr(10)) || chr(9) || chr(9) || 'end ' || chr(10) || chr(10) || chr(10) || chr(10) || ' ' || doc_id"
_HYPHEN = r"'([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g'"
_CLEANED = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_CLEAN}, '\r\n?', chr(10), 'g'), {_HYPHEN}), {_HYPHEN}), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
_ESC = "replace(replace(replace(replace({}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(9), '\\t')"
_YEAR = "try_cast(nullif(regexp_extract(date, '\\b(1[5-9]\\d{2}|20\\d{2})\\b', 1), '') as int)"
_ANY = "list_min(list_transform(regexp_extract_all(date || ' 1999-2005', '\\b(1[0-9]{3}|20[0-9]{2})\\b', 1), lambda y: cast(y as int)))"
_DOCS = f"SELECT doc_id, cast(doc_id as varchar) id, source, {_sql_cycle(TITLES)} title, text, {_sql_cycle(DATES)} AS date, lang FROM documents"
_TOK = "list_filter(regexp_extract_all(strip_accents(lower({})), '[\\p{{L}}\\p{{N}}]+'), lambda z: true)"
_CJK_TERMS = "['工人生活','工','人','生','活','工人','人生','生活','가나','가','나']"


def _bm25_sql(terms: list[str]) -> str:
    # text, title and the distinct case-kept terms of both are indexed
    uniq = "list_transform(list_distinct(regexp_extract_all(title || ' ' || text, '[\\p{L}\\p{N}]+')), lambda z: strip_accents(lower(z)))"
    score = " + ".join(f"idf{k} * f{k} * 2.2 / (f{k} + 1.2 * (0.25 + 0.75 * dl / avgdl))" for k in range(len(terms)))
    f = ", ".join(f"len(list_filter(toks, lambda z: z = '{t}')) AS f{k}" for k, t in enumerate(terms))
    idf = ", ".join(f"CASE WHEN ln((count(*) - count(*) FILTER (f{k} > 0) + 0.5) / (count(*) FILTER (f{k} > 0) + 0.5)) > 0 THEN ln((count(*) - count(*) FILTER (f{k} > 0) + 0.5) / (count(*) FILTER (f{k} > 0) + 0.5)) ELSE 1e-6 END AS idf{k}" for k in range(len(terms)))
    some = " OR ".join(f"f{k} > 0" for k in range(len(terms)))
    return f"""d AS ({_DOCS}), t AS (SELECT *, list_concat({_TOK.format('text')}, {_TOK.format('title')}, {uniq}) AS toks FROM d),
    c AS (SELECT * EXCLUDE (toks, text), len(toks) AS dl, {f} FROM t), s AS (SELECT avg(dl) AS avgdl, {idf} FROM c),
    b AS (SELECT id, doc_id, {score} AS bm25 FROM c, s WHERE {some}), top AS (SELECT * FROM b ORDER BY bm25 DESC, doc_id LIMIT 100)"""


_TERMS = ["the", "thing", "and", "erhation", "of", "that"]
_BM25 = f"WITH {_bm25_sql(_TERMS)} SELECT id, round(bm25, 6) AS bm25 FROM top"
_HAS = lambda col, terms: " OR ".join(f"contains({col}, '{t}')" for t in terms)
_RX = lambda col, pats, flags="i": " OR ".join(f"regexp_matches({col}, '{p}', '{flags}')" for p in pats)
_CNT = lambda col, pats, flags="i": " + ".join(f"(regexp_matches({col}, '{p}', '{flags}'))::int" for p in pats)
_REQ = f"""'{{"genre":"","id":"' || doc_id || '","place":"","text":"' || {_ESC.format('text')} || '","title":"' || {_sql_cycle(TITLES)} || '"}}'"""
_PROMPT_HEAD = search.INSTRUCTIONS

ORACLE: dict[str, str] = {
    "clean_texts": f"SELECT doc_id, md5({_CLEANED}) AS h, length({_CLEANED}) AS n FROM documents",
    "stable_ids": f"""WITH c AS (SELECT *, '{{"id":"' || doc_id || '","language":"' || lang || '","text":"' || {_ESC.format('text')} || '"}}' AS j FROM documents)
        SELECT doc_id, substr(sha256(doc_id || chr(31) || source || chr(31) || text), 1, 24) AS sid, sha256(j) AS h, length(j) AS chars FROM c""",
    "years": f"WITH a AS (SELECT doc_id, {_sql_cycle(DATES)} AS date FROM documents) SELECT doc_id, {_YEAR} AS first, {_ANY} AS earliest, coalesce({_YEAR} BETWEEN 1700 AND 1929, true) AS kept_if_unknown, coalesce({_YEAR} <= 1929, false) AS dropped_if_unknown FROM a",
    "search_terms": f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')) AS t, generate_subscripts(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+'), 1) AS i FROM documents),
        u AS (SELECT doc_id, t, min(i) AS i FROM w GROUP BY doc_id, t), l AS (SELECT doc_id, list(t ORDER BY i) AS l FROM u GROUP BY doc_id)
        SELECT d.doc_id, len({_CJK_TERMS}) + coalesce(len(l), 0) AS n, md5(array_to_string(list_concat({_CJK_TERMS}, coalesce(l, [])), '|')) AS h FROM documents d LEFT JOIN l USING (doc_id)""",
    "word_chunks": r"""WITH t AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(text, '[ \n]+', ' ', 'g')), ' '), lambda w: w <> '') AS w FROM documents),
        s AS (SELECT doc_id, w, unnest(CASE WHEN len(w) > 50 THEN range(0, len(w) - 10, 40) ELSE [0] END) AS i FROM t WHERE len(w) > 0),
        c AS (SELECT doc_id, cast(i // 40 as int) AS ordinal, array_to_string(w[i + 1 : i + 50], ' ') AS x FROM s)
        SELECT cast(doc_id as varchar) AS document_id, ordinal, substr(sha256(doc_id || chr(31) || ordinal || chr(31) || x), 1, 24) AS id, md5(x) AS h FROM c""",
    "packed_chunks": r"""WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
        s AS (SELECT doc_id, i, trim(p, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS p FROM l), u0 AS (SELECT doc_id, p, list_filter(regexp_split_to_array(p, '\s+'), lambda w: w <> '') AS w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM s WHERE p <> ''),
        u AS (SELECT *, len(w) AS n FROM u0),
        g AS (SELECT doc_id, 0 AS i, []::varchar[] AS out, []::varchar[] AS cur, 0::bigint AS cn FROM (SELECT DISTINCT doc_id FROM u) UNION ALL
          SELECT g.doc_id, u.i,
            CASE WHEN u.n > 60 THEN list_concat(CASE WHEN len(g.cur) > 0 THEN list_append(g.out, array_to_string(g.cur, chr(10) || chr(10))) ELSE g.out END, list_transform(range(0, u.n - 12, 48), lambda k: array_to_string(u.w[k + 1 : k + 60], ' ')))
                 WHEN len(g.cur) > 0 AND g.cn + u.n > 60 THEN list_append(g.out, array_to_string(g.cur, chr(10) || chr(10))) ELSE g.out END,
            CASE WHEN u.n > 60 THEN [] WHEN len(g.cur) > 0 AND g.cn + u.n > 60 THEN (CASE WHEN u.n < 60 THEN [array_to_string(list_filter(regexp_split_to_array(array_to_string(g.cur, ' '), '\s+'), lambda z: z <> '')[-least(12, 60 - u.n) :], ' '), u.p] ELSE [u.p] END) ELSE list_append(g.cur, u.p) END,
            CASE WHEN u.n > 60 THEN 0 WHEN len(g.cur) > 0 AND g.cn + u.n > 60 THEN least(12, 60 - u.n, len(list_filter(regexp_split_to_array(array_to_string(g.cur, ' '), '\s+'), lambda z: z <> ''))) + u.n ELSE g.cn + u.n END
          FROM g JOIN u ON u.doc_id = g.doc_id AND u.i = g.i + 1),
        f AS (SELECT doc_id, CASE WHEN len(cur) > 0 THEN list_append(out, array_to_string(cur, chr(10) || chr(10))) ELSE out END AS c FROM g QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i DESC) = 1),
        x AS (SELECT doc_id, unnest(c) AS t, cast(generate_subscripts(c, 1) - 1 AS int) AS ordinal FROM f)
        SELECT doc_id, ordinal, len(list_filter(regexp_split_to_array(t, '\s+'), lambda z: z <> '')) AS n_words, md5(t) AS h FROM x""",
    "rights": f"""WITH a AS (SELECT doc_id, lower(trim({_sql_cycle(RIGHTS)})) AS r FROM documents) SELECT doc_id, r <> '' AND NOT ({_RX('r', classify.REFUSALS)}) AND ({_RX('r', classify.GRANTS)}) AS ok FROM a""",
    "book_decisions": f"""WITH a AS (SELECT p_partkey, {_sql_cycle(TITLES, 'p_partkey')} AS t, lower({_sql_cycle(SUBJECTS, 'p_partkey')} || ' | ' || p_type) AS s, upper(regexp_extract({_sql_cycle(SHELF, 'p_partkey')}, '^\\s*([A-Za-z]{{1,3}})', 1)) AS p FROM part),
        n AS (SELECT *, ({_HAS('s', classify.FICTION_TERMS)})::int + {_CNT('t', classify.FICTION_TITLES)} + (p LIKE 'PZ%')::int AS f, ({_HAS('s', classify.NONFICTION_TERMS)})::int + {_CNT('t', classify.NONFICTION_TITLES)} + (p <> '' AND p[1] IN ({', '.join(f"'{c}'" for c in classify.NONFICTION_CLASSES)}))::int AS o FROM a)
        SELECT p_partkey, CASE WHEN f > 0 THEN 'fiction' WHEN o > 0 THEN 'nonfiction' ELSE 'uncertain' END AS status, CASE WHEN f + o > 0 THEN 'high' ELSE 'low' END AS confidence, CASE WHEN f > 0 THEN f WHEN o > 0 THEN o ELSE 1 END::bigint AS n_reasons FROM n""",
    "periodical_decisions": f"""WITH a AS (SELECT p_partkey, {_sql_cycle(TITLES, 'p_partkey')} AS t, lower({_sql_cycle(SUBJECTS, 'p_partkey')}) AS s, lower({_sql_cycle(GENRES, 'p_partkey')}) AS g FROM part)
        SELECT p_partkey, CASE WHEN {_HAS('s', classify.LITERARY_TERMS)} OR {_RX('t', classify.LITERARY_TITLES)} THEN 'literary' WHEN contains(g, 'newspaper') OR contains(lower(t), 'newspaper') THEN 'newspaper' ELSE 'uncertain' END AS status,
        array_to_string(list_filter([{', '.join(f"CASE WHEN contains(s, '{x}') THEN 'subject contains ''{x}''' WHEN regexp_matches(lower(t), '\\b{x}\\b') THEN 'title contains ''{x}''' END" for x in classify.REVIEW_TERMS)}], lambda z: z IS NOT NULL), '; ') AS review FROM a""",
    "serial_decisions": f"""WITH a AS (SELECT doc_id, replace({_sql_cycle([m.replace(chr(10), '¶') for m in MARKS])}, '¶', chr(10)) || chr(10) || text AS t FROM documents),
        n AS (SELECT doc_id, {' + '.join(f"(regexp_matches(t, '{p}'))::int" for p in classify.STRONG_MARKS)} AS s, {' + '.join(f"(regexp_matches(t, '{p}'))::int" for p in classify.WEAK_MARKS)} AS w FROM a)
        SELECT doc_id, CASE WHEN s > 0 OR w >= 2 THEN 'literary' ELSE 'retain' END AS status, CASE WHEN s > 0 THEN 'high' ELSE 'medium' END AS confidence FROM n""",
    "field_coverage": """WITH f AS (SELECT event_id, 'type' AS field, event_type AS v FROM events UNION ALL SELECT event_id, 'k', props::json->>'$.k' FROM events UNION ALL SELECT event_id, 'odd', CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '' END FROM events)
        SELECT field, count(*) FILTER (v IS NOT NULL AND v <> '') AS n_present, round_even(100.0::double * count(*) FILTER (v IS NOT NULL AND v <> '') / (SELECT count(*) FROM events), 1) AS percent FROM f GROUP BY field""",
    "frequent_values": """WITH v AS (SELECT 'hour' AS field, strftime(ts, '%Y-%m-%d %H') AS value, event_id AS pos FROM events UNION ALL SELECT 'type', event_type, event_id FROM events),
        c AS (SELECT field, value, count(*) AS n, row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, min(pos)) AS nth FROM v GROUP BY field, value) SELECT * FROM c WHERE nth <= 25""",
    "dense_topk": """WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7), s AS (SELECT vec_id, list_inner_product(embedding::double[], e::double[]) AS x FROM embeddings, q)
        SELECT vec_id, round(x, 6) AS dense_score, row_number() OVER (ORDER BY x DESC, vec_id) AS rank FROM s ORDER BY x DESC, vec_id LIMIT 50""",
    "dense_pivots": """WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7), s AS (SELECT vec_id, list_inner_product(embedding::double[], e::double[]) AS x FROM embeddings, q)
        SELECT vec_id, round(x, 6) AS dense_score FROM s ORDER BY x DESC, vec_id LIMIT 50""",
    "bm25_topk": _BM25,
    "lexical_index": f"""WITH d AS ({_DOCS}), t AS (SELECT doc_id, unnest(list_concat({_TOK.format('text')}, {_TOK.format('title')}, list_transform(list_distinct(regexp_extract_all(title || ' ' || text, '[\\p{{L}}\\p{{N}}]+')), lambda z: strip_accents(lower(z))))) AS term FROM d)
        SELECT term, count(DISTINCT doc_id) AS df, count(*) AS occurrences, count(DISTINCT doc_id // {blocks.RANGE}) AS blocks FROM t GROUP BY term""",
    "bm25_indexed": _BM25,
    "hybrid_search": f"""WITH {_bm25_sql(_TERMS)}, q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7),
        ok AS (SELECT * FROM d WHERE coalesce({_YEAR} BETWEEN 1700 AND 2000, true)),
        dense AS (SELECT doc_id, list_inner_product(embedding::double[], e::double[]) AS x FROM ok JOIN embeddings ON vec_id = doc_id, q),
        r1 AS (SELECT doc_id, row_number() OVER (ORDER BY x DESC, doc_id) AS r FROM dense ORDER BY x DESC, doc_id LIMIT 50),
        r2 AS (SELECT doc_id, row_number() OVER (ORDER BY bm25 DESC, doc_id) AS r FROM top WHERE doc_id IN (SELECT doc_id FROM ok)),
        f AS (SELECT doc_id, sum(1.0::double / (60 + r)) AS score, min(seen) AS seen FROM (SELECT doc_id, r, r AS seen FROM r1 UNION ALL SELECT doc_id, r, 1000000 + r FROM r2) GROUP BY doc_id),
        w AS (SELECT f.*, ok.source, row_number() OVER (PARTITION BY ok.source ORDER BY score DESC, seen) AS nth FROM f JOIN ok USING (doc_id)),
        best AS (SELECT * FROM w WHERE nth <= 2 ORDER BY score DESC, seen LIMIT 8)
        SELECT cast(best.doc_id as varchar) AS id, round(score, 9) AS score, round(list_inner_product(embedding::double[], e::double[]), 6) AS dense_score, source AS document_id FROM best JOIN embeddings ON vec_id = best.doc_id, q""",
    "context_prompt": f"""WITH {_bm25_sql(_TERMS)}, t8 AS (SELECT *, row_number() OVER (ORDER BY bm25 DESC, doc_id) AS nth FROM top ORDER BY bm25 DESC, doc_id LIMIT 8),
        e AS (SELECT nth, '[S' || nth || '] ' || title || ' (' || coalesce(nullif(date, ''), 'undated') || ')' || chr(10) || 'Country: america | Language: ' || lang || ' | Content mode: native | Document ID: ' || d.id || chr(10) || 'URL: https://example.org/' || doc_id || chr(10) || text AS x FROM d JOIN t8 USING (doc_id)),
        p AS (SELECT '{_PROMPT_HEAD}' || chr(10) || chr(10) || 'QUESTION:' || chr(10) || 'What was it?' || chr(10) || chr(10) || 'EVIDENCE:' || chr(10) || string_agg(x, chr(10) || chr(10) ORDER BY nth) AS p FROM e) SELECT md5(p) AS h, length(p) AS n FROM p""",
    "derive_pending": "SELECT cast(doc_id as varchar) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
    "derive_batches": f"""WITH RECURSIVE c AS (SELECT doc_id, source, length({_REQ}) AS n FROM documents), o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM c),
        g AS (SELECT source, i, doc_id, 0 AS batch, 1 AS cnt, n + 2 AS chars FROM o WHERE i = 1 UNION ALL
          SELECT o.source, o.i, o.doc_id, CASE WHEN g.cnt >= 50 OR g.chars + o.n + 1 > 200002 THEN g.batch + 1 ELSE g.batch END, CASE WHEN g.cnt >= 50 OR g.chars + o.n + 1 > 200002 THEN 1 ELSE g.cnt + 1 END, CASE WHEN g.cnt >= 50 OR g.chars + o.n + 1 > 200002 THEN o.n + 2 ELSE g.chars + o.n + 1 END
          FROM g JOIN o ON o.source = g.source AND o.i = g.i + 1)
        SELECT cast(doc_id as varchar) AS id, source, batch::bigint AS batch, max(chars) OVER (PARTITION BY source, batch) AS batch_chars FROM g""",
    "derive_merge": "SELECT cast(doc_id as varchar) AS source_document_id, 'old' AS version, length(text) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT cast(doc_id as varchar), 'new', max(quality)::bigint FROM labels GROUP BY doc_id",
    "catalogue_join": """WITH k AS (SELECT cast(doc_id as varchar) AS item, quality, doc_id AS pos FROM labels UNION ALL SELECT cast(doc_id + 1 as varchar), quality, doc_id FROM labels), l AS (SELECT item, max_by(quality, pos) AS quality, max(pos) AS record_pos FROM k GROUP BY item)
        SELECT doc_id, quality, record_pos FROM documents LEFT JOIN l ON item = cast(doc_id as varchar)""",
    "period_audit": """WITH o AS (SELECT *, year(o_orderdate) - 100 AS y FROM orders), p AS (SELECT *, CASE WHEN y BETWEEN 1800 AND 1849 THEN '1800-1849' WHEN y BETWEEN 1850 AND 1879 THEN '1850-1879' WHEN y BETWEEN 1880 AND 1909 THEN '1880-1909' WHEN y BETWEEN 1910 AND 1929 THEN '1910-1929' END AS period FROM o)
        SELECT period, o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key FROM p WHERE period IS NOT NULL GROUP BY ALL""",
    "first_urls": "WITH p AS (SELECT regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, url, page_id FROM pages) SELECT host, min_by(url, page_id) AS url, min(page_id) AS pos FROM p GROUP BY host",
    "seen_urls": """WITH p AS (SELECT page_id AS pos, ['http://www.loc.gov/', 'https://www.loc.gov/', 'http://x.org/'][page_id % 7 % 3 + 1] || (page_id % 40) AS raw FROM pages), r AS (SELECT *, replace(raw, 'http://www.loc.gov/', 'https://www.loc.gov/') AS url FROM p)
        SELECT pos, raw, url FROM r WHERE raw <> url OR NOT EXISTS (SELECT 1 FROM r e WHERE e.url = r.url AND e.pos < r.pos)""",
    "page_numbers": "SELECT conv_id AS issue, turn AS pos, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS page FROM conversations WHERE role = 'user' AND text <> ''",
    "oai_records": f"SELECT item_id, 'oai:' || item_id AS oai_identifier, 't1' AS token, length({_CLEANED.replace(_CLEAN, 'text')}) AS n FROM benchmark",
    "unfetched_urls": "SELECT DISTINCT url, sha256(url) AS key FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE length(html) > 3000)",
}


QUERIES |= corpus.QUERIES
ORACLE |= corpus.ORACLE


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: documents are cleaned, chunked, ranked by BM25, and the best chunks come with their citation."""
    docs = documents(spark, sf_dir).withColumn("text", text.clean_text(F.col("text")))
    chunks = chunking.chunk_documents(docs.drop("pos"), 100, 20)
    chunks = chunks.withColumn("pos", F.col("doc_id") * 100_000 + F.col("ordinal"))
    top = search.lexical_top(chunks, search.query_terms(spark, QUESTION))
    fused = search.reciprocal_ranks([top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("bm25"), "pos")))])
    rows = chunks.join(F.broadcast(fused), "id")
    return search.diversified(rows, 8, 2).select("id", "document_id", "ordinal", "title", "url", "date", F.round("score", 9).alias("score"), "text")
