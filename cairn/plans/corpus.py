"""Sources, guards, projections and indexes over the driver tables, and the same results in DuckDB SQL."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, records, text
from ..operators import chunking, derive, embed, index, search
from ..schemas import as_documents
from ..sources import archive, bronze, catalogue, harvest, local, newspapers, paged, registry
from ..sources import markup as xml

RIGHTS = ["Public Domain", "All rights reserved", "CC BY-SA 4.0", ""]
DATES = ["1898-05-01", "unknown", "1950", "", "12 May 1901"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cycle(values: list[str], key: str = "doc_id"):
    return F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))


def _list(values: list[str], key: str = "doc_id") -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][{key} % {len(values)} + 1]"


def _own(spark: SparkSession, what: str) -> str:
    """A new place in the folder that the session's tables share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/cairn-shared"
    return f"{folder.removeprefix('file:').rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"), "doc_id", F.when(F.col("doc_id") % 2 == 0, "loc_chronicling_america").otherwise(F.col("source")).alias("source"), F.lit("t").alias("title"), "text", F.lit("u").alias("url"), _cycle(DATES).alias("date"), F.col("lang").alias("language"))


def _escaped(c):
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def document_rows(spark, d):
    """Every document in the shape of the corpus, with defaults; fails at one of another country or mode."""
    a = index.guarded(as_documents(_documents(spark, d)), "america", "native")
    return a.select("id", "source", F.md5("text").alias("h"), "date", F.size("authors").cast("bigint").alias("n_authors"), "place", "genre", "rights", "country", "language", "content_mode", "metadata")


def eligible_rows(spark, d):
    """Documents of one source, of a year in range or unknown."""
    return _documents(spark, d).where(search.eligible("loc_chronicling_america", 1890, 1899)).select("id")


def serial_chunks(spark, d):
    """Which chunks of newspaper sources leave the index as serial fiction or verse."""
    marked = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("To be continued.\n"), F.col("text"))).otherwise(F.col("text"))
    kept, left = index.split_serials(_documents(spark, d).withColumn("text", marked))
    return kept.select("id", F.lit("kept").alias("part")).unionByName(left.select("id", F.lit("excluded").alias("part")))


def books(spark, d):
    """Text files of a catalogue that are in size, not fiction, of a year, with a long enough text."""
    files = table(spark, d, "documents").select(F.concat(F.lit("https://x/"), "doc_id", F.when(F.col("doc_id") % 7 == 0, ".pdf").otherwise(".txt")).alias("url"), F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.octet_length("text")).cast("bigint").alias("size"))
    kinds = F.element_at(F.array(*map(F.lit, ["Annual report of x", "A novel of y", "Untitled"])), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = table(spark, d, "documents").select(F.concat(F.lit("/i/"), "doc_id").alias("id"), kinds.alias("title"), F.array(F.lit("Labor")).alias("subjects"), F.array().cast("array<string>").alias("call_numbers"), _cycle(DATES).alias("date"), F.col("doc_id").alias("pos"))
    texts = table(spark, d, "documents").select(F.concat(F.lit("https://x/"), "doc_id", F.lit(".txt")).alias("url"), "text")
    return catalogue.books(catalogue.with_records(files, rows, ["id"]), texts, max_bytes=5000).select("url", F.col("decision.status").alias("status"))


def letters(spark, d):
    """Dated letters with a body of 80 characters."""
    meta = table(spark, d, "documents").select(F.lit("t").alias("title"), F.concat(F.lit("https://f/"), F.when(F.col("doc_id") % 5 == 0, "other/").otherwise("documents/"), "doc_id").alias("permalink"), F.lit("p").alias("project"), F.array(F.lit("a")).alias("authors"), _cycle(DATES).alias("date_from"))
    bodies = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("api_id"), F.col("text").alias("content"))
    return catalogue.letters(meta, bodies).select("id", "date_from")


def archive_documents(spark, d):
    """Items of an archive, whose values come before the search rows', with the preferred of their files."""
    a = table(spark, d, "documents")
    found = a.select(F.col("doc_id").cast("string").alias("identifier"), _cycle(DATES).alias("year"), F.lit(None).cast("string").alias("date"), F.lit("T").alias("title"), _cycle(RIGHTS).alias("licenseurl"))
    files = F.array(F.struct(F.lit("a.pdf").alias("name"), F.lit("PDF").alias("format"), F.lit(1).cast("bigint").alias("size")), F.struct(F.lit("b.txt").alias("name"), F.lit(None).cast("string").alias("format"), F.lit(5).cast("bigint").alias("size")), F.struct(F.lit("c.txt").alias("name"), F.lit("DjVuTXT").alias("format"), F.when(F.col("doc_id") % 2 == 0, F.lit(10**9)).otherwise(7).cast("bigint").alias("size")))
    items = a.select(F.col("doc_id").cast("string").alias("identifier"), F.when(F.col("doc_id") % 3 == 0, "Public domain").otherwise("").alias("licenseurl"), F.when(F.col("doc_id") % 2 == 0, "Better").otherwise("").alias("title"), F.lit("").alias("date"), F.array(F.lit("M")).alias("creators"), files.alias("files"))
    texts = a.select(F.concat(F.lit("https://archive.org/download/"), "doc_id", F.when(F.col("doc_id") % 2 == 0, "/b.txt").otherwise("/c.txt")).alias("url"), "text")
    got = archive.documents(found, items, texts, source="ia", country="spain", language="es", cutoff=1929)
    return got.select("id", "title", "rights")


def oai_documents(spark, d):
    """Catalogue records that may be read, with their texts, as documents."""
    a = table(spark, d, "benchmark")
    dc = F.concat(F.lit("<title> "), _escaped(F.substring("text", 1, 20)), F.lit("</title><date>"), F.when(F.col("item_id") % 4 == 0, "1950").otherwise("c. 1850"), F.lit("</date><creator>A</creator><contributor>B</contributor><identifier>http://x/"), F.col("item_id").cast("string"), F.lit(".txt</identifier><rights>"), F.when(F.col("item_id") % 5 == 0, "All rights reserved").otherwise("Public domain"), F.lit("</rights>"))
    page = F.concat(F.lit('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords><record><header><identifier>o'), F.col("item_id").cast("string"), F.lit('</identifier></header><metadata><dc xmlns="http://purl.org/dc/elements/1.1/">'), dc, F.lit("</dc></metadata></record></ListRecords></OAI-PMH>"))
    texts = a.select(F.concat(F.lit("http://x/"), "item_id", F.lit(".txt")).alias("url"), F.concat_ws(" ", "text", "text").alias("text"))
    got = paged.record_documents(paged.catalogue_records(a.select("item_id", page.alias("xml"))), texts, source="s", endpoint="e", country="spain", language="es", cutoff=1900)
    return got.select("id", "date", F.array_join("authors", "|").alias("authors"), "url", "rights", F.length("text").cast("bigint").alias("n"))


def newspaper_issues(spark, d):
    """Issues that batches list, with their addresses; every spelling of a path."""
    forms = F.element_at(F.array(F.lit("..\\batch_x\\sn1\\"), F.lit("/x/data/sn1/"), F.lit("sn1/")), (F.col("page_id") % 3 + 1).cast("int"))
    a = table(spark, d, "pages").select("page_id", F.concat(F.lit("https://b/"), "page_id", F.lit("/")).alias("base"), F.concat(F.lit('<batch><issue lccn="sn1" issueDate="1900-01-02">'), forms, "page_id", F.lit(".xml</issue><issue> </issue></batch>")).alias("xml"))
    return newspapers.batch_issues(a).select("base", "url", "lccn", "date", "edition")


def newspaper_pages(spark, d):
    """OCR pages of issues, numbered, with the text of their lines as documents."""
    a = table(spark, d, "benchmark").select("item_id", F.concat(F.lit("https://b/"), "item_id", F.lit("/i.xml")).alias("url"), F.concat(F.lit("sn"), "item_id").alias("lccn"), F.lit("1900-01-02").alias("date"), F.lit("1").alias("edition"), F.lit("https://b").alias("base"), "text")
    mets = F.lit('<mets LABEL="Sun" xmlns:xlink="http://www.w3.org/1999/xlink"><file USE="ocr"/><file USE="image"><FLocat xlink:href="i.jp2"/></file><file USE="ocr"><FLocat xlink:href="./p.xml"/></file></mets>')
    pages = newspapers.issue_pages(a.drop("text", "item_id"), a.select("url", mets.alias("xml")))
    words = F.transform(text.words(F.col("text")), lambda w: F.concat(F.lit('<String CONTENT="'), _escaped(w), F.lit('"/>')))
    replies = a.select(F.concat(F.lit("https://b/"), "item_id", F.lit("/p.xml")).alias("url"), F.concat(F.lit("<alto><TextLine>"), F.array_join(words, "<SP/>"), F.lit('</TextLine><x><TextLine><String CONTENT="end"/></TextLine></x></alto>')).alias("xml"))
    got = newspapers.page_documents(pages, replies)
    return got.select("title", "url", F.length("text").cast("bigint").alias("n"))


def tei_texts(spark, d):
    """Header values and paragraphs of TEI files."""
    a = table(spark, d, "benchmark").select("item_id", F.concat(F.lit("<TEI><title> T  "), "item_id", F.lit("</title><author>A</author><author>A</author><term>s</term><term>s</term><wordCount>9</wordCount><p>"), _escaped(F.col("text")), F.lit(" <note>n\n n</note></p></TEI>")).alias("xml"))
    got = xml.parse_tei(a)
    return got.select("item_id", "title", F.size("authors").cast("bigint").alias("n_authors"), F.size("subjects").cast("bigint").alias("n_subjects"), F.element_at("header", "wordCount").alias("words"), F.md5("text").alias("h"))


def value_rules(spark, d):
    """First and present values of arrays, addresses with a scheme, last segments, text addresses."""
    v = F.array(F.when(F.col("doc_id") % 2 == 0, F.col("source")), F.lit(" "), F.col("lang"))
    url = F.concat(_cycle(["//h/", "http://h/", "https://h/a/"]), "doc_id", _cycle([".txt?x=1", "/", ".TEXT", ".pdf"]))
    return table(spark, d, "documents").select("doc_id", text.first_value(v, "none").alias("first"), F.array_join(text.present_values(v), "|").alias("present"), text.with_scheme(url).alias("url"), text.last_segment(url).alias("segment"), text.text_url(F.array(url), F.array(F.lit("http://r.txt"))).alias("text_url"))


def resource_urls(spark, d):
    """Text addresses of catalogue items, each resource's own before its files."""
    item = F.concat(F.lit('[{"url":"http://t/'), "doc_id", _cycle([".txt", ".pdf"]), F.lit('","fulltext_file":"http://f/1","files":[{"url":"http://f/1"},{"url":"http://f/'), "doc_id", F.lit('.txt"}]}]'))
    return table(spark, d, "documents").select("doc_id", F.array_join(newspapers.candidate_urls(item), "|").alias("urls"))


def manifest_urls(spark, d):
    """Addresses of the files that manifests of several shapes list."""
    n = F.col("doc_id").cast("string")
    shape = F.element_at(F.array(F.concat(F.lit('[{"url":"//h/'), n, F.lit('"}]')), F.concat(F.lit('{"cols":["n","download"],"rows":[["1","h/'), n, F.lit('"]]}')), F.concat(F.lit('{"items":[{"object_key":"/h/'), n, F.lit('"},{"n":"2"}]}'))), (F.col("doc_id") % 3 + 1).cast("int"))
    a = table(spark, d, "documents").select("doc_id", F.posexplode(catalogue.manifest_rows(shape)).alias("nth", "m"))
    return a.select("doc_id", "nth", catalogue.file_url(F.col("m")).alias("url"))


def catalogue_values(spark, d):
    """Values of nested records, from the record and from its item."""
    r = F.concat(F.lit('{"subject":["'), "source", F.lit('"," a ",["b",[[[[["deep",null,{"z":[1],"y":{"n":2}}]]]]]],true],"subjects":{"k":1},"item":{"subject":"c","call_number":null,"language":7}}'))
    f = records.catalogue_fields(r)
    return table(spark, d, "documents").select("doc_id", F.array_join(f["subjects"], "|").alias("subjects"), F.size(f["call_numbers"]).cast("bigint").alias("n_call_numbers"), F.array_join(f["languages"], "|").alias("languages"))


def identities(spark, d):
    """Hashes of what is derived, and the size of its request."""
    a = _documents(spark, d).withColumns({"place": F.lit(""), "genre": F.lit(None).cast("string")})
    return a.select("id", derive.source_hash().alias("source_hash"), derive.identity("m").alias("identity"), derive.request_size().cast("bigint").alias("chars"))


def prefixes(spark, d):
    """What retrieval models want before a question and a passage."""
    p = text.model_prefixes(_cycle(["intfloat/multilingual-e5-small", "BAAI/bge-small-en-v1.5", "some/e50"], "vec_id"))
    return table(spark, d, "embeddings").select("vec_id", p["query"].alias("query"), p["document"].alias("document"))


def vector_norms(spark, d):
    """Vectors of all documents: as many dimensions as the model has, of length 1."""
    v = embed.embed(_documents(spark, d), embed.HashingEmbedder(16))
    return v.select("id", F.size("embedding").cast("bigint").alias("n"), F.round(F.sqrt(search.dot(F.col("embedding"), F.col("embedding"))), 3).alias("norm"))


def built_index(spark, d):
    """An index of all documents, one chunk each, blank ones too: its configuration."""
    a = as_documents(_documents(spark, d))
    path = _own(spark, "index")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    c = index.build(a, path, embed.HashingEmbedder(8), target=None, country="america", content_mode="native")
    index.check_index(c, "america", "native")
    return spark.createDataFrame([(c["chunks"], c["excluded_chunks"], c["integrity"]["embedding_rows"], c["integrity"]["embedding_dimensions"], c["integrity"]["lexical_rows"], c["country"], "|".join(c["languages"]))], "chunks bigint, excluded bigint, vectors bigint, dimensions bigint, lexical_rows bigint, country string, languages string")


def jsonl_rows(spark, d):
    """Documents written as JSON Lines, replaced, appended to, and read again."""
    a, path = as_documents(_documents(spark, d)), _own(spark, "jsonl")
    local.write_jsonl(a.limit(0), path)
    local.write_jsonl(a.where("id % 2 = 0"), path)
    local.write_jsonl(a.where("id % 2 = 1"), path, append=True)
    return local.read_jsonl(spark, path).select("id", "source", F.md5("text").alias("h"), "date", "country")


def registry_sources(spark, d):
    """Manifests of all nations: countries in order, and their sources' status."""
    root = _own(spark, "registry")
    for r in table(spark, d, "nation").collect():
        name = "america" if r.n_nationkey == 3 else r.n_name.lower().replace("_", "-")
        os.makedirs(f"{root}/{name}")
        state = [{}, {"status": False}, {"status": "conditional"}][r.n_nationkey % 3]
        with open(f"{root}/{name}/manifest.json", "w", encoding="utf-8") as f:
            json.dump({"id": name, "name": r.n_name, "language": "es", "language_name": "x", "native_query_default": "q", "publication_cutoff": 1929, "cutoff_note": "", "sources": [{"id": "s", "name": "S", "protocol": "oai-pmh", "endpoint": "e", "rights_note": "", "options": state}]}, f)
    countries = registry.registry(spark, root)
    nth = {r.id: k for k, r in enumerate(countries.collect())}  # one row a country
    at = F.create_map(*[F.lit(x) for kv in nth.items() for x in kv])
    return registry.sources(countries).select("country", "source", "status", F.element_at(at, F.col("country")).cast("bigint").alias("nth"))


def export_documents(spark, d):
    """A local export of all benchmark items: records and their text and XML files, filtered and read."""
    root, a = _own(spark, "export"), table(spark, d, "benchmark").withColumn("kind", F.when(F.col("item_id") % 3 == 0, "xml").otherwise("txt"))
    body = F.concat_ws(" ", "text", "text")
    # one file an item, in a folder that says whose
    each = a.select("item_id", "kind", body.alias("t"))
    each.where("kind = 'xml'").drop("kind").write.partitionBy("item_id").format("xml").options(rowTag="p", rootTag="a").save(f"{root}/xml")
    each.where("kind = 'txt'").drop("kind").write.partitionBy("item_id").text(f"{root}/txt")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{root}/xml", f"{root}/txt"]).select(F.regexp_extract("path", "/((xml|txt)/item_id=[0-9]+/[^/]+)$", 1).alias("path"), F.regexp_extract("path", "/item_id=([0-9]+)/", 1).cast("bigint").alias("item_id"))
    source = F.element_at(F.array(*map(F.lit, ["s", "", "z"])), (F.col("item_id") % 5 % 3 + 1).cast("int"))
    records = a.join(files, "item_id").select(F.col("item_id").cast("string").alias("id"), source.alias("source"), "path", F.when(F.col("item_id") % 2 == 0, "T").otherwise("").alias("title"), _cycle(DATES, "item_id").alias("date"), F.lit("u").alias("url"), _cycle(RIGHTS, "item_id").alias("rights"))
    records.write.json(f"{root}/records.jsonl")
    got = local.local_export(spark, root, source="s", country="spain", language="es", cutoff=1929, protocol="local")
    meta = lambda k: F.get_json_object("metadata", f"$.{k}").alias(k)
    return got.select("id", F.when(F.col("title").startswith("part-"), "file").otherwise(F.col("title")).alias("title"), F.md5("text").alias("h"), "date", "rights", "country", meta("local_record_id"), meta("rights_status"), meta("protocol"))


_SPAIN = {"id": "spain", "language": "es", "publication_cutoff": 1929, "cutoff_note": ""}


def _archive(spark, d, limit):
    """A harvest of all documents as items of an archive, through recorded replies: a paged search, items and texts."""
    a = table(spark, d, "documents").where("doc_id IS NOT NULL")
    hit = F.struct(F.col("doc_id").cast("string").alias("identifier"), _cycle(DATES).alias("year"), F.concat(F.lit("T"), "doc_id").alias("title"), _cycle(RIGHTS).alias("licenseurl"))
    pages = a.groupBy(F.expr("doc_id div 100").alias("page")).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", hit.alias("m")))), lambda x: x["m"])).alias("hits"))  # a hundred rows each
    n = a.agg(F.max("doc_id")).first()[0] + 1
    replies = pages.select(F.concat(F.lit("page="), F.col("page") + 1).alias("key"), F.concat(F.lit(f'{{"response":{{"numFound":{n},"docs":'), "hits", F.lit("}}")).alias("text"))
    replies = replies.unionByName(a.select(F.concat(F.lit("https://archive.org/metadata/"), "doc_id").alias("key"), F.lit('{"metadata":{},"files":[{"name":"a.pdf"},{"name":"b.txt"}]}').alias("text")))
    replies = replies.unionByName(a.select(F.concat(F.lit("https://archive.org/download/"), "doc_id", F.lit("/b.txt")).alias("key"), "text"))
    fetch = harvest.recorded(replies, lambda url: F.coalesce(F.nullif(F.regexp_extract(url, r"&(page=\d+)\z", 1), F.lit("")), url))
    source = {"id": "ia", "protocol": "internet-archive", "endpoint": "https://search", "options": {"query": "q"}}
    got = harvest.collect_country(spark, _SPAIN, source, fetch=fetch, limit=limit, rows=100)
    return got.select("id", "title", "date", "rights", F.length("text").cast("bigint").alias("n"))


def archive_harvest(spark, d):
    """Every eligible item of a paged search of an archive."""
    return _archive(spark, d, None)


def archive_first(spark, d):
    """The first forty eligible items in the order of the search; nothing past them is fetched: the limit is the operator."""
    return _archive(spark, d, 40)


def letters_first(spark, d):
    """The first sixty letters of a list, in its order, whose bodies are long enough: the limit is the operator."""
    a = table(spark, d, "documents").where("doc_id IS NOT NULL")
    record = F.struct(F.concat(F.lit("T"), "doc_id").alias("title"), F.concat(F.lit("https://f/documents/A/"), "doc_id", F.lit("/")).alias("permalink"), F.lit("p").alias("project"), _cycle(DATES).alias("date-from"))
    listing = a.groupBy(F.expr("doc_id div 100").alias("page")).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", record.alias("m")))), lambda x: x["m"])).alias("text"))  # a hundred rows each
    replies = a.select(F.concat(F.lit(harvest.LETTERS_API + "A/"), "doc_id").alias("key"), F.to_json(F.struct(F.col("text").alias("content"), F.array(F.col("lang")).alias("recipients"))).alias("text"))
    got = harvest.collect("founders", listing, fetch=harvest.recorded(replies), limit=60)
    return got.select("id", "title", "date", F.get_json_object("metadata", "$.recipients[0]").alias("recipient"), F.length("text").cast("bigint").alias("n"))


def json_replies(spark, d):
    """What a table of replies gives of those that must be JSON: the last ones, malformed ones left out, after it was compacted."""
    p = table(spark, d, "pages").select("page_id", F.concat(F.lit("https://p/"), "page_id").alias("url"), "html")
    replies = bronze.Bronze(spark, _own(spark, "replies"))
    replies.add(p.select("url", F.concat(F.lit('{"n":'), "page_id", F.lit("}")).alias("text")))
    replies.add(p.where("page_id % 3 = 0").select("url", F.concat(F.lit('{"again":'), "page_id", F.lit("}")).alias("text")))
    replies.add(p.where("page_id % 5 = 1").select("url", F.col("html").alias("text")))
    replies.compact()
    return replies.known(p.select("url"), as_json=True)


def character_windows(spark, d):
    """Windows of forty characters that overlap by ten."""
    a = table(spark, d, "documents").where("text <> ''")
    return a.select("doc_id", F.posexplode(chunking.char_windows(F.col("text"), 40, 10)).alias("nth", "t")).select("doc_id", "nth", F.md5("t").alias("h"))


def _marked(rows):
    return [{**r, "text": r["text"].replace("e", "3"), "title": r["title"] + "!"} for r in rows]


def _derivable(spark, d):
    a = _documents(spark, d).withColumns({"language": F.lit("es"), "rights": F.lit("Public domain"), "country": F.lit("spain"), "pos": F.col("doc_id")})
    return derive.validated(as_documents(a, "pos"), "spain", "es")


_BOUNDS = {"size": 50, "max_document": 10**9, "max_batch": 2 * 10**9, "max_input": 10**15}


def derived_corpus(spark, d):
    """All documents derived on the executors, then those that have changed once more; the last row of each."""
    docs, method = _derivable(spark, d), derive.Method("marked", _marked)
    run = derive.Run(spark, _own(spark, "derived"), "spain")
    run.execute(docs, method, bulk=True, **_BOUNDS)
    changed = F.col("pos") % 4 == 1
    run.execute(docs.withColumn("text", F.when(changed, F.concat("text", F.lit(" new"))).otherwise(F.col("text"))), method, bulk=True, **_BOUNDS)
    run.compact(most=0)
    return run.table("output").select("source_document_id", "title", F.md5("text").alias("h"), "language", "content_mode")


def derived_first(spark, d):
    """The first hundred pending documents, derived in marked batches of fifty: the limit is the operator."""
    run = derive.Run(spark, _own(spark, "derived"), "spain")
    run.execute(_derivable(spark, d), derive.Method("marked", _marked), limit=100, **_BOUNDS)
    return run.table("output").select("source_document_id", F.md5("text").alias("h"))


def page_documents(spark, d):
    """Newspaper items of a catalogue in a range of years, with the first of their texts that is long enough."""
    a = table(spark, d, "documents")
    item = F.concat(F.lit('{"id":"http://i/'), "doc_id", F.lit('","title":"Daily","genre":["'), F.when(F.col("doc_id") % 3 == 0, "Periodicals").otherwise("Newspapers"), F.lit('"],"date":"'), _cycle(["1901", "1950", ""]), F.lit('"}'))
    items = a.select(F.concat(F.lit("http://i/"), "doc_id").alias("item_url"), item.alias("item"), F.concat(F.lit('[{"fulltext_file":"http://none","url":"http://t/'), "doc_id", F.lit('.txt"}]')).alias("resources"))
    texts = a.select(F.concat(F.lit("http://t/"), "doc_id", F.lit(".txt")).alias("url"), F.col("text").alias("body"))
    return newspapers.item_documents(items, texts).select("url", "date", "genre")


def source_limit(spark, d):
    """The first documents in source order: the limit is the operator."""
    return catalogue.first_until(table(spark, d, "documents").select("doc_id", "lang"), 25, "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        document_rows, eligible_rows, serial_chunks, books, letters, archive_documents, oai_documents, newspaper_issues, newspaper_pages, tei_texts, value_rules, resource_urls, manifest_urls,
        catalogue_values, identities, prefixes, vector_norms, built_index, jsonl_rows, registry_sources, export_documents, archive_harvest, archive_first, letters_first, json_replies, character_windows, derived_corpus, derived_first, page_documents, source_limit,
    )
}

# ---- the same in SQL ---------------------------------------------------------------------------------------------

_SRC = "CASE WHEN doc_id % 2 = 0 THEN 'loc_chronicling_america' ELSE source END"
_YEAR = "try_cast(nullif(regexp_extract({}, '\\b(1[5-9]\\d{{2}}|20\\d{{2}})\\b', 1), '') AS int)"


def _tidy(x: str) -> str:
    hyphen = r"'([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g'"
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\r\n?', chr(10), 'g'), {hyphen}), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"


_OK = lambda c: f"{c} IN ('Public Domain', 'Public domain', 'CC BY-SA 4.0')"
_KINDS = "['Annual report of x', 'A novel of y', 'Untitled'][doc_id % 3 + 1]"
_JSON = """'{"genre":"","id":"' || doc_id || '","place":"","text":"' || {t} || '","title":"t"}'""".replace("{t}", "replace(replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(9), '\\t')")
_FULL = """'{"genre":"","id":"' || doc_id || '","language":"' || lang || '","place":"","text":"' || """ + "replace(replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(9), '\\t')" + """ || '","title":"t"}'"""

_HARVEST = f"SELECT 'ia:' || doc_id AS id, 'T' || doc_id AS title, {_YEAR.format(_list(DATES))}::varchar AS date, {_list(RIGHTS)} AS rights, length({_tidy('text')}) AS n FROM documents WHERE {_YEAR.format(_list(DATES))} <= 1929 AND {_OK(_list(RIGHTS))} AND length({_tidy('text')}) >= 100"

ORACLE: dict[str, str] = {
    "document_rows": f"SELECT cast(doc_id AS varchar) AS id, {_SRC} AS source, md5(text) AS h, {_list(DATES)} AS date, 0::bigint AS n_authors, '' AS place, '' AS genre, '' AS rights, 'america' AS country, lang AS language, 'native' AS content_mode, '{{}}' AS metadata FROM documents",
    "eligible_rows": f"SELECT cast(doc_id AS varchar) AS id FROM documents WHERE doc_id % 2 = 0 AND coalesce({_YEAR.format(_list(DATES))} BETWEEN 1890 AND 1899, true)",
    "serial_chunks": f"""WITH a AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'To be continued.' || chr(10) || text ELSE text END AS t FROM documents),
        n AS (SELECT doc_id, {' + '.join(f"(regexp_matches(t, '{p}'))::int" for p in classify.STRONG_MARKS)} AS s, {' + '.join(f"(regexp_matches(t, '{p}'))::int" for p in classify.WEAK_MARKS)} AS w FROM a)
        SELECT cast(doc_id AS varchar) AS id, CASE WHEN doc_id % 2 = 0 AND (s > 0 OR w >= 2) THEN 'excluded' ELSE 'kept' END AS part FROM n""",
    "books": f"SELECT 'https://x/' || doc_id || '.txt' AS url, 'nonfiction' AS status FROM documents WHERE doc_id % 7 <> 0 AND (doc_id % 3 = 0 OR strlen(text) <= 5000) AND {_KINDS} <> 'A novel of y' AND coalesce({_YEAR.format(_list(DATES))} <= 1929, true) AND length({_tidy('text')}) >= 100",
    "letters": f"SELECT 'founders:' || doc_id AS id, {_list(DATES)} AS date_from FROM documents WHERE doc_id % 5 <> 0 AND {_list(DATES)} <> '' AND coalesce({_YEAR.format(_list(DATES))} <= 1929, true) AND length({_tidy('text')}) >= 80",
    "archive_documents": f"""WITH a AS (SELECT doc_id, text, {_YEAR.format(_list(DATES))} AS y, CASE WHEN doc_id % 3 = 0 THEN 'Public domain' ELSE {_list(RIGHTS)} END AS r FROM documents)
        SELECT 'ia:' || doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'Better' ELSE 'T' END AS title, r AS rights FROM a WHERE y <= 1929 AND {_OK('r')} AND length({_tidy('text')}) >= 100""",
    "oai_documents": f"SELECT 's:' || substr(sha256('o' || item_id), 1, 24) AS id, 'c. 1850' AS date, 'A|B' AS authors, 'http://x/' || item_id || '.txt' AS url, 'Public domain' AS rights, length({_tidy('text || chr(32) || text')}) AS n FROM benchmark WHERE item_id % 4 <> 0 AND item_id % 5 <> 0 AND length({_tidy('text || chr(32) || text')}) >= 100",
    "newspaper_issues": "SELECT 'https://b/' || page_id || '/' AS base, 'https://b/' || page_id || '/sn1/' || page_id || '.xml' AS url, 'sn1' AS lccn, '1900-01-02' AS date, '1' AS edition FROM pages",
    "newspaper_pages": rf"""WITH t AS (SELECT item_id, {_tidy(r"array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''), ' ') || chr(10) || 'end'")} AS t FROM benchmark)
        SELECT 'Sun, page 1' AS title, 'https://www.loc.gov/resource/sn' || item_id || '/1900-01-02/ed-1/?sp=1' AS url, length(t) AS n FROM t WHERE length(t) >= 100""",
    "tei_texts": rf"""SELECT item_id, 'T ' || item_id AS title, 2::bigint AS n_authors, 1::bigint AS n_subjects, '9' AS words,
        md5({_tidy(r"trim(regexp_replace(text || ' n n', '\s+', ' ', 'g')) || chr(10) || chr(10) || 'n n'")}) AS h FROM benchmark""",
    "value_rules": f"""WITH a AS (SELECT *, {_list(['//h/', 'http://h/', 'https://h/a/'])} || doc_id || {_list(['.txt?x=1', '/', '.TEXT', '.pdf'])} AS u FROM documents)
        SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'none' END AS first, CASE WHEN doc_id % 2 = 0 THEN source || '|' ELSE '' END || lang AS present, CASE WHEN u LIKE '//%' THEN 'https:' || u ELSE u END AS url,
        doc_id || {_list(['.txt?x=1', '', '.TEXT', '.pdf'])} AS segment, CASE WHEN doc_id % 4 IN (0, 2) THEN u ELSE 'http://r.txt' END AS text_url FROM a""",
    "resource_urls": "SELECT doc_id, 'http://f/1' || CASE WHEN doc_id % 2 = 0 THEN '|http://t/' || doc_id || '.txt' ELSE '' END || '|http://f/' || doc_id || '.txt' AS urls FROM documents",
    "manifest_urls": "SELECT doc_id, 0 AS nth, 'https://h/' || doc_id AS url FROM documents UNION ALL SELECT doc_id, 1, NULL FROM documents WHERE doc_id % 3 = 2",
    "catalogue_values": "SELECT doc_id, source || '|a|b|deep|z|y|True|c|k' AS subjects, 0::bigint AS n_call_numbers, '7' AS languages FROM documents",
    "identities": f"SELECT cast(doc_id AS varchar) AS id, sha256({_FULL}) AS source_hash, sha256(sha256({_FULL}) || chr(31) || 'm') AS identity, length({_JSON}) AS chars FROM documents",
    "prefixes": "SELECT vec_id, ['query: ', 'Represent this sentence for searching relevant passages: ', ''][vec_id % 3 + 1] AS query, ['passage: ', '', ''][vec_id % 3 + 1] AS document FROM embeddings",
    "vector_norms": "SELECT cast(doc_id AS varchar) AS id, 16::bigint AS n, 1.0::double AS norm FROM documents",
    "built_index": f"""WITH n AS (SELECT doc_id, lang, {' + '.join(f"(regexp_matches(text, '{p}'))::int" for p in classify.STRONG_MARKS)} AS s, {' + '.join(f"(regexp_matches(text, '{p}'))::int" for p in classify.WEAK_MARKS)} AS w FROM documents),
        k AS (SELECT lang, doc_id % 2 = 0 AND (s > 0 OR w >= 2) AS gone FROM n)
        SELECT count(*) FILTER (NOT gone) AS chunks, count(*) FILTER (gone) AS excluded, count(*) FILTER (NOT gone) AS vectors, 8::bigint AS dimensions, count(*) FILTER (NOT gone) AS lexical_rows, 'america' AS country, string_agg(DISTINCT lang, '|' ORDER BY lang) FILTER (NOT gone) AS languages FROM k""",
    "jsonl_rows": f"SELECT cast(doc_id AS varchar) AS id, {_SRC} AS source, md5(text) AS h, {_list(DATES)} AS date, 'america' AS country FROM documents",
    "registry_sources": """WITH c AS (SELECT CASE WHEN n_nationkey = 3 THEN 'america' ELSE replace(lower(n_name), '_', '-') END AS country, n_nationkey FROM nation)
        SELECT country, 's' AS source, ['enabled', 'disabled', 'conditional'][n_nationkey % 3 + 1] AS status, row_number() OVER (ORDER BY country <> 'america', country) - 1 AS nth FROM c""",
    "export_documents": f"""WITH a AS (SELECT item_id, {_tidy("text || ' ' || text")} AS t, {_list(DATES, 'item_id')} AS date, {_list(RIGHTS, 'item_id')} AS rights FROM benchmark WHERE ['s', '', 'z'][item_id % 5 % 3 + 1] <> 'z')
        SELECT 'spain:s:' || substr(sha256(item_id::varchar), 1, 24) AS id, CASE WHEN item_id % 2 = 0 THEN 'T' ELSE 'file' END AS title, md5(t) AS h, date, rights, 'spain' AS country, item_id::varchar AS local_record_id, 'source_record' AS rights_status, 'local' AS protocol
        FROM a WHERE {_YEAR.format('date')} <= 1929 AND {_OK('rights')} AND length(t) >= 100""",
    "archive_harvest": _HARVEST,
    "archive_first": f"SELECT * EXCLUDE (doc_id) FROM (SELECT * FROM ({_HARVEST.replace('SELECT', 'SELECT doc_id,', 1)}) ORDER BY doc_id LIMIT 40)",
    "letters_first": f"""SELECT 'founders:A/' || doc_id AS id, 'T' || doc_id AS title, {_list(DATES)} AS date, lang AS recipient, length({_tidy('text')}) AS n FROM documents
        WHERE {_list(DATES)} <> '' AND coalesce({_YEAR.format(_list(DATES))} <= 1929, true) AND length({_tidy('text')}) >= 80 ORDER BY doc_id LIMIT 60""",
    "json_replies": """SELECT 'https://p/' || page_id AS url, '{"' || CASE WHEN page_id % 3 = 0 THEN 'again' ELSE 'n' END || '":' || page_id || '}' AS text FROM pages WHERE page_id % 5 <> 1""",
    "character_windows": "WITH w AS (SELECT doc_id, text, unnest(range(0, greatest(0, length(text) - 11) + 1, 30)) AS i FROM documents WHERE text <> '') SELECT doc_id, (i // 30)::int AS nth, md5(substring(text, (i + 1)::bigint, 40)) AS h FROM w",
    "derived_corpus": "SELECT doc_id::varchar AS source_document_id, 't!' AS title, md5(replace(text || CASE WHEN doc_id % 4 = 1 THEN ' new' ELSE '' END, 'e', '3')) AS h, 'en' AS language, 'english_translation' AS content_mode FROM documents",
    "derived_first": "SELECT doc_id::varchar AS source_document_id, md5(replace(text, 'e', '3')) AS h FROM documents ORDER BY doc_id LIMIT 100",
    "page_documents": f"SELECT 'http://i/' || doc_id AS url, {_list(['1901', '1950', ''])} AS date, 'newspaper_page' AS genre FROM documents WHERE doc_id % 3 <> 0 AND {_list(['1901', '1950', ''])} <> '1950' AND length({_tidy('text')}) >= 100",
    "source_limit": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25",
}
