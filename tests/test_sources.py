import hashlib
import io
import json
import random

import pytest
from cairn import schemas
from cairn.functions import records
from cairn.operators import audit
from cairn.sources import archive, catalogue, harvest, local, markup, newspapers, paged, registry, tei
from pyspark.sql import functions as F


def test_jsonl(spark, tmp_path):
    f = tmp_path / "a.jsonl"
    row = {"id": "1", "source": "s", "title": "t", "text": "é", "url": "u"}
    f.write_text("﻿" + json.dumps(row) + "\n\n  \n", encoding="utf-8")
    got = local.read_jsonl(spark, str(f))
    assert got.count() == 1 and got.first().text == "é"
    f.write_text(json.dumps({**row, "odd": 1}))
    with pytest.raises(Exception, match="unknown keys"):
        local.read_jsonl(spark, str(f)).collect()
    f.write_text("{")
    with pytest.raises(Exception, match="malformed"):
        local.read_jsonl(spark, str(f)).collect()
    out = str(tmp_path / "out")
    for _ in range(2):
        local.write_jsonl(got.limit(0).unionByName(spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)), allowMissingColumns=True), out)
    assert spark.read.json(out).count() == 1


def export(tmp_path, **over):
    (tmp_path / "t").mkdir(exist_ok=True)
    (tmp_path / "t" / "a.txt").write_text("Historia del pueblo. " * 20)
    (tmp_path / "t" / "b.xml").write_text("<a><p>Texto &amp; más </p>" + "<p>palabras </p>" * 30 + "</a>")
    base = {"id": "1", "source": "s", "path": "t/a.txt", "title": "T", "date": "1898", "url": "u", "rights": "Public domain"}
    rows = [base, {**base, "id": "2", "path": "t/b.xml"}, {**base, "id": "3", "date": "1950"}, {**base, "id": "4", "date": "?"}, {**base, "id": "5", "rights": "reserved"}, {**base, "id": "6", "source": "z"}, {**base, "id": "7", **over}]
    (tmp_path / "records.jsonl").write_text("\n".join(map(json.dumps, rows)))
    return str(tmp_path)


def test_local_export(spark, tmp_path):
    kw = {"source": "s", "country": "spain", "language": "es", "cutoff": 1929, "caution": "c", "protocol": "p"}
    got = {json.loads(r.metadata)["local_record_id"]: r for r in local.local_export(spark, export(tmp_path), **kw).collect()}
    assert sorted(got) == ["1", "2", "7"] and got["2"].text.startswith("Texto & más palabras palabras")
    assert got["1"].id == "spain:s:" + hashlib.sha256(b"1").hexdigest()[:24]
    assert json.loads(got["1"].metadata) == {"protocol": "p", "local_export": True, "local_record_id": "1", "source_file": "t/a.txt", "publication_year_filter": 1929, "rights_status": "source_record", "rights_caution": "c"}
    assert local.local_export(spark, export(tmp_path), **kw, rights_override="operator").count() == 4
    with pytest.raises(ValueError, match="blank"):
        local.local_export(spark, export(tmp_path), **kw, rights_override=" ")
    assert local.local_export(spark, export(tmp_path), **kw, max_bytes=10).count() == 0
    assert [json.loads(r.metadata)["local_record_id"] for r in local.local_export(spark, export(tmp_path), **kw, limit=2).collect()] == ["1", "2"]
    for bad in ("../x.txt", "/etc/passwd", "", "t/../../x"):
        with pytest.raises(Exception, match="path must be"):
            local.local_export(spark, export(tmp_path, path=bad), **kw).collect()


def test_local_export_reads_xml_as_xml(spark, tmp_path):
    kw = {"source": "s", "country": "spain", "language": "es", "cutoff": 1929}
    export(tmp_path)
    (tmp_path / "t" / "c.TEI").write_bytes("<?xml version='1.0' encoding='ISO-8859-1'?><a>\n  caf&#233; señor <![CDATA[a < b and c > d, kept words]]><!-- no -->".encode("latin-1") + b"<p>x</p>" * 60 + b"</a>")
    rec = {"id": "", "path": "./t/x/../c.TEI", "title": "", "date": "1898, again 1850", "url": "u", "rights": "Public domain"}
    (tmp_path / "records.jsonl").write_text(json.dumps(rec))
    got = local.local_export(spark, str(tmp_path), **kw).collect()
    assert [(r.title, r.date, r.id) for r in got] == [("c", "1898, again 1850", "spain:s:" + hashlib.sha256(b"./t/x/../c.TEI").hexdigest()[:24])]
    assert got[0].text.startswith("café señor a < b and c > d, kept words x x x")
    (tmp_path / "t" / "c.TEI").write_text("<a>" + "x" * 200)
    with pytest.raises(Exception, match="ParseError|no element"):
        local.local_export(spark, str(tmp_path), **kw).collect()
    (tmp_path / "records.jsonl").write_text(json.dumps({**rec, "path": "t/a.txt", "url": ""}))
    with pytest.raises(Exception, match="without an address"):
        local.local_export(spark, str(tmp_path), **kw).collect()


def test_registry(spark, tmp_path):
    for name, sources in (("spain", [{"id": "a", "name": "A", "protocol": "oai-pmh", "endpoint": "e", "rights_note": "r", "options": {"status": "conditional"}}, {"id": "b", "name": "B", "protocol": "p", "endpoint": "e", "rights_note": "r"}]), ("america", [])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "manifest.json").write_text(json.dumps({"id": name, "name": name, "language": "es", "language_name": "x", "native_query_default": "q", "publication_cutoff": 1929, "cutoff_note": "", "sources": sources}))
    r = registry.registry(spark, str(tmp_path))
    assert [x.id for x in r.collect()] == ["america", "spain"]
    assert {x.source: x.status for x in registry.sources(r).collect()} == {"a": "conditional", "b": "enabled"}
    m = registry.country(spark, "spain", str(tmp_path))
    assert registry.usable_source(m, "b")["protocol"] == "p"
    for bad in ("a", "zz"):
        with pytest.raises(ValueError):
            registry.usable_source(m, bad)
    for bad in ("../x", "france"):
        with pytest.raises(ValueError):
            registry.country(spark, bad, str(tmp_path))


PAGE = '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>{}{}</ListRecords></OAI-PMH>'
RECORD = '<record><header{}><identifier>{}</identifier></header><metadata><dc xmlns="http://purl.org/dc/elements/1.1/"><date>1850</date><title> A  b </title><identifier>http://x/{}.txt</identifier>{}</dc></metadata></record>'


def test_paged_catalogue(spark, tmp_path):
    (tmp_path / "").mkdir(exist_ok=True)
    ok, no = "<rights>Public domain</rights>", ""
    (tmp_path / "page-0.xml").write_text(PAGE.format(RECORD.format("", "o1", "1", ok) + RECORD.format(' status="deleted"', "o2", "2", ok), "<resumptionToken>t</resumptionToken>"))
    (tmp_path / "page-1.xml").write_text(PAGE.format(RECORD.format("", "o3", "3", no), ""))
    (tmp_path / "page-2.xml").write_text(PAGE.format(RECORD.format("", "o4", "4", ok), ""))
    paged.register(spark)
    pages = spark.read.format("paged_catalogue").option("replay", str(tmp_path))
    rows = paged.catalogue_records(pages.load())
    with pytest.raises(Exception, match="more pages"):
        pages.option("pages", 1).load().count()
    assert pages.option("pages", 1).option("rest", "ignore").load().count() == 1
    assert [r.identifier for r in rows.orderBy("page", "nth").collect()] == ["o1", "o3"]
    kept = paged.eligible_records(rows, 1900).collect()
    assert [(r.identifier, r.text_url, r.title, r.year) for r in kept] == [("o1", "http://x/1.txt", "A b", 1850)]
    assert paged.eligible_records(rows, 1800).count() == 0
    texts = spark.createDataFrame([("http://x/1.txt", "word " * 40)], "url string, text string")
    kw = {"source": "s", "endpoint": "e", "country": "spain", "language": "es", "cutoff": 1900}
    d = paged.record_documents(rows, texts, **kw).collect()
    assert [(r.title, r.url, r.date, r.country, json.loads(r.metadata)["oai_identifier"]) for r in d] == [("A b", "http://x/1.txt", "1850", "spain", "o1")]
    assert paged.record_documents(rows, texts.limit(0), **kw).count() == 0


class Reply(io.BytesIO):
    class headers:  # noqa: N801
        get_content_charset = staticmethod(lambda: None)


def test_fetch_caches_and_retries(tmp_path, monkeypatch):
    import urllib.error

    monkeypatch.setattr(paged.time, "sleep", lambda s: None)
    calls = []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) == 1:
            raise urllib.error.HTTPError(url, 503, "", {}, None)
        return Reply(b"hello")

    for _ in range(2):
        assert paged.fetch("http://a", cache=str(tmp_path), opener=opener) == "hello"
    assert len(calls) == 2

    def limited(url, timeout):
        raise urllib.error.HTTPError(url, 429, "", {}, None)

    with pytest.raises(paged.RateLimited):
        paged.fetch("http://b", opener=limited)
    with pytest.raises(RuntimeError, match="empty"):
        paged.fetch("http://c", opener=lambda u, timeout: Reply(b" "))


def test_markup(spark):
    alto = '<alto xmlns="x"><L><TextLine><String CONTENT="Hello"/><SP/><String CONTENT="wor-"/></TextLine><Deep><TextLine><String CONTENT="ld"/></TextLine></Deep></L></alto>'
    assert markup.parse_alto(spark.createDataFrame([(1, alto)], "k int, xml string")).first().text == "Hello world"
    tei = "<TEI><title>T</title><author>A</author><author>A</author><term>s</term><p>one <note>two</note></p></TEI>"
    got = markup.parse_tei(spark.createDataFrame([(1, tei), (2, "<bad"), (3, None)], "k int, xml string")).collect()
    assert [(r.k, r.title, r.authors, r.subjects, r.text) for r in got] == [(1, "T", ["A", "A"], ["s"], "one two\n\ntwo")]


def test_catalogue(spark):
    payloads = ['[{"url":"a"}]', '{"cols":["url","n"],"rows":[["b","1"]]}', '{"items":[{"url":"c"}]}', '{"x":1}']
    got = spark.createDataFrame([(p,) for p in payloads], "p string").select(catalogue.manifest_rows(F.col("p")).alias("r")).collect()
    assert [[dict(m) for m in r.r] for r in got] == [[{"url": "a"}], [{"url": "b", "n": "1"}], [{"url": "c"}], []]
    files = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(f).cast("string").alias("format"), F.lit(s).cast("bigint").alias("size")) for n, f, s in (("a.txt", None, 5), ("b.txt", "DjVuTXT", 50), ("c.pdf", "PDF", 1))])
    assert spark.range(1).select(catalogue.preferred_file(files, 100)["name"], catalogue.preferred_file(files, 10)["name"], catalogue.preferred_file(files, 1)["name"]).collect()[0][:] == ("b.txt", "a.txt", None)
    row = lambda u: F.create_map(F.lit("object_key"), F.lit(u))
    assert spark.range(1).select(catalogue.file_url(row("//h/x")), catalogue.file_url(row("h/x")), catalogue.file_url(row("http://h/x"))).collect()[0][:] == ("https://h/x", "https://h/x", "http://h/x")


def test_books_and_letters(spark):
    long = "word " * 40
    files = spark.createDataFrame([("https://x/1.txt", 5), ("https://x/2.txt", None), ("https://x/3.txt", 10**9), ("https://x/4.pdf", 1)], "url string, size bigint")
    records = spark.createDataFrame([("/i/1", "Annual report of x", ["Labor"], [], "1900", 0), ("/i/2", "A novel", [], [], "", 1), ("/i/3", "Report of y", [], [], "", 2)], "id string, title string, subjects array<string>, call_numbers array<string>, date string, pos bigint")
    texts = spark.createDataFrame([(f"https://x/{i}.txt", long) for i in (1, 2, 3)], "url string, text string")
    joined = catalogue.with_records(files, records, ["id"])
    assert [r.url for r in catalogue.books(joined, texts).collect()] == ["https://x/1.txt"]
    meta = spark.createDataFrame([("t", "https://f/documents/A/1", "p", ["a"], "1750-09-29"), ("t", "https://f/documents/A/2", "p", [], ""), ("t", "https://f/other/3", "p", [], "1750")], "title string, permalink string, project string, authors array<string>, date_from string")
    bodies = spark.createDataFrame([("A/1", long), ("A/2", long)], "api_id string, content string")
    assert [r.id for r in catalogue.letters(meta, bodies).collect()] == ["founders:A/1"]


def test_audit(spark):
    f = spark.createDataFrame([(1, "a", "1"), (1, "b", '""'), (2, "a", "0"), (2, "b", "[]"), (3, "a", None), (3, "b", "{}")], "record int, field string, value string")
    assert {r.field: (r.n_present, r.percent) for r in audit.field_coverage(f).collect()} == {"a": (2, 66.7), "b": (1, 33.3)}
    v = spark.createDataFrame([("f", "x", 2), ("f", "y", 1), ("f", "z", 3), ("f", "z", 4)], "field string, value string, pos int")
    assert [r.value for r in audit.frequent_values(v, 2).orderBy("nth").collect()] == ["z", "y"]
    assert [r.period for r in audit.by_period(spark.createDataFrame([(1849,), (1850,), (1700,)], "y int"), F.col("y")).orderBy("y").collect()] == ["1800-1849", "1850-1879"]


def test_newspaper_batch(spark):
    batch = '<batch><issue lccn="sn1" issueDate="1900-01-02" editionOrder="1">..\\batch_x\\sn1\\1900/0001.xml</issue><issue lccn="sn2" issueDate="1900">/x/data/sn2/a.xml</issue><issue> </issue></batch>'
    issues = newspapers.batch_issues(spark.createDataFrame([("https://b/batch/", batch)], "base string, xml string"))
    got = {r.lccn: r for r in issues.collect()}
    assert got["sn1"].url == "https://b/batch/sn1/1900/0001.xml" and got["sn2"].url == "https://b/batch/sn2/a.xml" and got["sn2"].edition == "1"
    mets = '<mets LABEL="The Sun" xmlns:xlink="http://www.w3.org/1999/xlink"><file USE="ocr"><FLocat xlink:href="./p1.xml"/></file><file USE="ocr"/><file USE="image"><FLocat xlink:href="i.jp2"/></file><file USE="ocr"><FLocat xlink:href="p2.xml"/></file></mets>'
    pages = newspapers.issue_pages(issues, spark.createDataFrame([(got["sn1"].url, mets), (got["sn2"].url, "<bad")], "url string, xml string"))
    assert [(r.page, r.ocr_url) for r in pages.orderBy("page").collect()] == [(1, "https://b/batch/sn1/1900/p1.xml"), (2, "https://b/batch/sn1/1900/p2.xml")]
    line = lambda t: f'<a><TextLine><String CONTENT="{t}"/></TextLine></a>'
    docs = newspapers.page_documents(pages, spark.createDataFrame([("https://b/batch/sn1/1900/p1.xml", line("word " * 30)), ("https://b/batch/sn1/1900/p2.xml", line("short"))], "url string, xml string"))
    assert [(r.title, r.url, r.genre) for r in docs.collect()] == [("The Sun, page 1", "https://www.loc.gov/resource/sn1/1900-01-02/ed-1/?sp=1", "newspaper_page")]


def test_newspaper_items(spark):
    long = "text " * 30
    item = lambda **k: json.dumps({"id": "http://i", "title": "Daily", "genre": ["Newspapers"], "date": "1901", "location": ["ohio"], **k})
    res = json.dumps([{"fulltext_file": "http://t/none", "files": [{"url": "http://t/b.txt"}, {"url": "x.pdf"}]}])
    rows = [("http://i/1", item(), res), ("http://i/2", item(date="1950"), res), ("http://i/3", item(genre=["Periodicals"]), res), ("http://i/4", item(date=""), res), ("http://i/5", item(), "[]")]
    texts = spark.createDataFrame([("http://t/none", "short"), ("http://t/b.txt", json.dumps({"k": {"full_text": long}}))], "url string, body string")
    docs = newspapers.item_documents(spark.createDataFrame(rows, "item_url string, item string, resources string"), texts)
    assert sorted((r.date, r.place, json.loads(r.metadata)["ocr_url"]) for r in docs.collect()) == [("", "ohio", "http://t/b.txt"), ("1901", "ohio", "http://t/b.txt")]


def test_archive(spark):
    found = spark.createDataFrame([("a", "1890", None, "T", None), ("b", "1990", None, "T", None), ("c", "1800", None, "T", "http://creativecommons.org/publicdomain/mark/1.0/"), ("", "1800", None, "T", None)], "identifier string, year string, date string, title string, licenseurl string")
    files = [{"name": "x.pdf", "format": "PDF", "size": 1}, {"name": "x_djvu.txt", "format": "DjVuTXT", "size": 9}]
    items = spark.createDataFrame([("a", "public domain", "Better", "1890", ["M"], files), ("c", "", "", "", [], files)], "identifier string, licenseurl string, title string, date string, creators array<string>, files array<struct<name:string,format:string,size:bigint>>")
    texts = spark.createDataFrame([(f"https://archive.org/download/{i}/x_djvu.txt", "word " * 40) for i in "ac"], "url string, text string")
    got = {r.id: r for r in archive.documents(found, items, texts, source="ia", country="spain", language="es", cutoff=1929).collect()}
    assert got["ia:a"].title == "Better" and got["ia:c"].title == "T" and got["ia:c"].rights.startswith("http") and len(got) == 2


def test_tei_documents_and_review_list(spark, tmp_path):
    body = "<p>" + "word " * 40 + "</p>"
    (tmp_path / "sub").mkdir()
    for name, title, term in (("N1.xml", "A sermon", "Sermons"), ("N2.XML", "Poems on things", "Poetry"), ("sub/N3.xml", "Short", "x")):
        (tmp_path / name).write_text(f"<TEI><title>{title}</title><author>A</author><publicationYear>1790</publicationYear><term>{term}</term>{body if 'N3' not in name else '<p>x</p>'}</TEI>")
    (tmp_path / "N4.xml").write_text("<TEI><broken")
    files = tei.read(spark, str(tmp_path))
    assert [r.stem for r in files.orderBy("path").collect()] == ["N1", "N2", "N3"]
    assert {r.id for r in tei.documents(files).collect()} == {"evans:N1"}
    assert {r.id for r in tei.documents(files, review_candidates=True).collect()} == {"evans:N1", "evans:N2"}
    out = tmp_path / "review.csv"
    assert tei.write_review_list(files, str(out)) == (3, 1)
    text = out.read_text(encoding="utf-8-sig")
    assert text.splitlines()[0].startswith("tcp_id,title") and "N2,Poems on things,1790,A,Poetry" in text
    assert tei.write_review_list(files.limit(0), str(out)) == (0, 0) and out.read_text(encoding="utf-8-sig").strip() == "tcp_id"


def test_values_at_any_depth(spark):
    deep = "[" * 50 + '"deep"' + "]" * 50
    values = {deep: ["deep"], "null": [], '"a\\"[b"': ['a"[b'], "7": ["7"], "1.50": ["1.50"], "true": ["True"], '{"z": [1, {"q": 2}], "a": "x: {"}': ["z", "a"], '[1, null, "", {"k": null}, [["m"], {}], "é\\u00e9"]': ["1", "", "k", "m", "éé"], "[]": [], "{}": []}
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert {r.v: r.x for r in df.select("v", records.strings_in(F.col("v")).alias("x")).collect()} == values
    got = spark.createDataFrame([('{"subject":["b",["a",{"y":1,"c":2}]," "],"subjects":"[x]","item":{"subject":"b","subjects":null}}',), (None,), ("{",)], "r string").select(records.both_levels(F.col("r"), "subject", "subjects").alias("x")).collect()
    assert [r.x for r in got] == [["b", "a", "y", "c", "[x]"], [], []]


def test_seen_addresses_equal_a_sequential_reader(spark):
    rng = random.Random(2)
    for n in (0, 1, 60):
        urls = [rng.choice(["http://www.loc.gov/", "https://www.loc.gov/", "http://x/", ""]) + str(rng.randint(0, 6)) if rng.random() > 0.1 else rng.choice([None, ""]) for _ in range(n)]
        seen, want = set(), []
        for k, raw in enumerate(urls):
            if not raw or raw in seen:
                continue
            seen.add(raw.replace("http://www.loc.gov/", "https://www.loc.gov/"))
            want.append(k)
        rows = spark.createDataFrame(list(enumerate(urls)), "pos bigint, raw string").withColumn("url", harvest.canonical_item(F.col("raw")))
        assert sorted(r.pos for r in audit.first_seen(rows, "raw", "url", "pos").collect()) == want


def test_sample_of_newspapers(spark):
    searches = {"1800/1849": {"results": [{"id": "http://www.loc.gov/a"}, {"url": "https://www.loc.gov/b?x=1"}, {}]}, "1850/1879": {"results": [{"id": "https://www.loc.gov/a"}, {"id": "http://www.loc.gov/c"}]}, "1910/1929": {"results": []}}
    items = {"a": {"item": {"genre": ["Newspapers", "x"], "language": "english", "title": "", "n": 0}}, "b": {"genre": "Newspapers", "language": ["french", "english"], "it's": 1}}

    def fetch(urls):
        table = {}
        for r in urls.collect():
            part = next((v for k, v in searches.items() if f"dates={k.replace('/', '%2F')}" in r.url), None)
            name = r.url.split("loc.gov/")[1][0]
            if part is not None:
                table[r.url] = json.dumps(part)
            elif r.url.endswith("fo=json&at=item,resources") and name in items:
                table[r.url] = json.dumps(items[name])
        return harvest.replayed(table)(urls)

    records_, errors = harvest.newspaper_sample(spark, 3, fetch)
    assert [json.loads(r.item).get("language") for r in records_.collect()] == ["english", ["french", "english"]]
    assert errors == ["1880-1909: not recorded"]
    report = audit.field_report(records_)
    assert report["records"] == 2 and report["field_coverage"] == {"genre": {"count": 2, "percent": 100.0}, "it's": {"count": 1, "percent": 50.0}, "language": {"count": 2, "percent": 100.0}, "n": {"count": 1, "percent": 50.0}}
    assert report["selected_values"] == {"genre": {"Newspapers": 2, "x": 1}, "language": {"english": 2, "french": 1}, "type": {}}


def test_places():
    assert schemas.place_of("corpus", "d/", "america", "native") == "d/america/data/corpus.jsonl" and schemas.place_of("corpus", "d", "spain", "english") == "d/spain/data/corpus.english.jsonl"
    assert schemas.place_of("index", "d", "america", "english") == "d/america/data/index.english" and schemas.content_mode("english") == "english_translation" and schemas.content_mode("native") == "native"
