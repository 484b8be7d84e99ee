import io
import json

import pytest
from cairn.operators import responses
from cairn.sources import harvest, paged
from pyspark.sql import functions as F

LONG = "word " * 40
SPAIN = {"id": "spain", "language": "es", "publication_cutoff": 1929, "cutoff_note": "n"}


def urls(spark, *u):
    return spark.createDataFrame([(x,) for x in u], "url string")


def test_fetched_keeps_what_comes_and_says_what_fails(spark):
    def fetch(url, cache=None, pace=None):
        if "bad" in url:
            raise paged.RateLimited(url)
        return f"text of {url}"

    got = {r.url: (r.text, r.error) for r in harvest.fetched(urls(spark, "a", "bad", "a", None), fetch=fetch).collect()}
    assert got == {"a": ("text of a", None), "bad": (None, "RateLimited: bad")}


def test_limits(spark):
    got = [r[0] for r in urls(spark, "https://tile.loc.gov/text-services/x", "https://www.loc.gov/item", "http://x/data/batches/y", "http://x").select(harvest.limit_of(F.col("url"))).collect()]
    assert got == [150, 20, 60, None]


def test_dispatch(spark):
    with pytest.raises(ValueError, match="unknown source"):
        harvest.collect("nothing")
    with pytest.raises(ValueError, match="no collector"):
        harvest.collect_country(spark, SPAIN, {"id": "s", "protocol": "ftp", "endpoint": "e", "options": {}})
    with pytest.raises(ValueError, match="positive"):
        harvest.collect_country(spark, SPAIN, {"id": "s", "protocol": "oai-pmh", "endpoint": "e", "options": {}}, limit=0)
    with pytest.raises(ValueError, match="unknown source"):
        harvest.collect_named(spark, "nothing")
    with pytest.raises(ValueError, match="address"):
        harvest.collect_named(spark, "batches")
    with pytest.raises(ValueError, match="folder"):
        harvest.collect_named(spark, "evans")


def test_catalogue_harvest(spark):
    record = '<record><header><identifier>o{0}</identifier></header><metadata><dc xmlns="http://purl.org/dc/elements/1.1/"><date>{1}</date><title>T</title><identifier>http://x/{0}.txt</identifier><rights>Public domain</rights></dc></metadata></record>'
    page = '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>' + record.format(1, 1850) + record.format(2, 1990) + record.format(3, 1860) + "</ListRecords></OAI-PMH>"
    pages = spark.createDataFrame([("", 0, page)], "set string, page int, xml string")
    source = {"id": "s", "protocol": "oai-pmh", "endpoint": "e", "options": {}}
    got = harvest.collect_country(spark, SPAIN, source, fetch=harvest.replayed({"http://x/1.txt": LONG, "http://x/2.txt": LONG}), pages=pages).collect()
    assert [(r.title, r.url, r.country) for r in got] == [("T", "http://x/1.txt", "spain")] and json.loads(got[0].metadata)["rights_caution"] == "n"


def test_archive_harvest(spark):
    source = {"id": "ia", "protocol": "internet-archive", "endpoint": "https://s", "options": {"query": "q"}}
    found = {"response": {"numFound": 2, "docs": [{"identifier": "a", "year": "1890", "title": "T", "licenseurl": "public domain", "creator": "Z", "subject": ["s", "t"]}, {"identifier": "b", "year": 1990}]}}
    item = {"metadata": {"title": "Better", "creator": ["M", "N"]}, "files": [{"name": "x.pdf", "format": "PDF"}, {"name": "x_djvu.txt", "format": "DjVuTXT", "size": "9"}]}

    def fetch(u):
        return harvest.replayed({"https://archive.org/metadata/a": json.dumps(item), "https://archive.org/metadata/b": json.dumps(item), "https://archive.org/download/a/x_djvu.txt": LONG, **{r.url: json.dumps(found) for r in u.collect() if r.url.startswith("https://s?q=q&")}})(u)

    got = harvest.collect_country(spark, SPAIN, source, fetch=fetch, limit=5).collect()
    assert [(r.id, r.title, r.authors, json.loads(r.metadata)["subjects"], json.loads(r.metadata)["rights_caution"]) for r in got] == [("ia:a", "Better", ["M", "N"], ["s", "t"], "n")]


def test_collections(spark):
    listing = spark.createDataFrame([(json.dumps({"documents": [{"title": "t", "permalink": "https://f/documents/A/1/", "project": "p", "authors": ["a"], "date-from": "1750-09-29"}, {"title": "u", "permalink": "https://f/documents/A/2", "date-from": ""}]}),)], "text string")
    body = {harvest.LETTERS_API + "A/1": json.dumps({"content": LONG, "title": "Letter", "recipients": ["r"]})}
    got = harvest.collect("founders", listing, fetch=harvest.replayed(body)).collect()
    assert [(r.id, r.title, r.date, r.authors, json.loads(r.metadata)["recipients"]) for r in got] == [("founders:A/1", "Letter", "1750-09-29", ["a"], ["r"])]
    files = spark.createDataFrame([(json.dumps([{"url": "//x/1.txt", "size": 5, "item_id": "http://www.loc.gov/item/1/"}, {"url": "//x/2.txt", "id": "2"}, {"n": 1}]),)], "text string")
    cards = spark.createDataFrame([(json.dumps([{"id": "/i/1/", "Object_id": "1", "title": "Annual report of x", "item": {"subject": ["Labor"], "title": "Annual report of x", "date": ["1900"], "location": [{"ohio": 1}], "contributor": ["C"]}}, {"id": "/i/2", "title": "A novel"}]),)], "text string")
    got = harvest.collect("loc-books", files, cards, fetch=harvest.replayed({"https://x/1.txt": LONG, "https://x/2.txt": LONG})).collect()
    assert [(r.id, r.title, r.date, r.place, r.authors, r.url) for r in got] == [("locbook:1", "Annual report of x", "1900", "ohio", ["C"], "https://www.loc.gov/item/1")]
    found = spark.createDataFrame([(json.dumps({"results": [{"id": "http://i/1", "title": "Daily"}, {"url": "http://i/2?x=1"}, {}]}),)], "text string")
    item = lambda k: json.dumps({"item": {"genre": ["Newspapers"], "date": "1901", "subjects": "s", "medium": "paper", "number_edition": [2]}, "resources": [{"fulltext_file": f"http://t/{k}", "iiif_manifest_url": "http://m"}]})
    got = harvest.collect("chronicling", found, fetch=harvest.replayed({"http://i/1?fo=json": item(1), "http://i/2?x=1&fo=json": item(2), "http://t/1": LONG})).collect()
    assert [(r.url, r.title) for r in got] == [("http://i/1", "Daily")]
    meta = json.loads(got[0].metadata)
    assert (meta["subjects"], meta["medium"], meta["edition_number"], meta["iiif_manifest_url"], meta["partof"], meta["date_issued"]) == ("s", "paper", [2], "http://m", [], "")
    batch = '<batch><issue lccn="sn1" issueDate="1900-01-02">sn1/1.xml</issue></batch>'
    mets = '<mets xmlns:xlink="http://www.w3.org/1999/xlink"><file USE="ocr"><FLocat xlink:href="p.xml"/></file></mets>'
    alto = f'<a><TextLine><String CONTENT="{LONG}"/></TextLine></a>'
    replies = {"https://b/BATCH.xml": batch, "https://b/sn1/1.xml": mets, "https://b/sn1/p.xml": alto}
    got = harvest.batch_documents(spark, spark.createDataFrame([("https://b/",)], "base string"), harvest.replayed(replies)).collect()
    assert [r.title for r in got] == ["Newspaper issue 1900-01-02, page 1"]


def test_added_rows_are_counted(spark, tmp_path):
    from cairn.schemas import as_documents

    d = as_documents(spark.createDataFrame([("1", "s", "t", "x", "u")], "id string, source string, title string, text string, url string"))
    assert harvest.add_new(d, str(tmp_path / "o")) == 1 and harvest.add_new(d, str(tmp_path / "o")) == 1 and spark.read.json(str(tmp_path / "o")).count() == 2


ASKED = [{"id": str(k), "title": "t", "text": "x", "place": "", "genre": ""} for k in (1, 2)]


def envelope(rows=None, **over):
    text = json.dumps({"translations": ASKED if rows is None else rows})
    return {"id": "r1", "model": "m", "status": "completed", "usage": {"n": 1}, "output": [{"type": "message", "content": [{"type": "output_text", "text": text}]}], **over}


def client(reply, **over):
    raw = reply if isinstance(reply, bytes) else json.dumps(reply).encode()
    return responses.Client(**{"model": "m", "instructions": "i", "execute": True, "key": "k", "opener": lambda request, timeout: io.BytesIO(raw), **over})


def test_strict_client():
    c = client(envelope(list(reversed(ASKED))))
    assert c.run(ASKED).rows == ASKED and c.log[0]["response_id"] == "r1" and c.log[0]["input_sha256"] == c.log[0]["output_sha256"]
    assert client(envelope(output=[], output_text=json.dumps({"translations": ASKED}))).run(ASKED).rows == ASKED
    with pytest.raises(RuntimeError, match="execute"):
        client(envelope(), execute=False).run(ASKED)


@pytest.mark.parametrize(
    "reply",
    [
        b"{", [], envelope(error={"x": 1}), envelope(status="incomplete"), envelope(model="other"), envelope(id=""), envelope(usage=None), envelope(output="x"), envelope(output=[{"content": ["x"]}]),
        envelope(output=[{"content": [{"type": "refusal"}]}]), envelope(output=[]), envelope(output=[{"content": [{"type": "output_text", "text": 1}]}]), envelope(output=[{"content": [{"type": "output_text", "text": "no"}]}]), envelope(ASKED[:1]), envelope([{**r, "x": ""} for r in ASKED]),
    ],
)
def test_bad_replies_raise(reply):
    with pytest.raises(RuntimeError):
        client(reply).run(ASKED)
