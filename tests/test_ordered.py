"""Harvests in order, with an early end, through shared limits and a table of replies; streams of pages."""

import json
import threading
import time
import urllib.parse
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from cairn.schemas import as_documents
from cairn.sources import bronze, harvest, leases, ordered, paged
from cairn.streaming import incremental
from pyspark.sql import functions as F

LONG = "word " * 40
SPAIN = {"id": "spain", "language": "es", "publication_cutoff": 1929, "cutoff_note": "n"}


@pytest.fixture
def server():
    """A web server whose replies a test gives as a function of path and query; it counts requests."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urllib.parse.urlsplit(self.path)
            with s.lock:
                s.asked.append((url.path, dict(urllib.parse.parse_qsl(url.query))))
                s.times.append(time.monotonic())
            text = s.reply(url.path, dict(urllib.parse.parse_qsl(url.query)))
            self.send_response(200 if text is not None else 404)
            self.end_headers()
            self.wfile.write((text or "").encode())

        def log_message(self, *a):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    s.asked, s.times, s.lock, s.url = [], [], threading.Lock(), f"http://127.0.0.1:{s.server_address[1]}"
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield s
    s.shutdown()


def listed(spark, n):
    return spark.range(n).select((n - 1 - F.col("id")).alias("pos"), F.lit(None).cast("string").alias("x")).repartition(3)


def built(keep, seen):
    def build(part):
        seen.append(sorted(r.pos for r in part.select("pos").collect()))
        d = part.where(keep).select(F.concat(F.lit("d"), F.lpad(F.col("pos").cast("string"), 4, "0")).alias("id"), F.lit("s").alias("source"), F.lit("t").alias("title"), F.lit("x").alias("text"), F.lit("u").alias("url"), "pos")
        return as_documents(d, "pos")

    return build


def test_documents_come_in_order_and_the_work_ends_early(spark):
    seen = []
    got = ordered.first_documents(listed(spark, 1000), built("pos % 3 = 1", seen), 20)
    assert [r.id for r in got.collect()] == [f"d{k:04}" for k in range(1, 60, 3)]
    flat = [p for part in seen for p in part]
    assert flat == list(range(len(flat))) and 58 <= len(flat) <= 80 and len(seen) <= 3
    assert ordered.first_documents(listed(spark, 50), built("pos >= 0", [])).count() == 50
    assert ordered.first_documents(listed(spark, 50), built("pos > 100", []), 5).count() == 0
    assert ordered.first_documents(listed(spark, 0), built("pos >= 0", []), 5).count() == 0
    with pytest.raises(ValueError, match="positive"):
        ordered.first_documents(listed(spark, 5), built("pos >= 0", []), 0)
    rare = []
    assert [r.id for r in ordered.first_documents(listed(spark, 1000), built("pos = 900", rare), 1).collect()] == ["d0900"] and len(rare) <= 5


def test_a_block_is_made_only_when_it_is_needed(spark):
    made = []

    def blocks():
        for k in range(10):
            made.append(k)
            yield spark.range(10 * k, 10 * k + 10).select(F.col("id").alias("pos"))

    got = ordered.in_order(blocks(), built("pos % 2 = 0", []), 12)
    assert [r.id for r in got.collect()] == [f"d{k:04}" for k in range(0, 24, 2)] and made == [0, 1, 2]


def archive(server, n, rows):
    """A search of n items in pages, of which every third has eligible rights."""

    def reply(path, query):
        if path == "/search":
            page, per = int(query["page"]), int(query["rows"])
            assert per == rows
            ids = range((page - 1) * per, min(n, page * per))
            return json.dumps({"response": {"numFound": n, "docs": [{"identifier": f"i{k}", "year": "1890", "title": f"T{k}", "licenseurl": "public domain" if k % 3 == 0 else "reserved"} for k in ids]}})

    server.reply = reply
    return {"id": "ia", "protocol": "internet-archive", "endpoint": f"{server.url}/search", "options": {"query": "q"}}


def mixed(server):
    """Searches go to the server, items and texts are recorded; counts the addresses asked for."""
    asked = Counter()
    item = json.dumps({"metadata": {}, "files": [{"name": "x.txt"}]})

    def fetch(urls):
        own = urls.where(F.col("url").startswith(server.url))
        rest = [r.url for r in urls.where(~F.col("url").startswith(server.url)).distinct().collect()]
        asked.update("item" if "/metadata/" in u else "text" for u in rest)
        table = {u: item if "/metadata/" in u else LONG for u in rest}
        return harvest.fetched(own).unionByName(harvest.replayed(table)(urls.where(~F.col("url").startswith(server.url))))

    return fetch, asked


def test_archive_search_is_paged_as_far_as_needed(spark, server):
    source = archive(server, 2500, 1000)
    fetch, asked = mixed(server)
    got = harvest.collect_country(spark, SPAIN, source, fetch=fetch, rows=1000).collect()
    assert [r.id for r in got] == [f"ia:i{k}" for k in range(0, 2500, 3)] and asked == {"item": 2500, "text": 834}
    assert sorted(int(q["page"]) for _, q in server.asked) == [1, 2, 3]
    server.asked.clear()
    source, (fetch, asked) = archive(server, 2500, 20), mixed(server)
    got = harvest.collect_country(spark, SPAIN, source, fetch=fetch, limit=5).collect()
    assert [r.id for r in got] == [f"ia:i{k}" for k in (0, 3, 6, 9, 12)]
    assert [int(q["page"]) for _, q in server.asked] == [1] and asked["item"] <= 20 and asked["text"] <= 7
    source, (fetch, asked) = archive(server, 2500, 20), mixed(server)
    assert harvest.collect_country(spark, SPAIN, source, fetch=fetch, limit=5).count() == 5


def test_newspaper_search_is_built_and_paged(spark, server, monkeypatch):
    monkeypatch.setattr(harvest, "NEWSPAPER_SEARCH", f"{server.url}/newspapers/")

    def reply(path, query):
        if path == "/newspapers/":
            first = (int(query["sp"]) - 1) * int(query["c"])
            return json.dumps({"results": [{"id": f"{server.url}/item/{k}"} for k in range(first, min(45, first + int(query["c"])))], "pagination": {"of": 45}})
        if path.startswith("/item/"):
            k = int(path.rsplit("/", 1)[1])
            return json.dumps({"item": {"title": "Daily", "genre": ["Newspapers"], "date": "1901", "id": f"p{k:02}"}, "resources": [{"fulltext_file": f"{server.url}/text/{k}"}]})
        return LONG if int(path.rsplit("/", 1)[1]) % 2 else "short"

    server.reply = reply
    got = harvest.collect_named(spark, "chronicling", limit=12, query="gold rush", date_from=1900, date_to=1910).collect()
    assert [r.url for r in got] == [f"p{k:02}" for k in range(1, 24, 2)]
    searches = [q for p, q in server.asked if p == "/newspapers/"]
    assert searches[0] == {"fo": "json", "c": "36", "dates": "1900/1910", "at": "results,pagination", "q": "gold rush", "sp": "1"} and len(searches) == 1
    assert sum(p.startswith("/text/") for p, _ in server.asked) < 36
    server.asked.clear()
    assert [r.url for r in harvest.collect_named(spark, "loc-chronicling-america").collect()] == [f"p{k:02}" for k in range(1, 45, 2)]


def test_batches_and_letters_in_order(spark, tmp_path):
    def page(k):
        return f'<a><TextLine><String CONTENT="{LONG}{k}"/></TextLine></a>'

    replies = {"https://b/BATCH.xml": "<batch>" + "".join(f'<issue lccn="sn{k}" issueDate="1900-01-0{k}">sn{k}/1.xml</issue>' for k in (3, 1, 2)) + "</batch>"}
    for k in (1, 2, 3):
        replies[f"https://b/sn{k}/1.xml"] = '<mets xmlns:xlink="http://www.w3.org/1999/xlink">' + "".join(f'<file USE="ocr"><FLocat xlink:href="{n}.xml"/></file>' for n in (9, 4)) + "</mets>"
        replies |= {f"https://b/sn{k}/{n}.xml": page(n) for n in (9, 4)}
    got = harvest.collect_named(spark, "batches", bases=["https://b/"], limit=3, fetch=harvest.replayed(replies)).collect()
    assert [r.url.split("/resource/")[1] for r in got] == ["sn3/1900-01-03/ed-1/?sp=1", "sn3/1900-01-03/ed-1/?sp=2", "sn1/1900-01-01/ed-1/?sp=1"]
    assert harvest.collect_named(spark, "batches", bases=["https://b/", "https://none/"], fetch=harvest.replayed(replies)).count() == 6
    (tmp_path / "l.json").write_text(json.dumps([{"title": f"t{k}", "permalink": f"https://f/documents/A/{k}/", "date-from": "1750"} for k in (5, 2, 8, 1)]))
    body = {harvest.LETTERS_API + f"A/{k}": json.dumps({"content": LONG}) for k in (2, 8, 1)}
    got = harvest.collect_named(spark, "founders", listing=str(tmp_path / "l.json"), limit=2, fetch=harvest.replayed(body)).collect()
    assert [r.id for r in got] == ["founders:A/2", "founders:A/8"]
    with pytest.raises(RuntimeError, match="give a file"):
        harvest.collect_named(spark, "founders", fetch=harvest.replayed({}))


def test_book_records_that_the_list_lacks_are_fetched(spark):
    files = spark.createDataFrame([(json.dumps([{"url": "//x/9.txt"}, {"url": "//x/1.txt", "item_id": "http://www.loc.gov/item/1/"}, {"url": "//x/2.txt", "item_id": "https://www.loc.gov/item/2"}, {"url": "//x/3.pdf"}]),)], "text string")
    cards = spark.createDataFrame([("[]",)], "text string")
    record = lambda t: json.dumps({"item": {"title": t, "subject": ["Labor"], "date": "1900", "call_number": ["HD1"]}})
    asked = []

    def fetch(urls):
        asked.extend(r.url for r in urls.distinct().collect())
        return harvest.replayed({"https://x/9.json": record("Annual report of x"), "https://www.loc.gov/item/1/?fo=json": record("A novel"), "https://x/9.txt": LONG, "https://x/1.txt": LONG})(urls)

    got = harvest.book_documents(files, cards, fetch).collect()
    assert [(r.title, r.date) for r in got] == [("Annual report of x", "1900")] and "https://x/1.txt" not in asked and "https://x/2.txt" not in asked


def pages_of(n, last=True):
    record = '<record><header><identifier>o{0}</identifier></header><metadata><dc xmlns="http://purl.org/dc/elements/1.1/"><date>1850</date><title>T{0}</title><identifier>http://x/{0}.txt</identifier><rights>Public domain</rights></dc></metadata></record>'

    def reply(path, query):
        k = int(query.get("resumptionToken", "t0")[1:])
        more = f"<resumptionToken>t{k + 1}</resumptionToken>" if k + 1 < n else ""
        return f'<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>{"".join(record.format(10 * k + i) for i in range(10))}{more}</ListRecords></OAI-PMH>'

    return reply


def test_a_limit_ends_the_paging_of_a_catalogue(spark, server):
    server.reply = pages_of(150)
    source = {"id": "s", "protocol": "oai-pmh", "endpoint": server.url, "options": {}}

    def fetch(urls):
        return harvest.replayed({r.url: LONG for r in urls.distinct().collect()})(urls)

    got = harvest.collect_country(spark, SPAIN, source, fetch=fetch, limit=25).collect()
    assert [r.title for r in got] == [f"T{k}" for k in range(25)] and len(server.asked) == 3
    server.asked.clear()
    assert harvest.collect_country(spark, SPAIN, source, fetch=fetch, limit=1200).count() == 1200 and 120 <= len(server.asked) <= 127  # no end at 100 pages


def test_one_limit_for_all_tasks_and_harvests(spark, server):
    server.reply = lambda path, query: "text"
    limits = {f":{server.server_address[1]}/": 60 * 20 / 0.9}  # 20 requests a second in all
    # all work in one of four tasks: others' shares aren't lost
    urls = spark.range(30).select(F.concat(F.lit(f"{server.url}/"), "id").alias("url"))
    got = {}

    def run(k):
        own = urls.withColumn("url", F.concat("url", F.lit(f"?h={k}")))
        got[k] = harvest.fetched(own, tasks=1 if k else 4, limits=limits).where("text IS NOT NULL").count()

    began = time.monotonic()
    both = [threading.Thread(target=run, args=(k,)) for k in (0, 1)]
    [t.start() for t in both]
    [t.join() for t in both]
    span = max(server.times) - began
    assert got == {0: 30, 1: 30} and len(server.times) == 60
    # sixty slots lie a twentieth of a second apart, whoever took them, and the last request came after the last slot
    part = next(iter(limits))
    assert leases.Leases.of(spark).free[part] - began >= 60 / 20 - 0.01 and 59 / 20 - 0.01 <= span <= 60


def test_slots_of_a_lease():
    now = [0.0]
    s = leases.Leases("127.0.0.1", clock=lambda: now[0])
    try:
        assert [round(s.slot("a", 60 / 0.9), 3) for _ in range(3)] == [0, 1, 2] and s.slot("b", 1) == 0
        now[0] = 10.0
        assert s.slot("a", 60) == 0
        with pytest.raises(RuntimeError, match="refused"):
            leases.Lease(s.address._replace(token="no"), "a", 60).wait()
    finally:
        s.close()


def test_replies_are_fetched_once(spark, server, tmp_path):
    server.reply = lambda path, query: None if path == "/gone" else "{broken" if path == "/bad" and len(server.asked) < 4 else json.dumps({"p": path})
    table = bronze.Bronze(spark, str(tmp_path / "replies"))
    urls = spark.createDataFrame([(f"{server.url}/{p}",) for p in ("a", "b", "bad", "gone", "a")] + [(None,)], "url string")
    fetch = table.through(lambda u: harvest.fetched(u, tasks=1, threads=1), as_json=True)
    first = {r.url[len(server.url) :]: (r.text, r.error is None) for r in fetch(urls).collect()}
    assert set(first) == {"/a", "/b", "/bad", "/gone"} and first["/a"] == ('{"p": "/a"}', True) and first["/gone"] == (None, False)
    n = len(server.asked)
    again = fetch(urls)
    asked = Counter(p for p, _ in server.asked[n:])
    assert asked["/a"] == asked["/b"] == 0 and asked["/gone"] >= 1  # what came isn't asked for again, what failed is
    assert {r.url[len(server.url) :] for r in again.where("text IS NOT NULL").collect()} == {"/a", "/b", "/bad"}
    n = len(server.asked)
    good = urls.where(~F.col("url").endswith("gone"))
    assert fetch(good).count() == 3 and fetch(good).count() == 3 and len(server.asked) == n  # a second harvest sends no request
    table.add(spark.createDataFrame([(f"{server.url}/a", "{}")], "url string, text string"))
    table.add(spark.createDataFrame([(f"{server.url}/c", "not json")], "url string, text string"))
    before = {(r.url, r.text) for r in table.known(table.rows()).collect()}
    table.compact()
    assert {(r.url, r.text) for r in table.rows().collect()} == before and (f"{server.url}/a", "{}") in before
    assert table.rows().count() == table.rows().select("key").distinct().count() == 4
    assert table.known(table.rows(), as_json=True).count() == 3


def test_pages_as_a_stream_that_goes_on_where_it_ended(spark, server, tmp_path):
    server.reply = pages_of(12)
    paged.register(spark)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(batches):
        done = threading.Event()
        stream = spark.readStream.format("paged_catalogue").option("path", server.url).option("cache", str(tmp_path / "cache")).load()
        q = incremental.append_pages(stream, out, checkpoint)
        until = time.monotonic() + 60
        while len(q.recentProgress) < batches and q.isActive and time.monotonic() < until:
            time.sleep(0.1)
        q.stop()
        done.set()

    run(2)
    first = {r.page for r in spark.read.parquet(out).collect()}
    assert first and max(first) < 11
    assert len({q.get("resumptionToken", "") for _, q in server.asked}) < 12
    until = time.monotonic() + 90
    while time.monotonic() < until and spark.read.parquet(out).count() < 12:
        run(13)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.page for r in rows) == list(range(12))  # each page once
    assert max(Counter(q.get("resumptionToken", "") for _, q in server.asked).values()) <= 2  # a request that stop() cut off
    assert paged.catalogue_records(spark.read.parquet(out)).select("identifier").distinct().count() == 120


def test_a_whole_harvest_fetches_in_two_blocks_and_joins_the_asked_replies_only(spark):
    n = 45
    page = lambda p: json.dumps({"response": {"numFound": n, "docs": [{"identifier": f"i{k}", "year": "1890", "title": f"T{k}", "licenseurl": "public domain"} for k in range(3 * p - 3, min(n, 3 * p))]}})
    rows = [(f"page={p}", page(p)) for p in range(1, 16)]
    rows += [(f"https://archive.org/metadata/i{k}", '{"metadata":{},"files":[{"name":"b.txt"}]}') for k in range(n)]
    rows += [(f"https://archive.org/download/i{k}/b.txt", f"long text {k} " * 20) for k in range(n)]
    fetch = harvest.recorded(spark.createDataFrame(rows, "key string, text string"), lambda url: F.coalesce(F.nullif(F.regexp_extract(url, r"&(page=\d+)\z", 1), F.lit("")), url))
    asked = []

    def counted(urls):
        got = fetch(urls)
        asked.append(got._jdf.queryExecution().optimizedPlan().toString())
        return got

    source = {"id": "ia", "protocol": "internet-archive", "endpoint": "https://s", "options": {"query": "q"}}
    country = {"id": "spain", "language": "es", "publication_cutoff": 1929, "cutoff_note": ""}
    got = harvest.collect_country(spark, country, source, fetch=counted, rows=3).collect()
    assert [r.id for r in got] == [f"ia:i{k}" for k in range(n)]
    assert len(asked) == 6  # pages, items and texts of the first page, and of all others at once
    assert all("LeftSemi" in p for p in asked)
    missing = fetch(spark.createDataFrame([("https://s&page=99",), ("none",)], "url string")).collect()
    assert {(r.url, r.text, r.error) for r in missing} == {("https://s&page=99", None, "not recorded"), ("none", None, "not recorded")}
