"""Harvests: texts fetched in parallel under shared limits, and a builder of documents for each protocol and collection.

A harvest has candidates, which a source lists in an order (the rows of a search, the records of a catalogue, the files of
a manifest), and a build that fetches what they need and gives the documents of those that pass. ordered.in_order() runs
the build over ranges of candidates until a limit is reached, so that documents come in the order of the source and a
limit ends the work. Filters on metadata come before any text is fetched.
"""

from __future__ import annotations

import json
import urllib.parse
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import catalogue_fields, strings
from ..functions.text import clean_text, stable_id
from ..operators import audit
from ..schemas import as_documents
from ..session import stored
from . import archive, catalogue, leases, local, markup, newspapers, ordered, paged, tei
from .bronze import Bronze

# Requests a minute that the services publish, by what their addresses hold (the first that fits counts),
# addresses of the services, and notes on rights.
LIMITS = (("tile.loc.gov/text-services/", 150), ("tile.loc.gov/storage-services/", 150), ("www.loc.gov/", 20), ("/data/batches/", 60))
ARCHIVE_FIELDS = ("identifier", "title", "date", "year", "creator", "description", "subject", "licenseurl")
LETTERS_LIST = "https://founders.archives.gov/Metadata/founders-online-metadata.json"
LETTERS_API = "https://founders.archives.gov/API/docdata/"
NEWSPAPER_SEARCH = "https://www.loc.gov/newspapers/"
BOOK_FILES = "https://data.labs.loc.gov/digitized-books/sample-data/manifest.json"
BOOK_RECORDS = "https://data.labs.loc.gov/digitized-books/sample-data/metadata.json"
BOOK_RIGHTS = "Public domain; credit Library of Congress"
LETTERS_RIGHTS = "Check Founders Online terms; historical text and modern editorial material differ"

#: Rows of a search reply at most.
SEARCH_ROWS = 1000

Fetch = Callable[[DataFrame], DataFrame]


def service_of(url: Column) -> Column:
    """What an address shares its limit with; null where no limit is published."""
    out = F.lit(None).cast("string")
    for part, _ in reversed(LIMITS):
        out = F.when(F.contains(url, F.lit(part)), part).otherwise(out)
    return out


def limit_of(url: Column) -> Column:
    """Requests a minute that the service of an address allows; null where none is published."""
    return F.create_map(*[F.lit(x) for kv in LIMITS for x in kv])[service_of(url)]


def fetched(urls: DataFrame, *, cache: str | None = None, tasks: int = 4, threads: int = 4, opener=None, fetch=paged.fetch, limits: dict[str, float] | None = None) -> DataFrame:
    """(url, text, error) of the distinct addresses, in no order; one that fails has no text and says why.

    Addresses are dealt to `tasks` tasks, `threads` at a time in each. All tasks, and all other harvests of the
    application, keep to one limit of each service: each request takes a lease from the driver (see leases), so a busy
    task gets what others leave. limits: requests a minute by part of an address, in place of LIMITS. opener: as
    paged.fetch() takes it.
    """
    limits = dict(LIMITS) if limits is None else limits
    server = leases.Leases.of(urls.sparkSession).address

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(url: str) -> tuple[str | None, str | None]:
            service = next((part for part in limits if part in url), None)
            pace = leases.Lease(server, service, limits[service]) if service else None
            try:
                return fetch(url, cache=cache, pace=pace, **({"opener": opener} if opener else {})), None
            except Exception as e:  # one address must not end the others' task
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(threads) as pool:
            for b in batches:
                rows = b.column(0).to_pylist()
                for k in range(0, len(rows), threads * 4):
                    part = rows[k : k + threads * 4]
                    got = list(pool.map(one, part))
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([t for t, _ in got], pa.string()), pa.array([e for _, e in got], pa.string())], ["url", "text", "error"])

    own = urls.select("url").where("url IS NOT NULL").distinct()
    return own.repartition(tasks, "url").mapInArrow(run, "url string, text string, error string")


def _there(replies: DataFrame) -> DataFrame:
    return replies.where("text IS NOT NULL")


def _one_url(spark: SparkSession, url: str) -> DataFrame:
    return spark.createDataFrame([(url,)], "url string")


def search_replies(spark: SparkSession, address: str, fetch: Fetch, *, total: str, rows: int, key: str = "page", whole: bool = False) -> Iterator[DataFrame]:
    """Blocks of a search's replies as (page, url, text): the first page, then those that its total asks for, in blocks
    that double, or in one block if the whole search is wanted. The pages of a block are fetched in parallel, and none before its block is asked for.

    address: with its query but the page; total: the JSON path of the number of hits; rows: hits of a page; key: the
    query's name of the page. A page that can't be fetched raises, as its rows would be missing unseen.
    """

    def block(first: int, last: int) -> DataFrame:
        asked = spark.range(first, last + 1).select(F.col("id").alias("page"), F.concat(F.lit(f"{address}&{key}="), "id").alias("url"))
        got = stored(fetch(asked.select("url")).join(asked, "url"), "search")
        bad = got.where("text IS NULL").select("url", "error").first()
        if bad is not None:
            raise RuntimeError(f"a page of the search failed: {bad['url']}: {bad['error']}")
        return got.select("page", "url", "text")

    one = block(1, 1)
    hits = one.select(F.get_json_object("text", total).try_cast("bigint").alias("n")).first()
    yield one
    pages, at = -(-(hits["n"] or 0) // rows) if hits else 0, 2
    width = pages if whole else 1
    while at <= pages:
        yield block(at, min(pages, at + width - 1))
        at, width = at + width, 2 * width


def _place(page: Column, nth: Column) -> Column:
    """One number by page and then by place on it."""
    return page.cast("bigint") * (1 << 32) + nth


def catalogue_blocks(spark: SparkSession, settings: dict) -> Iterator[DataFrame]:
    """Blocks of a catalogue's pages as (set, page, xml), each twice as many as before, from the token that the last names."""
    paged.register(spark)
    token, page, width = "", 0, 1
    while True:
        got = stored(spark.read.format("paged_catalogue").options(**settings, token=token, page=page, pages=width, rest="ignore").load(), "pages")
        yield got
        last = got.orderBy(F.desc("page")).first()
        token = markup.page_token(last["xml"]) if last else ""
        if not token:
            return
        page, width = last["page"] + 1, 2 * width


def from_catalogue(spark: SparkSession, country: dict, source: dict, fetch: Fetch = fetched, *, limit: int | None = None, pages: DataFrame | None = None, max_bytes: int = local.MAX_BYTES, **options) -> DataFrame:
    """Documents of an OAI catalogue in its order: pages, eligible records, their texts. A limit also ends the paging."""
    if pages is not None:
        blocks = iter([pages])
    elif limit is None:
        paged.register(spark)
        blocks = iter([spark.read.format("paged_catalogue").options(**_catalogue_options(source, options), pages=options.get("pages", 1 << 31)).load()])
    else:
        blocks = catalogue_blocks(spark, _catalogue_options(source, options))
    records = (paged.catalogue_records(b).withColumn("pos", _place(F.col("page"), F.col("nth"))) for b in blocks)

    def build(part: DataFrame) -> DataFrame:
        wanted = paged.eligible_records(part, country["publication_cutoff"]).select(F.col("text_url").alias("url"))
        return paged.record_documents(part, _there(fetch(wanted)), source=source["id"], endpoint=source["endpoint"], country=country["id"], language=country["language"], cutoff=country["publication_cutoff"], caution=country.get("cutoff_note") or "", max_bytes=max_bytes)

    return ordered.in_order(records, build, limit)


def _catalogue_options(source: dict, options: dict) -> dict:
    o = source["options"]
    return {"path": source["endpoint"], "set": o.get("set", ""), "prefix": o.get("metadata_prefix", "oai_dc"), **options}


def _many(c: Column) -> Column:
    """array<string> of a JSON value that is a text, a list or absent."""
    return F.coalesce(F.when(c.startswith("["), F.from_json(c, "array<string>")), F.filter(F.array(c), lambda v: v.isNotNull() & (v != "")))


def found_items(replies: DataFrame) -> DataFrame:
    """(identifier, year, date, title, licenseurl, creators, subjects, pos) of the rows that search replies list, by page and place.

    replies: (text), and page if there are several.
    """
    page = F.col("page") if "page" in replies.columns else F.lit(1)
    a = _there(replies).select(page.alias("page"), F.posexplode(F.from_json(F.get_json_object("text", "$.response.docs"), "array<map<string,string>>")).alias("nth", "m"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    return a.select(*[get(k).alias(k) for k in ("identifier", "year", "date", "title", "licenseurl")], _many(get("creator")).alias("creators"), _many(get("subject")).alias("subjects"), _place(F.col("page"), F.col("nth")).alias("pos"))


def item_records(replies: DataFrame) -> DataFrame:
    """(identifier, licenseurl, title, date, creators, subjects, files) of item replies, the identifier from the address."""
    get = lambda k: F.get_json_object("text", f"$.metadata.{k}")
    files = F.from_json(F.get_json_object("text", "$.files"), "array<struct<name:string,format:string,size:string>>")
    sized = F.transform(F.coalesce(files, F.array()), lambda f: F.struct(f["name"].alias("name"), f["format"].alias("format"), f["size"].try_cast("bigint").alias("size")))
    return _there(replies).select(F.substring_index("url", "/", -1).alias("identifier"), get("licenseurl").alias("licenseurl"), get("title").alias("title"), get("date").alias("date"), _many(get("creator")).alias("creators"), _many(get("subject")).alias("subjects"), sized.alias("files"))


def from_archive(spark: SparkSession, country: dict, source: dict, fetch: Fetch = fetched, *, limit: int | None = None, rows: int | None = None, max_bytes: int = local.MAX_BYTES) -> DataFrame:
    """Documents of a digital archive in the order of a search: all its pages, the items they list, the preferred text of each."""
    rows = rows or (SEARCH_ROWS if limit is None else min(SEARCH_ROWS, max(4 * limit, 20)))
    query = [("q", source["options"]["query"]), *(("fl[]", k) for k in ARCHIVE_FIELDS), ("rows", rows), ("output", "json")]
    replies = search_replies(spark, f"{source['endpoint']}?{urllib.parse.urlencode(query)}", fetch, total="$.response.numFound", rows=rows, whole=limit is None)
    cutoff = country["publication_cutoff"]

    def build(part: DataFrame) -> DataFrame:
        asked = archive.dated(part, cutoff).select(F.concat(F.lit("https://archive.org/metadata/"), "identifier").alias("url"))
        items = item_records(stored(fetch(asked), "items"))
        texts = stored(fetch(archive.eligible(part, items, cutoff, max_bytes).select(F.col("text_url").alias("url"))), "texts")
        return archive.documents(part, items, _there(texts), source=source["id"], country=country["id"], language=country["language"], cutoff=cutoff, caution=country.get("cutoff_note") or "", max_bytes=max_bytes)

    return ordered.in_order((found_items(r) for r in replies), build, limit)


def letter_documents(listing: DataFrame, fetch: Fetch = fetched, *, limit: int | None = None) -> DataFrame:
    """Documents of dated letters in the order of their list. listing: (text), the collection's list as JSON: a list, or one
    under documents or results; and page if it comes in parts."""
    shape = "array<struct<title:string,permalink:string,project:string,authors:array<string>,`date-from`:string>>"
    part = F.coalesce(F.when(F.ltrim("text").startswith("["), F.col("text")), F.get_json_object("text", "$.documents"), F.get_json_object("text", "$.results"))
    page = F.col("page") if "page" in listing.columns else F.lit(0)
    meta = listing.select(page.alias("page"), F.posexplode(F.from_json(part, shape)).alias("nth", "r")).select(_place(F.col("page"), F.col("nth")).alias("pos"), "r.title", F.regexp_replace("r.permalink", "/+$", "").alias("permalink"), "r.project", "r.authors", F.col("r.`date-from`").alias("date_from"))

    def build(part: DataFrame) -> DataFrame:
        ids = catalogue.dated_letters(part).select(F.concat(F.lit(LETTERS_API), "api_id").alias("url"))
        get = lambda k: F.get_json_object("text", f"$.{k}")
        bodies = _there(fetch(ids)).select(F.replace("url", F.lit(LETTERS_API), F.lit("")).alias("api_id"), get("content").alias("content"), get("title").alias("own_title"), get("permalink").alias("own_permalink"), get("authors").alias("own_authors"), get("recipients").alias("recipients"))
        bodies = stored(bodies, "letters")
        a = catalogue.letters(part, bodies).join(bodies.drop("content"), "api_id")
        meta_json = F.to_json(F.struct(_many(F.col("recipients")).alias("recipients"), F.coalesce("project", F.lit("")).alias("project")))
        out = a.select("id", F.lit("founders_online").alias("source"), F.coalesce(F.nullif("own_title", F.lit("")), "title", F.lit("Untitled")).alias("title"), "text", F.coalesce("own_permalink", "permalink").alias("url"), F.col("date_from").alias("date"), F.when(F.col("own_authors").isNotNull(), _many(F.col("own_authors"))).otherwise(F.col("authors")).alias("authors"), F.lit("correspondence").alias("genre"), F.lit(LETTERS_RIGHTS).alias("rights"), meta_json.alias("metadata"), "pos")
        return as_documents(out, "pos")

    return ordered.first_documents(catalogue.dated_letters(meta).drop("api_id"), build, limit)


def _book_record(whole: Column) -> Column:
    """What is read of a catalogue record (a variant): from its item, or from itself if it has none."""
    v = F.coalesce(F.try_variant_get(whole, "$.item", "variant"), whole)
    first = lambda k: F.try_element_at(strings(F.try_variant_get(v, f"$.{k}", "variant")), F.lit(1))
    key, get = (lambda k, v=v: F.try_variant_get(v, f"$.{k}", "string") for v in (whole, v))
    fields = catalogue_fields(F.to_json(v))
    return F.struct(
        key("Object_id").alias("a"), key("id").alias("b"), key("url").alias("c"), get("id").alias("canonical"), get("title").alias("title"), F.coalesce(first("date"), first("dates")).alias("date"),
        fields.alias("f"), fields["subjects"].alias("subjects"), fields["call_numbers"].alias("call_numbers"),
    )


def book_documents(manifests: DataFrame, listing: DataFrame, fetch: Fetch = fetched, *, limit: int | None = None, uncertain: bool = False, max_bytes: int = local.MAX_BYTES) -> DataFrame:
    """Documents of digitised books in the order of their files. manifests, listing: (text), the list of files and that of
    catalogue records, as JSON. The record of a file that the list doesn't have is fetched."""
    rows = manifests.select(F.posexplode(catalogue.manifest_rows(F.col("text"))).alias("pos", "m"))
    cell = lambda *keys: F.coalesce(*[F.nullif(F.try_element_at("m", F.lit(k)), F.lit("")) for k in keys])
    ref = F.regexp_replace(F.regexp_replace(cell("item_id", "itemid"), "/+$", ""), "^http://www[.]loc[.]gov/", "https://www.loc.gov/")
    files = rows.select("pos", catalogue.file_url(F.col("m")).alias("url"), cell("size").try_cast("bigint").alias("size"), ref.alias("ref"), cell("id").alias("own")).where("url IS NOT NULL")
    files = files.withColumn("item", F.coalesce(F.substring_index("ref", "/", -1), "own", stable_id(F.col("url"))))
    files = files.where(F.col("url").endswith(".txt") & (F.coalesce("size", F.lit(0)) <= max_bytes))
    listed = listing.select(F.posexplode(F.from_json("text", "array<variant>")).alias("pos", "whole"))
    records = stored(listed.select("pos", _book_record(F.col("whole")).alias("x")).select("pos", "x.*"), "records")

    def build(part: DataFrame) -> DataFrame:
        joined = catalogue.with_records(part, records, ["a", "b", "c"], F.col("item"))
        joined = joined.withColumn("asked", F.when(F.col("record").isNull(), F.coalesce(F.concat("ref", F.lit("/?fo=json")), F.regexp_replace("url", r"\.txt\z", ".json"))))
        got = _there(fetch(joined.select(F.col("asked").alias("url")))).select(F.col("url").alias("asked"), _book_record(F.try_parse_json("text")).alias("fetched"))
        own = lambda side: F.struct(*[F.col(f"{side}.{n}").alias(n) for n in ("title", "subjects", "call_numbers", "date", "canonical", "f")])
        joined = joined.join(got, "asked", "left").withColumn("record", F.when(F.col("record").isNotNull(), own("record")).when(F.col("fetched").isNotNull(), own("fetched"))).drop("asked", "fetched")
        wanted = stored(catalogue.wanted_books(joined, max_bytes=max_bytes, uncertain=uncertain), "books")
        a = catalogue.with_texts(wanted, _there(fetch(wanted.select("url"))))
        more = [F.col(f"record.f.{k}").alias(k) for k in ("subjects", "call_numbers", "formats", "descriptions", "languages", "locations")]
        meta = F.to_json(F.struct(F.col("url").alias("ocr_url"), F.col("decision.status").alias("nonfiction_status"), F.col("decision.confidence").alias("nonfiction_confidence"), F.col("decision.reasons").alias("classification_reasons"), *more))
        url = F.coalesce("record.canonical", "ref", F.concat(F.lit("https://www.loc.gov/item/"), "item", F.lit("/")))
        out = a.select(
            F.concat(F.lit("locbook:"), "item").alias("id"), F.lit("loc_selected_digitized_books").alias("source"), F.coalesce("record.title", "item").alias("title"), "text", url.alias("url"), F.coalesce("record.date", F.lit("")).alias("date"),
            F.col("record.f.contributors").alias("authors"), F.coalesce(F.try_element_at("record.f.locations", F.lit(1)), F.lit("")).alias("place"), F.lit("nonfiction_book").alias("genre"), F.lit(BOOK_RIGHTS).alias("rights"), meta.alias("metadata"), "pos",
        )
        return as_documents(out, "pos")

    return ordered.first_documents(files, build, limit)


def newspaper_search(spark: SparkSession, fetch: Fetch = fetched, *, query: str = "", date_from: int = 1900, date_to: int = 1929, limit: int | None = None) -> Iterator[DataFrame]:
    """Blocks of replies (page, url, text) of the newspapers' search, for newspaper_documents()."""
    rows = 100 if limit is None else min(100, max(3 * limit, 20))
    asked = {"fo": "json", "c": rows, "dates": f"{date_from}/{date_to}", "at": "results,pagination", **({"q": query} if query else {})}
    return search_replies(spark, f"{NEWSPAPER_SEARCH}?{urllib.parse.urlencode(asked)}", fetch, total="$.pagination.of", rows=rows, key="sp")


def canonical_item(url: Column) -> Column:
    """An item's address with the scheme that the service gives today."""
    return F.replace(url, F.lit("http://www.loc.gov/"), F.lit("https://www.loc.gov/"))


def newspaper_sample(spark: SparkSession, per_period: int, fetch: Fetch = fetched) -> tuple[DataFrame, list[str]]:
    """(records, errors): the items (pos, item as JSON) of a search of each of audit.PERIODS, and which searches failed.

    Addresses are kept by audit.first_seen() in the order of the periods and their replies.
    """
    asked = [(k, f"{lo}-{hi}", f"{NEWSPAPER_SEARCH}?{urllib.parse.urlencode({'fo': 'json', 'c': per_period, 'dates': f'{lo}/{hi}', 'at': 'results'})}") for k, (lo, hi) in enumerate(audit.PERIODS)]
    searches = spark.createDataFrame(asked, "period int, label string, url string")
    replies = stored(searches.join(fetch(searches.select("url")), "url", "left"), "searches")
    shape = F.from_json(F.get_json_object("text", "$.results"), "array<map<string,string>>")
    good = shape.isNotNull()
    errors = [f"{r['label']}: {r['error'] or 'no results'}" for r in replies.where(~good).orderBy("period").collect()]  # a row a period
    found = replies.where(good).select("period", F.posexplode(shape).alias("nth", "m"))
    raw = F.coalesce(F.nullif(F.try_element_at("m", F.lit("id")), F.lit("")), F.try_element_at("m", F.lit("url")))
    urls = audit.first_seen(found.select(raw.alias("raw"), canonical_item(raw).alias("item_url"), _place(F.col("period"), F.col("nth")).alias("pos")), "raw", "item_url", "pos")
    urls = stored(urls.withColumn("url", F.concat("item_url", F.when(F.contains("item_url", F.lit("?")), "&").otherwise("?"), F.lit("fo=json&at=item,resources"))), "sample")
    items = _there(fetch(urls.select("url"))).join(urls, "url")
    return items.select("pos", F.coalesce(F.get_json_object("text", "$.item"), "text").alias("item")).orderBy("pos"), errors


def newspaper_documents(search: DataFrame | Iterator[DataFrame], fetch: Fetch = fetched, *, limit: int | None = None, date_from: int = 1900, date_to: int = 1929, max_bytes: int = local.MAX_BYTES) -> DataFrame:
    """Documents of newspaper pages in the order of search replies. search: (text), JSON with results, or blocks of such with page."""

    def candidates(replies: DataFrame) -> DataFrame:
        page = F.col("page") if "page" in replies.columns else F.lit(1)
        found = replies.select(page.alias("page"), F.posexplode(F.from_json(F.get_json_object("text", "$.results"), "array<map<string,string>>")).alias("nth", "m"))
        own = F.coalesce(F.nullif(F.try_element_at("m", F.lit("id")), F.lit("")), F.try_element_at("m", F.lit("url")))
        return found.select(own.alias("item_url"), F.try_element_at("m", F.lit("title")).alias("listed_title"), _place(F.col("page"), F.col("nth")).alias("pos")).where("item_url IS NOT NULL")

    def build(part: DataFrame) -> DataFrame:
        urls = part.groupBy("item_url").agg(F.min_by("listed_title", "pos").alias("listed_title"), F.min("pos").alias("pos"))
        asked = urls.withColumn("url", F.concat("item_url", F.when(F.contains("item_url", F.lit("?")), "&").otherwise("?"), F.lit("fo=json")))
        replies = _there(fetch(asked.select("url"))).join(asked, "url")
        items = stored(replies.select("item_url", "listed_title", "pos", F.coalesce(F.get_json_object("text", "$.item"), F.lit("{}")).alias("item"), F.coalesce(F.get_json_object("text", "$.resources"), F.get_json_object("text", "$.item.resources"), F.lit("[]")).alias("resources")), "items")
        wanted = newspapers.newspapers_of(items, date_from, date_to).select(F.explode(newspapers.candidate_urls(F.col("resources"))).alias("url"))
        return newspapers.item_documents(items, _there(fetch(wanted)).select("url", F.col("text").alias("body")), date_from=date_from, date_to=date_to, max_bytes=max_bytes)

    blocks = iter([search]) if isinstance(search, DataFrame) else search
    return ordered.in_order((candidates(b) for b in blocks), build, limit)


def batch_documents(spark: SparkSession, bases: DataFrame, fetch: Fetch = fetched, *, limit: int | None = None) -> DataFrame:
    """Documents of the pages of bulk newspaper batches in their order. bases: (base), the addresses of the batches' data, and
    pos if there are several."""
    listed = bases.select("base", (F.col("pos") if "pos" in bases.columns else F.lit(0)).cast("bigint").alias("at"), F.concat(F.regexp_replace("base", "/+$", ""), F.lit("/BATCH.xml")).alias("url"))
    lists = stored(_there(fetch(listed.select("url"))).join(listed, "url").select("base", "at", F.col("text").alias("xml")), "batches")
    at = lists.select(F.concat(F.regexp_replace("base", "/+$", ""), F.lit("/")).alias("base"), "at")
    issues = stored(newspapers.batch_issues(lists.select("base", "xml")).join(at, "base"), "issues")

    def build(part: DataFrame) -> DataFrame:
        ocr = _there(fetch(part.select(F.col("ocr_url").alias("url")))).select("url", F.col("text").alias("xml"))
        return newspapers.page_documents(part, ocr)

    def pages() -> Iterator[DataFrame]:
        """The pages of a range of issues; those of later issues aren't looked up before they are needed."""
        numbered = issues.withColumn("pos", F.col("at") * (1 << 32) + F.col("nth"))
        for part in ordered.ranges(numbered, (ordered.FIRST << min(k, 16) for k in range(1 << 20))) if limit is not None else [numbered]:
            own = stored(newspapers.issue_pages(part.drop("at", "pos"), _there(fetch(part.select("url"))).select("url", F.col("text").alias("xml"))), "issue-pages")
            yield own.join(at, "base").withColumn("pos", (F.col("at") * (1 << 20) + F.col("nth")) * (1 << 20) + F.col("page"))

    return ordered.in_order(pages(), build, limit)


#: Builders by protocol, and collections by each of their names.
PROTOCOLS = {"oai-pmh": from_catalogue, "internet-archive": from_archive}
# Names of the collections.
COLLECTIONS = {"founders-online": letter_documents, "founders": letter_documents, "loc-chronicling-america": newspaper_documents, "chronicling": newspaper_documents, "loc-selected-digitized-books": book_documents, "loc-books": book_documents, "evans-tcp": tei.documents, "evans": tei.documents}


def collect(name: str, *tables: DataFrame, **options) -> DataFrame:
    """Documents of a collection from its lists; an unknown name raises before anything is read."""
    if name not in COLLECTIONS:
        raise ValueError(f"unknown source {name!r}; choose one of {', '.join(sorted(COLLECTIONS))}")
    return COLLECTIONS[name](*tables, **options)


def collect_named(
    spark: SparkSession, name: str, *, replies: str | None = None, limit: int | None = None, query: str = "", date_from: int = 1900, date_to: int = 1929, listing: str | None = None,
    manifest: str | None = None, root: str | None = None, bases: list[str] | tuple[str, ...] = (), uncertain: bool = False, max_bytes: int = local.MAX_BYTES, fetch: Fetch = fetched,
) -> DataFrame:
    """Documents of a collection by its name, or of `batches`, with the lists that the service has unless files are given.

    replies: the path of a Bronze table that fetches go through, those of JSON apart from those of texts.
    """
    if name != "batches" and name not in COLLECTIONS:
        raise ValueError(f"unknown source {name!r}; choose one of {', '.join(sorted([*COLLECTIONS, 'batches']))}")
    if replies is not None:
        fetch = Bronze(spark, replies).through(fetch)

    def one(url: str, file: str | None) -> DataFrame:
        """(text) of a file, else of the service's address; raises if neither can be had."""
        if file is not None:
            return spark.read.text(file, wholetext=True).select(F.col("value").alias("text"))
        got = stored(fetch(_one_url(spark, url)), "list")
        bad = got.where("text IS NULL").select("error").first()
        if bad is not None:
            raise RuntimeError(f"can't read {url}: {bad['error']}; give a file of it")
        return got.select("text")

    build = COLLECTIONS.get(name)
    if name == "batches":
        if not bases:
            raise ValueError("batches need the address of one at least")
        return batch_documents(spark, spark.createDataFrame(list(enumerate(bases)), "pos bigint, base string"), fetch, limit=limit)
    if build is letter_documents:
        return letter_documents(one(LETTERS_LIST, listing), fetch, limit=limit)
    if build is newspaper_documents:
        search = newspaper_search(spark, fetch, query=query, date_from=date_from, date_to=date_to, limit=limit)
        return newspaper_documents(search, fetch, limit=limit, date_from=date_from, date_to=date_to, max_bytes=max_bytes)
    if build is book_documents:
        return book_documents(one(BOOK_FILES, manifest), one(BOOK_RECORDS, listing), fetch, limit=limit, uncertain=uncertain, max_bytes=max_bytes)
    if root is None:
        raise ValueError(f"{name} needs the folder of its files")
    return tei.documents(tei.read(spark, root), review_candidates=uncertain, limit=limit)


def collect_country(spark: SparkSession, country: dict, source: dict, *, input_root: str | None = None, rights_override: str = "", limit: int | None = None, fetch: Fetch = fetched, **options) -> DataFrame:
    """Documents of a country's source, in its order: from a local export if there is one, else by its protocol.

    country and source as registry.country() and usable_source() give them. limit: the first documents; the work ends
    when they are found.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    if input_root is not None:
        return local.local_export(spark, input_root, source=source["id"], country=country["id"], language=country["language"], cutoff=country["publication_cutoff"], caution=country.get("cutoff_note") or "", protocol=source["protocol"], rights_override=rights_override, limit=limit, **options)
    if source["protocol"] in PROTOCOLS:
        return PROTOCOLS[source["protocol"]](spark, country, source, fetch, limit=limit, **options)
    raise ValueError(f"no collector for protocol {source['protocol']!r}: give the root of an audited export")


def add_new(docs: DataFrame, path: str) -> int:
    """Appends documents to JSON Lines and returns their number; what is there stays as it is."""
    rows = stored(docs.withColumn("text", clean_text(F.col("text"))), "harvest")
    local.write_jsonl(rows, path, append=True)
    return rows.count()


def recorded(replies: DataFrame, key: Callable[[Column], Column] = lambda url: url) -> Fetch:
    """A fetch that answers from a table (key, text) of any size; other addresses fail. key: an address's key in it.

    Texts of keys that aren't asked for don't join: those outside the range of the asked keys aren't shuffled either, and
    none is if the addresses are few enough for a broadcast.
    """

    def run(urls: DataFrame) -> DataFrame:
        own = stored(urls.select("url").where("url IS NOT NULL").distinct().withColumn("key", key(F.col("url"))), "asked")
        ends = own.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
        known = replies.where(F.col("key").between(ends["low"], ends["high"])).join(own.select("key"), "key", "left_semi")
        a = own.join(known, "key", "left").select("url", "text")
        return a.withColumn("error", F.when(F.col("text").isNull(), "not recorded"))

    return run


def replayed(replies: dict[str, str]) -> Fetch:
    """A fetch that answers from a dict of address to text; other addresses fail. For tests and recorded harvests."""
    table = json.dumps(replies)

    def run(urls: DataFrame) -> DataFrame:
        known = F.from_json(F.lit(table), "map<string,string>")
        a = urls.select("url").where("url IS NOT NULL").distinct().withColumn("text", F.try_element_at(known, F.col("url")))
        return a.withColumn("error", F.when(F.col("text").isNull(), "not recorded"))

    return run
