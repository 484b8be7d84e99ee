"""Paged catalogues over HTTP as a Spark data source, read as a table or as a stream, with a cache, retries, pacing, and replay from files."""

from __future__ import annotations

import hashlib
import json
import os
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from ..functions.classify import rights_eligible
from ..functions.text import clean_text, earliest_year, first_value, stable_id, text_url
from ..schemas import as_documents
from . import markup
from .leases import Address, Lease, Leases

MAX_PAGES = 100
RETRIED = (500, 502, 503, 504)


class RateLimited(RuntimeError):
    """The server asked to slow down (429); never retried at once."""


class Pace:
    """Least time between requests of one process: 60 / (per_minute * safety) seconds."""

    def __init__(self, per_minute: float, safety: float = 0.9):
        self.gap, self.last, self.lock = 60 / (per_minute * safety), 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            left = self.last + self.gap - time.monotonic()
            if left > 0:
                time.sleep(left)
            self.last = time.monotonic()


def fetch(url: str, *, cache: str | None = None, timeout: float = 60, attempts: int = 4, pace: Pace | None = None, opener=urllib.request.urlopen) -> str:
    """The text of an address; from the cache (file sha256(url)) if it has one that isn't blank. A blank reply raises."""
    path = f"{cache}/{hashlib.sha256(url.encode()).hexdigest()}" if cache else ""
    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if text.strip():
            return text
    for n in range(attempts):
        if pace:
            pace.wait()
        try:
            with opener(url, timeout=timeout) as reply:
                text = reply.read().decode(reply.headers.get_content_charset() or "utf-8", "replace")
            break
        except urllib.error.HTTPError as e:
            if e.code == 429:
                raise RateLimited(url) from e
            if e.code not in RETRIED or n == attempts - 1:
                raise
        except urllib.error.URLError:
            if n == attempts - 1:
                raise
        time.sleep(2**n)
    if not text.strip():
        raise RuntimeError(f"empty reply: {url}")
    if path:
        os.makedirs(cache, exist_ok=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with open(own, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(own, path)
    return text


class PagedCatalogue(DataSource):
    """The pages of a catalogue as (set, page, xml); see catalogue_records(). Read as a table or as a stream.

    spark.read.format("paged_catalogue"), options: path (endpoint), set, prefix (oai_dc), cache, per_minute, replay (a
    folder of page-<n>.xml in place of the network), pages (100 at most for each set, unless it says otherwise), rest
    (`fail`, the default, or `ignore`, for a set that has more), token and page (where to go on, and the number of that
    page), lease (see leased()). A chain of pages is one partition, as each page names the next; several sets are read in
    parallel by giving them comma-separated, and share per_minute.

    spark.readStream.format("paged_catalogue"): the same options but rest and pages. The offset is the token of the next
    page of each set, so that a query which starts again from its checkpoint goes on where it ended; `batch_pages` (1)
    pages of a set make a batch. A batch that was planned but not done is read again, from the cache if there is one. A
    set that has ended stays ended.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_catalogue"

    def schema(self) -> str:
        return "set string, page int, xml string"

    def reader(self, schema) -> DataSourceReader:
        return _Pages(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _PageStream(dict(self.options))


def _sets(options: dict[str, str]) -> list[str]:
    return [s.strip() for s in options.get("set", "").split(",")]


def _pace(o: dict[str, str], share: int):
    """The lease of the application's limit, or else this partition's part of it, as partitions know nothing of each other."""
    if not o.get("per_minute"):
        return None
    if o.get("lease"):
        host, port, token = json.loads(o["lease"])
        return Lease(Address(host, port, token), urllib.parse.urlsplit(o.get("path", "")).netloc or o.get("path", ""), float(o["per_minute"]))
    return Pace(float(o["per_minute"]) / share)


def _page(o: dict[str, str], name: str, page: int, token: str, pace) -> str | None:
    """A page of a set; None if a replay has no such page."""
    if o.get("replay"):
        file = os.path.join(o["replay"], name, f"page-{page}.xml")
        if not os.path.exists(file):
            return None
        with open(file, encoding="utf-8") as f:
            return f.read()
    join = "&" if "?" in o.get("path", "") else "?"
    query = {"verb": "ListRecords", "resumptionToken": token} if token else {"verb": "ListRecords", "metadataPrefix": o.get("prefix", "oai_dc"), **({"set": name} if name else {})}
    return fetch(f"{o['path']}{join}{urllib.parse.urlencode(query)}", cache=o.get("cache") or None, pace=pace)


class _Pages(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in _sets(self.options)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o, name, token = self.options, partition.value, self.options.get("token", "")
        pace, first = _pace(o, len(self.partitions())), int(o.get("page", 0))
        for page in range(first, first + int(o.get("pages", MAX_PAGES))):
            xml = _page(o, name, page, token, pace)
            if xml is None:
                return
            yield name, page, xml
            token = markup.page_token(xml)
            if not token:
                return
        if o.get("rest", "fail") != "ignore":
            raise RuntimeError(f"set {name!r} has more pages than the option allows")


class _PageStream(SimpleDataSourceStreamReader):
    """Offsets are {set: [number of the next page, its token, whether the set has ended]}."""

    def __init__(self, options: dict[str, str]):
        self.options, self.pace = options, _pace(options, 1)

    def initialOffset(self) -> dict:
        return {s: [0, "", False] for s in _sets(self.options)}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = [], dict(start)
        for name, (page, token, ended) in start.items():
            for _ in range(0 if ended else int(self.options.get("batch_pages", 1))):
                xml = _page(self.options, name, page, token, self.pace)
                token = "" if xml is None else markup.page_token(xml)
                if xml is not None:
                    rows.append((name, page, xml))
                    page += 1
                ended = not token
                if ended:
                    break
            end[name] = [page, token, ended]
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for name, (page, token, _) in start.items():
            for nth in range(page, end[name][0]):
                xml = _page(self.options, name, nth, token, self.pace)
                if xml is None:
                    raise RuntimeError(f"page {nth} of set {name!r} is gone")
                yield name, nth, xml
                token = markup.page_token(xml)

    def commit(self, end: dict) -> None:
        pass


def leased(spark: SparkSession, per_minute: float) -> dict[str, str]:
    """Options by which a catalogue keeps to one limit with everything else of the application that reads its host."""
    return {"per_minute": str(per_minute), "lease": json.dumps(list(Leases.of(spark).address))}


def catalogue_records(pages: DataFrame) -> DataFrame:
    """(other columns, identifier, fields, nth) of the records of catalogue pages that aren't deleted."""
    return markup.parse_oai(pages).where("nth >= 0").drop("token").withColumnRenamed("oai_identifier", "identifier")


def eligible_records(records: DataFrame, cutoff: int) -> DataFrame:
    """Records of a known year up to the cutoff, with the address of a text and eligible rights: what is worth a fetch."""
    get = lambda k: F.coalesce(F.try_element_at("fields", F.lit(k)), F.array().cast("array<string>"))
    a = records.select("*", earliest_year(get("date")).alias("year"), text_url(get("identifier"), get("relation")).alias("text_url"), F.array_join(get("rights"), " | ").alias("rights"), F.array_join(get("title"), " | ").alias("title"))
    return a.where((F.col("year") <= cutoff) & (F.col("text_url") != "") & rights_eligible(F.col("rights")))


def record_documents(records: DataFrame, texts: DataFrame, *, source: str, endpoint: str, country: str, language: str, cutoff: int, caution: str = "", least: int = 100, max_bytes: int = 20_000_000) -> DataFrame:
    """Documents of eligible records whose text has `least` characters and max_bytes at most, with pos if the records have it.

    records: (identifier, fields); texts: (url, text), of which an address that isn't there has none. The address of a
    document is its first identifier that is one, else that of the text; its id is a hash of the catalogue's identifier.
    """
    a = eligible_records(records, cutoff).join(texts.select(F.col("url").alias("text_url"), clean_text(F.col("text")).alias("text")), "text_url")
    a = a.where((F.length("text") >= least) & (F.octet_length("text") <= max_bytes))
    get = lambda k: F.coalesce(F.try_element_at("fields", F.lit(k)), F.array().cast("array<string>"))
    joined = lambda k: F.array_join(get(k), " | ")
    url = F.coalesce(F.try_element_at(F.filter(get("identifier"), lambda v: v.startswith("http://") | v.startswith("https://")), F.lit(1)), F.col("text_url"))
    own = F.coalesce(F.nullif("identifier", F.lit("")), url)
    meta = F.to_json(F.struct(F.lit("oai-pmh").alias("protocol"), F.col("identifier").alias("oai_identifier"), F.lit(endpoint).alias("oai_endpoint"), "text_url", F.lit(cutoff).alias("publication_year_filter"), F.lit(caution).alias("rights_caution"), F.col("fields").alias("dc")))
    keep = [c for c in ("pos",) if c in a.columns]
    out = a.select(
        F.concat(F.lit(f"{source}:"), stable_id(own)).alias("id"), F.lit(source).alias("source"), F.coalesce(F.nullif(first_value(get("title")), F.lit("")), own).alias("title"), "text", url.alias("url"), joined("date").alias("date"),
        F.concat(get("creator"), get("contributor")).alias("authors"), joined("coverage").alias("place"), joined("type").alias("genre"), "rights", F.lit(country).alias("country"), F.lit(language).alias("language"), meta.alias("metadata"), *keep,
    )
    return as_documents(out, *keep)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedCatalogue)
