"""Newspaper pages from bulk batches and from catalogue items, over tables of fetched replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import periodical_decision
from ..functions.text import clean_text, first_year, stable_id
from ..schemas import as_documents
from . import markup
from .catalogue import page_numbers

# The name of the source, its rights notice and its genre.
SOURCE, LEAST = "loc_chronicling_america", 100
BATCH_REASON = "official NDNP Chronicling America batch page"
# Metadata of an item's document, the keys of the item that may hold each, and what stands for none.
ITEM_VALUES = (
    ("partof", ("partof",), "[]"), ("newspaper_title", ("newspaper_title",), "[]"), ("date_issued", ("date_issued",), '""'), ("dates_of_publication", ("dates_of_publication",), '""'),
    ("place_of_publication", ("place_of_publication",), '""'), ("location_city", ("location_city",), "[]"), ("location_county", ("location_county",), "[]"), ("location_state", ("location_state",), "[]"),
    ("location_country", ("location_country",), "[]"), ("subjects", ("subject", "subjects"), "[]"), ("subject_headings", ("subject_headings",), "[]"), ("genre", ("genre",), "[]"),
    ("publication_frequency", ("publication_frequency",), "[]"), ("edition_number", ("number_edition",), "[]"), ("call_number", ("call_number",), "[]"), ("medium", ("medium",), '""'), ("language", ("language",), "[]"),
)
NOTICE = "Library of Congress Chronicling America rights statement applies"


def relative_path(path: Column) -> Column:
    """An issue's path inside its batch: after /data/, or without the two leading parts of ../batch_x/..."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    parts = F.split(p, "/")
    return F.when(F.contains(p, F.lit("/data/")), F.regexp_replace(p, r"\A.*?/data/", "")).when(p.startswith("../"), F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), "/")).otherwise(p)


def batch_issues(batches: DataFrame) -> DataFrame:
    """(base, url, lccn, date, edition, nth) of the issues of each batch, nth rising as the batch lists them. batches: (base, xml)."""
    a = markup.parse_batch(batches)
    base = F.concat(F.regexp_replace("base", "/+$", ""), F.lit("/"))
    return a.select(base.alias("base"), F.concat(base, relative_path(F.col("path"))).alias("url"), "lccn", "date", "edition", "nth")


def issue_pages(issues: DataFrame, replies: DataFrame) -> DataFrame:
    """One row for each page with an address: issue columns, label, page (from 1), ocr_url. replies: (url, xml)."""
    a = markup.parse_issue(issues.join(replies.select("url", "xml"), "url")).withColumn("issue", F.col("url"))
    n = page_numbers(a)
    folder = F.concat(F.regexp_extract("url", r"\A(.*)/[^/]*\z", 1), F.lit("/"))
    label = F.coalesce("label", F.concat(F.lit("Newspaper issue "), "date"))
    return n.select("base", "url", "lccn", "date", "edition", *[c for c in ("nth",) if c in n.columns], label.alias("label"), "page", F.concat(folder, F.regexp_replace("href", r"\A\./", "")).alias("ocr_url"))


def page_documents(pages: DataFrame, replies: DataFrame) -> DataFrame:
    """Documents of the pages whose OCR has 100 characters. replies: (url, xml)."""
    ocr = markup.parse_alto(replies.select(F.col("url").alias("ocr_url"), "xml"))
    a = pages.join(ocr, "ocr_url").where(F.length("text") >= LEAST)
    url = F.concat(F.lit("https://www.loc.gov/resource/"), "lccn", F.lit("/"), "date", F.lit("/ed-"), "edition", F.lit("/?sp="), "page")
    meta = F.to_json(F.struct("ocr_url", "lccn", F.col("edition").alias("edition_number"), F.col("page").alias("page_number"), F.col("base").alias("batch_data_url"), F.lit("newspaper").alias("nonfiction_status"), F.lit("high").alias("nonfiction_confidence"), F.array(F.lit(BATCH_REASON)).alias("classification_reasons")))
    keep = [c for c in ("pos",) if c in a.columns]
    out = a.select(F.concat(F.lit("chronicling:"), stable_id(url)).alias("id"), F.lit(SOURCE).alias("source"), F.concat("label", F.lit(", page "), "page").alias("title"), "text", url.alias("url"), "date", F.lit("newspaper_page").alias("genre"), F.lit(NOTICE).alias("rights"), meta.alias("metadata"), *keep)
    return as_documents(out, *keep)


def candidate_urls(resources: Column) -> Column:
    """Distinct text addresses of an item's resources (JSON list), each resource's own keys before its files."""
    shape = "array<struct<fulltext_file:string,url:string,download:string,text_file:string,files:array<struct<url:string>>>>"
    own = lambda r: F.array(r["fulltext_file"], *[F.when(r[k].endswith(".txt"), r[k]) for k in ("url", "download", "text_file")])
    files = lambda r: F.filter(F.transform(F.coalesce(r["files"], F.array()), lambda f: f["url"]), lambda u: u.endswith(".txt"))
    every = F.flatten(F.transform(F.coalesce(F.from_json(resources, shape), F.array()), lambda r: F.concat(own(r), files(r))))
    return F.array_distinct(F.filter(every, lambda u: u.isNotNull()))


def _list(item: Column, *keys: str) -> Column:
    """Values of keys that hold a text or a list of texts."""
    one = lambda k: F.coalesce(F.from_json(F.when(F.get_json_object(item, f"$.{k}").startswith("["), F.get_json_object(item, f"$.{k}")), "array<string>"), F.filter(F.array(F.get_json_object(item, f"$.{k}")), lambda v: v.isNotNull()))
    return F.concat(*[one(k) for k in keys])


def newspapers_of(items: DataFrame, date_from: int = 1900, date_to: int = 1929) -> DataFrame:
    """Items that are newspapers of a year in range or unknown, with decision and date: those whose texts are worth a fetch."""
    it = F.col("item")
    decided = periodical_decision(F.get_json_object(it, "$.title"), _list(it, "subject", "subjects"), _list(it, "genre"), _list(it, "format", "original_format"))
    date = F.coalesce(F.try_element_at(_list(it, "date"), F.lit(1)), F.try_element_at(_list(it, "dates"), F.lit(1)), F.lit(""))
    return items.withColumns({"decision": decided, "date": date}).where((F.col("decision.status") == "newspaper") & F.coalesce(first_year(F.col("date")).between(date_from, date_to), F.lit(True)))


def item_documents(items: DataFrame, texts: DataFrame, *, date_from: int = 1900, date_to: int = 1929, max_bytes: int = 20_000_000) -> DataFrame:
    """Documents of catalogue items that are newspapers, of a year in range or unknown, with a text of 100 characters.

    items: (item_url, item, resources) as JSON, and listed_title, the title for items without one; texts: (url, body), a body may be JSON with full_text in its first
    value. The first candidate address with a long enough text wins; metadata filters come before the texts.
    """
    it = F.col("item")
    a = newspapers_of(items, date_from, date_to)
    each = a.select("item_url", F.posexplode(candidate_urls(F.col("resources"))).alias("nth", "text_url"))
    wrapped = F.get_json_object(F.regexp_extract("body", r'(?s)\A\s*\{\s*"[^"]*"\s*:\s*(\{.*\})\s*\}\s*\z', 1), "$.full_text")
    body = clean_text(F.when(F.ltrim("body").startswith("{"), F.coalesce(wrapped, F.lit(""))).otherwise(F.col("body")))
    got = each.join(texts.where(F.octet_length("body") <= max_bytes).select(F.col("url").alias("text_url"), body.alias("text")), "text_url").where(F.length("text") >= LEAST)
    best = got.groupBy("item_url").agg(F.min_by(F.struct("text_url", "text"), "nth").alias("x"))
    a = a.join(best, "item_url")
    url = F.coalesce(F.get_json_object(it, "$.id"), F.col("item_url"))
    whole = F.try_parse_json(it)
    kept = []
    for name, keys, default in ITEM_VALUES:  # as the catalogue has them, whatever their type
        kept.append(F.coalesce(*[F.try_variant_get(whole, f"$.{k}", "variant") for k in keys], F.parse_json(F.lit(default))).alias(name))
    manifest = F.coalesce(F.get_json_object("resources", "$[0].iiif_manifest_url"), F.lit("")).alias("iiif_manifest_url")
    meta = F.to_json(F.struct(F.col("x.text_url").alias("ocr_url"), F.col("decision.status").alias("nonfiction_status"), F.col("decision.confidence").alias("nonfiction_confidence"), F.col("decision.reasons").alias("classification_reasons"), *kept, manifest))
    keep = [c for c in ("pos",) if c in a.columns]
    listed = [F.col("listed_title")] if "listed_title" in a.columns else []
    first = lambda k, d: F.coalesce(F.try_element_at(_list(it, k), F.lit(1)), F.lit(d))
    out = a.select(
        F.concat(F.lit("chronicling:"), stable_id(url)).alias("id"), F.lit(SOURCE).alias("source"), F.coalesce(F.get_json_object(it, "$.title"), *listed, F.lit("Newspaper page")).alias("title"), F.col("x.text").alias("text"),
        url.alias("url"), "date", first("location", "").alias("place"), F.lit("newspaper_page").alias("genre"), first("rights_advisory", "Library of Congress rights statement applies").alias("rights"), meta.alias("metadata"), *keep,
    )
    return as_documents(out, *keep)
