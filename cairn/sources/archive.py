"""Items of a digital archive: search rows, item records and texts become documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import rights_eligible
from ..functions.text import clean_text, earliest_year
from ..schemas import as_documents
from .catalogue import preferred_file


# The genre of the documents, and addresses of the service.
GENRE, ITEM_PAGE, DOWNLOAD = "historical_text_ocr", "https://archive.org/details/", "https://archive.org/download/"


def dated(found: DataFrame, cutoff: int) -> DataFrame:
    """Search rows with an identifier and a known year up to the cutoff, as __year: those whose item is worth a fetch."""
    year = earliest_year(F.array(F.coalesce("year", F.lit("")), F.coalesce("date", F.lit(""))))
    return found.where((F.coalesce("identifier", F.lit("")) != "") & (year <= cutoff)).withColumn("__year", year)


def eligible(found: DataFrame, items: DataFrame, cutoff: int, max_bytes: int = 20_000_000) -> DataFrame:
    """dated() rows with their item's values, eligible rights and the address of the preferred file: what is worth a text."""
    own = items.select("identifier", *[F.nullif(F.col(k), F.lit("")).alias(f"i_{k}") for k in ("licenseurl", "title", "date")], F.col("creators").alias("i_creators"), *([F.col("subjects").alias("i_subjects")] if "subjects" in items.columns else []), "files")
    a = dated(found, cutoff).join(own, "identifier").withColumn("rights", F.coalesce("i_licenseurl", "licenseurl", F.lit(""))).where(rights_eligible(F.col("rights")))
    a = a.withColumn("file", preferred_file(F.col("files"), max_bytes)).where(F.col("file").isNotNull())
    return a.withColumn("text_url", F.concat(F.lit(DOWNLOAD), "identifier", F.lit("/"), "file.name"))


def documents(found: DataFrame, items: DataFrame, texts: DataFrame, *, source: str, country: str, language: str, cutoff: int, caution: str = "", max_bytes: int = 20_000_000) -> DataFrame:
    """Items of a known year up to the cutoff with eligible rights and a text of 100 characters, with pos if the rows have it.

    found: (identifier, year, date, title, licenseurl), and creators and subjects if there are any; items: (identifier,
    licenseurl, title, date, creators, files), and subjects; texts: (url, text). An item's value comes before the search
    row's unless it is empty. Files: see preferred_file().
    """
    a = eligible(found, items, cutoff, max_bytes)
    a = a.join(texts.select(F.col("url").alias("text_url"), clean_text(F.col("text")).alias("text")), "text_url").where((F.length("text") >= 100) & (F.octet_length("text") <= max_bytes))
    none = F.array().cast("array<string>")

    def values(name: str) -> Column:
        """The item's values, else the search row's."""
        own = [F.when(F.size(c) > 0, F.col(c)) for c in (f"i_{name}", name) if c in a.columns]
        return F.coalesce(*own, none)

    meta = F.to_json(F.struct(F.lit("internet-archive").alias("protocol"), F.col("identifier").alias("archive_identifier"), "text_url", F.lit(cutoff).alias("publication_year_filter"), F.lit(caution).alias("rights_caution"), values("subjects").alias("subjects")))
    keep = [c for c in ("pos",) if c in a.columns]
    out = a.select(
        F.concat(F.lit(f"{source}:"), "identifier").alias("id"), F.lit(source).alias("source"), F.coalesce("i_title", F.nullif("title", F.lit("")), "identifier").alias("title"), "text",
        F.concat(F.lit(ITEM_PAGE), "identifier").alias("url"), F.coalesce("i_date", F.nullif("date", F.lit("")), F.col("__year").cast("string")).alias("date"), values("creators").alias("authors"),
        F.lit(GENRE).alias("genre"), "rights", F.lit(country).alias("country"), F.lit(language).alias("language"), meta.alias("metadata"), *keep,
    )
    return as_documents(out, *keep)
