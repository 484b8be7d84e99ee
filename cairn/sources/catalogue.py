"""Catalogues: manifests of files joined to records, letters, and preference among candidate files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import book_decision
from ..functions.text import clean_text, first_year, last_segment, with_scheme

FILE_KEYS = ("url", "download", "file_url", "object_key")
LIST_KEYS = ("files", "resources", "items", "data")


def manifest_rows(payload: Column) -> Column:
    """array<map<string,string>> of a manifest (JSON text): a list as it is, {cols, rows} zipped, or the first list under a usual key."""
    as_maps = "array<map<string,string>>"
    zipped = F.transform(F.from_json(F.get_json_object(payload, "$.rows"), "array<array<string>>"), lambda r: F.map_from_arrays(F.from_json(F.get_json_object(payload, "$.cols"), "array<string>"), r))
    nested = [F.when(F.get_json_object(payload, f"$.{k}").startswith("["), F.from_json(F.get_json_object(payload, f"$.{k}"), as_maps)) for k in LIST_KEYS]
    whole = F.when(F.ltrim(payload).startswith("["), F.from_json(payload, as_maps))
    return F.coalesce(whole, zipped, *nested, F.from_json(F.lit("[]"), as_maps))


def file_url(row: Column) -> Column:
    """The first address of a manifest row (map), with its scheme; null if it has none."""
    first = F.coalesce(*[F.nullif(F.try_element_at(row, F.lit(k)), F.lit("")) for k in FILE_KEYS])
    return F.when(first.rlike("^(https?:)?//"), with_scheme(first)).otherwise(F.concat(F.lit("https://"), F.regexp_replace(first, "^/+", "")))


def with_records(files: DataFrame, records: DataFrame, keys: list[str], item: Column | None = None) -> DataFrame:
    """files (url) left-joined to records on the last segment of any of the records' keys; the last record of a key wins.

    item: a file's key; the last segment of its address without .txt unless it is given.

    records needs pos. Both sides are dealt by the segment; one row of a key remains before the join.
    """
    each = records.select("*", F.explode(F.array_distinct(F.filter(F.array(*[last_segment(F.col(k)) for k in keys]), lambda s: s.isNotNull() & (s != "")))).alias("__item"))
    names = [c for c in records.columns]
    last = each.groupBy("__item").agg(F.max_by(F.struct(*names), "pos").alias("record"))
    if item is None:
        item = F.regexp_replace(last_segment(F.col("url")), r"\.txt\z", "")
    return files.withColumn("__item", item).join(last, "__item", "left").drop("__item")


def wanted_books(files: DataFrame, *, max_bytes: int = 20_000_000, uncertain: bool = False, last_year: int = 1929) -> DataFrame:
    """Rows of with_records() that are texts in size, not fiction, of a year up to last_year or unknown, with their decision.

    These filters need no text, so nothing else is worth a fetch. files: (url, size, record<title, subjects, call_numbers,
    date>). A missing size passes.
    """
    a = files.where(F.col("url").endswith(".txt") & (F.coalesce(F.col("size"), F.lit(0)) <= max_bytes))
    a = a.withColumn("decision", book_decision(F.col("record.title"), F.col("record.subjects"), F.col("record.call_numbers")))
    kept = ["nonfiction", "uncertain"] if uncertain else ["nonfiction"]
    return a.where(F.col("decision.status").isin(*kept) & F.coalesce(first_year(F.col("record.date")) <= last_year, F.lit(True)))


def with_texts(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows with the cleaned text of their address, if it has 100 characters. texts: (url, text)."""
    return wanted.join(texts.select("url", clean_text(F.col("text")).alias("text")), "url").where(F.length("text") >= 100)


def books(files: DataFrame, texts: DataFrame, *, max_bytes: int = 20_000_000, uncertain: bool = False, last_year: int = 1929) -> DataFrame:
    """wanted_books() with texts of 100 characters."""
    return with_texts(wanted_books(files, max_bytes=max_bytes, uncertain=uncertain, last_year=last_year), texts)


def dated_letters(records: DataFrame, *, last_year: int = 1929) -> DataFrame:
    """Dated records of a document collection with their api_id; later years are left out, unknown ones stay.

    records: (title, permalink, project, authors, date_from) and more.
    """
    dated = records.where((F.coalesce("date_from", F.lit("")) != "") & F.col("permalink").contains("/documents/") & F.coalesce(first_year(F.col("date_from")) <= last_year, F.lit(True)))
    return dated.withColumn("api_id", F.regexp_replace(F.substring_index("permalink", "/documents/", -1), "^/+|/+$", ""))


def letters(records: DataFrame, bodies: DataFrame, *, last_year: int = 1929) -> DataFrame:
    """dated_letters() with their bodies of 80 characters: id founders:<api id>. bodies: (api_id, content)."""
    keyed = dated_letters(records, last_year=last_year)
    return keyed.join(bodies.select("api_id", clean_text(F.col("content")).alias("text")), "api_id").where(F.length("text") >= 80).withColumn("id", F.concat(F.lit("founders:"), F.col("api_id")))


def preferred_file(files: Column, max_bytes: int) -> Column:
    """The file to read of an item: array<struct<name, format, size>>; DjVuTXT first, then order, within the size bound.

    A missing size passes.
    """
    text = F.filter(files, lambda f: F.lower(F.coalesce(f["format"], F.lit(""))).isin("djvutxt", "full text") | F.lower(f["name"]).endswith(".txt"))
    ranked = F.array_sort(F.transform(text, lambda f, i: F.struct(F.when(F.lower(F.coalesce(f["format"], F.lit(""))) == "djvutxt", 0).otherwise(1).alias("r"), i.alias("i"), f.alias("f"))))
    small = F.filter(ranked, lambda x: F.coalesce(x["f"]["size"], F.lit(0)) <= max_bytes)
    return F.try_element_at(small, F.lit(1))["f"]


def page_numbers(pages: DataFrame) -> DataFrame:
    """pages (issue, pos, href) with the number of each page that has an address, counted in its issue."""
    return pages.where(F.coalesce("href", F.lit("")) != "").withColumn("page", F.row_number().over(Window.partitionBy("issue").orderBy("pos")))


def first_until(rows: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """The first n survivors in source order, one at least."""
    return rows.orderBy(pos).limit(max(1, n))
