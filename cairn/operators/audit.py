"""Reports on metadata: coverage and frequent values of fields, periods, first occurrences, review lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import strings_in

#: Values listed for a field.
TOP_VALUES = 25
# Periods of the sample.
PERIODS = ((1800, 1849), (1850, 1879), (1880, 1909), (1910, 1929))


def field_coverage(fields: DataFrame) -> DataFrame:
    """(field, n_present, percent): how many records have a value. fields: (record, field, value as JSON text or null).

    null, the empty text and the empty list count as absent; 0, false and {} as present. The share is of all records,
    to one digit, half to even.
    """
    total = fields.agg(F.count_distinct("record").alias("n")).collect()[0]["n"]
    present = F.col("value").isNotNull() & ~F.col("value").isin("null", '""', "[]")
    counts = fields.groupBy("field").agg(F.count_if(present).alias("n_present"))
    return counts.select("field", "n_present", F.bround(F.lit(100.0) * F.col("n_present") / F.lit(max(1, total)), 1).alias("percent"))


def frequent_values(values: DataFrame, top: int = TOP_VALUES) -> DataFrame:
    """(field, value, n, nth): the most frequent values of each field, ties by first place. values: (field, value, pos)."""
    counts = values.groupBy("field", "value").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    best = Window.partitionBy("field").orderBy(F.desc("n"), "first")
    return counts.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= top).select("field", "value", "n", "nth")


def record_fields(records: DataFrame, column: str = "item") -> DataFrame:
    """(record, field, value as JSON text): the fields of records that are JSON objects. records: (pos, item)."""
    each = records.select(F.col("pos").alias("record"), F.explode(F.from_json(column, "map<string,variant>")).alias("field", "v"))
    return each.select("record", "field", F.to_json("v").alias("value"))


#: Fields of records whose frequent values a report lists.
SELECTED = ("genre", "language", "type")
# Fixed value: what a report on newspapers says of itself.
LIMITATION = "Metadata describes newspaper issues/pages, not article genre; serialized fiction cannot be filtered reliably without OCR/layout classification."


def field_report(records: DataFrame, column: str = "item") -> dict:
    """Number of records, coverage of their fields, and the most frequent values of SELECTED. records: (pos, item as JSON).

    All counts are made in Spark; the driver gets a row a field, and TOP_VALUES for each selected one.
    """
    fields = record_fields(records, column)
    n = records.count()
    coverage = {r["field"]: {"count": r["n_present"], "percent": r["percent"]} for r in field_coverage(fields).where("n_present > 0").orderBy("field").collect()}
    parts = [fields.where(F.col("field") == k).select("record", "field", F.posexplode(strings_in(F.col("value"))).alias("nth", "value")) for k in SELECTED]
    values = parts[0].unionByName(parts[1]).unionByName(parts[2]).select("field", "value", (F.col("record") * (1 << 20) + F.col("nth")).alias("pos"))
    top = frequent_values(values).orderBy("field", "nth").collect()
    return {"records": n, "field_coverage": coverage, "selected_values": {k: {r["value"]: r["n"] for r in top if r["field"] == k} for k in SELECTED}}


def by_period(rows: DataFrame, year: Column, periods=PERIODS) -> DataFrame:
    """rows with period ('from-to'), those of years outside all periods left out; periods may not overlap."""
    label = F.lit(None).cast("string")
    for lo, hi in periods:
        label = F.when(year.between(lo, hi), f"{lo}-{hi}").otherwise(label)
    return rows.withColumn("period", label).where(F.col("period").isNotNull())


def first_of_each(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """The row of the least pos for each key; partial aggregation keeps one row of a key and task."""
    names = [c for c in rows.columns if c != pos]
    least = F.min_by(F.struct(*names), F.col(pos)).alias("x")
    return rows.groupBy(F.col(key).alias("__k")).agg(least, F.min(pos).alias(pos)).select("x.*", pos)


def first_seen(rows: DataFrame, raw: str, key: str, pos: str) -> DataFrame:
    """The rows that a reader keeps who looks a row's raw value up among the keys kept so far, and then keeps its key.

    A raw value that differs from its key is never found, so its row always stays; one that is its key stays if it is the
    first row of that key. Only the first place of each key is shuffled, combined in the tasks before. A row with a null or
    empty raw value is left out.
    """
    a = rows.where(F.coalesce(F.col(raw), F.lit("")) != "")
    first = a.groupBy(F.col(key).alias("__key")).agg(F.min(pos).alias("__first"))
    kept = a.where(F.col(raw) != F.col(key)).unionByName(a.where(F.col(raw) == F.col(key)).join(first, (F.col(key) == F.col("__key")) & (F.col(pos) == F.col("__first")), "left_semi"))
    return kept.select(*rows.columns)


def secure(url: Column) -> Column:
    return F.regexp_replace(url, "^http://", "https://")
