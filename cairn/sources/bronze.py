"""Replies of the network as a table: what was fetched once is not fetched again, by any harvest on any executor.

The table is append-only Parquet, (key, url, text, at), partitioned by the first two hex digits of key = sha256(url). A
lookup reads the partitions of its addresses alone and is an anti-join before the fetch. Each append writes one file for
each partition that it touches; compact() leaves one file and one row of each address.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files, beside
from ..functions.text import strip
from ..session import stored

SCHEMA = "key string, url string, text string, at timestamp, prefix string"
Fetch = Callable[[DataFrame], DataFrame]


def _keyed(urls: DataFrame) -> DataFrame:
    key = F.sha2("url", 256)
    return urls.select("url").where("url IS NOT NULL").distinct().select("url", key.alias("key"), F.substring(key, 1, 2).alias("prefix"))


def usable(text: Column, as_json: bool = False) -> Column:
    """Whether a reply may be kept and given again: not null or blank, and well-formed where JSON is expected."""
    out = F.coalesce(strip(text) != "", F.lit(False))
    return out & F.try_parse_json(text).isNotNull() if as_json else out


class Bronze:
    """The table of replies at a path; it needn't be there yet."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def rows(self) -> DataFrame:
        """(key, url, text, at, prefix); empty before the first append."""
        if not self.files.exists(self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def known(self, urls: DataFrame, as_json: bool = False) -> DataFrame:
        """(url, text): the last usable reply of each of the addresses that has one. A malformed reply counts as none."""
        own = self.rows().join(_keyed(urls).select("key", "prefix"), ["prefix", "key"], "left_semi").where(usable(F.col("text"), as_json))
        return own.groupBy("prefix", "key").agg(F.max_by(F.struct("url", "text"), "at").alias("x")).select("x.url", "x.text")

    def missing(self, urls: DataFrame, as_json: bool = False) -> DataFrame:
        """(url, key) of the distinct addresses without a usable reply."""
        have = self.rows().where(usable(F.col("text"), as_json)).select("prefix", "key")
        return _keyed(urls).join(have, ["prefix", "key"], "left_anti").select("url", "key")

    def add(self, replies: DataFrame) -> None:
        """Appends (url, text) rows with a text."""
        rows = replies.where("text IS NOT NULL").select(F.sha2("url", 256).alias("key"), "url", "text", F.current_timestamp().alias("at")).withColumn("prefix", F.substring("key", 1, 2))
        rows.repartition("prefix").sortWithinPartitions("prefix", "key").write.mode("append").partitionBy("prefix").parquet(self.path)

    def compact(self) -> None:
        """One row of each address, the last, in one file of each partition; the old table goes when the new one is in place."""
        last = self.rows().groupBy("prefix", "key").agg(F.max_by(F.struct("url", "text", "at"), "at").alias("x")).select("key", "x.*", "prefix")
        staging, aside = beside(self.path, f"staging.{uuid.uuid4().hex}"), beside(self.path, f"old.{uuid.uuid4().hex}")
        last.repartition("prefix").sortWithinPartitions("prefix", "key").write.partitionBy("prefix").parquet(staging)
        self.files.move(self.path, aside)
        try:
            self.files.move(staging, self.path)
        except BaseException:
            self.files.move(aside, self.path)
            raise
        self.files.delete(aside)

    def through(self, fetch: Fetch, as_json: bool = False) -> Fetch:
        """A fetch that asks the network only for addresses without a usable reply here, and keeps the usable ones it gets.

        It runs when it is called: new replies are in the table before it returns, so that whatever reads its result,
        again and again, sends no further request. Failed addresses come with their error and are tried again next time.
        """

        def run(urls: DataFrame) -> DataFrame:
            asked = stored(_keyed(urls), "asked")
            missing = self.missing(asked, as_json)
            if missing.isEmpty():
                return self.known(asked, as_json).withColumn("error", F.lit(None).cast("string"))
            got = stored(fetch(stored(missing.select("url"), "missing")), "replies")
            good = usable(F.col("text"), as_json)
            self.add(got.where(good))
            failed = got.where(~good).select("url", F.lit(None).cast("string").alias("text"), F.coalesce("error", F.lit("malformed or empty reply")).alias("error"))
            return self.known(asked, as_json).withColumn("error", F.lit(None).cast("string")).unionByName(failed)

        return run
