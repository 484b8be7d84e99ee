"""Ranked lexical search over a tiered index: postings of high impact first, with a bound for what each term still holds.

A posting's impact is the part of the score that depends on the document alone. The postings of a term are dealt to tiers
by falling impact; each tier holds TIER_GROWTH times as many as those before it. A search reads the first tier of all
terms. What a document can still gain is bounded by the greatest impact that each unread term holds below; an item whose
k-th best score is above that bound is proven, and the documents that its bound lets in are scored exactly. Items without
proof fall through to the next tier, where frequent terms whose summed greatest impacts stay below half of the k-th score
known so far aren't read at all. After the last tier nothing is left unread, so every item is proven at some tier.

Terms are known by 64-bit hashes of their bytes: two of 10^9 different terms and one of 10^4 wanted terms meet with a
probability below 10^-6. No table is sent to the driver; it holds the counts N and L, the number of open items and, if
there are at most WANTED_TERMS of them, the hashes of the items' terms, so that only their postings are made.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MARKS, STEP_BYTES, groups_of, lean, shared_dir, stored, text_buffer, words_of

#: Documents of a result.
TOP = 20
#: Postings of a term's first tier, about, and how many times as many the tiers up to the next hold.
TIER_ROWS, TIER_GROWTH = 1024, 8
#: Terms of items that may be sent to all tasks (8 bytes each); with more, the index holds all terms of the documents.
WANTED_TERMS = 1 << 20
#: Rows of a few numbers that may be broadcast: a few MB.
BROADCAST_ROWS = 50_000
#: Steps of impact that histograms tell apart, for each doubling of the distance from the greatest impact.
_STEPS = 32
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclasses.dataclass
class Index:
    """Tables of an index.

    forward: (row, id, n, terms, tfs), the documents that some result can hold; terms: (term, df, w, best, rest), where
    rest[k] is the greatest impact below tier k; postings: (term, row, impact, tier), partitioned by tier.
    """

    forward: DataFrame
    terms: DataFrame
    postings: DataFrame
    n_docs: int
    n_terms: int
    top: int
    tiers: int


def _pieces(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of a text of about STEP_BYTES that end at a mark, so that no term is parted."""
    at = 0
    while at < len(buf):
        end = min(len(buf), at + STEP_BYTES)
        while end < len(buf):
            marks = np.flatnonzero(MARKS[buf[end : end + STEP_BYTES]])
            if len(marks):
                end += int(marks[0])
                break
            end = min(len(buf), end + STEP_BYTES)
        yield at, end
        at = end


def _counted(buf: np.ndarray, cut: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that begin at `cut`: their numbers of terms; then text, term and frequency of each pair, by text and term."""
    s, _, h = words_of(_LOWER[buf], cut, MARKS)
    doc = np.searchsorted(cut, s, "right") - 1
    n = np.bincount(doc, minlength=len(cut))
    if wanted is None:
        known, code = np.unique(h, return_inverse=True)
    else:
        known, code = wanted, np.searchsorted(wanted, h)
        code[code == len(wanted)] = 0
        hit = wanted[code] == h if len(wanted) else np.zeros(len(h), bool)
        doc, code = doc[hit], code[hit]
    pair, tf = np.unique(doc * np.int64(max(1, len(known))) + code, return_counts=True)
    return n, pair // max(1, len(known)), known[pair % len(known)] if len(pair) else np.zeros(0, np.uint64), tf


def scan(rows: DataFrame, id_column: str, wanted: np.ndarray | None = None) -> DataFrame:
    """(id, n, terms, tfs) of each row: its number of terms, its different terms as hashes in order, and their frequencies.

    wanted: sorted hashes; others are counted in n, but not listed. Null and empty texts have n = 0.
    """

    @lean("ranked")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, ends = text_buffer(batch.column(1))
            for i, j in groups_of(starts, ends):
                begin, buf = starts[i:j] - starts[i], raw[starts[i] : ends[j - 1]]
                if j - i > 1 or len(buf) <= STEP_BYTES:
                    n, doc, term, tf = _counted(buf, begin, wanted)
                else:  # one long text: counts of its pieces are summed
                    parts = [_counted(buf[a:b], np.zeros(1, np.int64), wanted) for a, b in _pieces(buf)]
                    n, (term, at) = sum(p[0] for p in parts), np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
                    tf = np.bincount(at, np.concatenate([p[3] for p in parts]), len(term)).astype(np.int64)
                    doc = np.zeros(len(term), np.int64)
                offsets = pa.array(np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (term.view(np.int64) if len(term) else np.zeros(0, np.int64), tf.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), *lists], ["id", "n", "terms", "tfs"])

    kind = rows.schema[id_column].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])
    return rows.select(F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, schema)


def impact_sql(n_docs: int, n_terms: int) -> str:
    """SQL for the part of a score that a term's weight is multiplied by, from n and tf; below a million."""
    return f"cast((1000000000L * tf) div (1000L * tf + 12L * (75L + (25L * n * {n_docs}L) div {n_terms}L)) AS int)"


def _small(df: DataFrame, rows: int) -> DataFrame:
    """df to be broadcast if it has at most BROADCAST_ROWS rows of a few numbers each; else Spark joins by shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def build(docs: DataFrame, *, wanted: np.ndarray | None = None, id_column: str = "doc_id", top: int = TOP, tier_rows: int = TIER_ROWS) -> Index:
    """The index of all documents, for results of `top` rows at most.

    Every row is a document, also if its id is null or repeats; N, L and df count them all. Of documents with equal term
    counts, which score alike for every item, the index keeps the `top` first by id (null last), as no result can hold
    more. An empty table gives an empty index.
    """
    spark = docs.sparkSession
    scanned = stored(scan(docs, id_column, wanted).where("n > 0").withColumn("row", F.monotonically_increasing_id()), "ranked-scan")
    total = scanned.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).collect()[0]
    n_docs, n_terms = total["n"], max(1, total["l"])
    same = Window.partitionBy(F.xxhash64("n", "terms", "tfs"), "n", "terms", "tfs").orderBy(F.asc_nulls_last("id"), "row")
    forward = stored(scanned.where(F.size("terms") > 0).withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= top).drop("nth"), "ranked-forward")
    pairs = forward.select("row", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).selectExpr("x.terms AS term", "row", "n", "x.tfs AS tf")
    pairs = pairs.select("term", "row", F.expr(impact_sql(n_docs, n_terms)).alias("impact"))
    # small levels are great impacts; they tell the more apart the nearer these are to the greatest
    level = F.floor(_STEPS * F.log2(F.lit(1_000_001) - F.col("impact"))).cast("int")
    levels = pairs.groupBy("term", level.alias("level")).agg(F.count("*").alias("c"), F.max("impact").alias("high"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("term").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tier = F.when(before < tier_rows, 0).otherwise(F.floor(F.log(float(TIER_GROWTH), before / tier_rows)).cast("int") + 1)
    cuts = levels.withColumn("tier", tier).groupBy("term", "tier").agg(F.max("level").alias("last"), F.max("high").alias("high"))
    cuts = cuts.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("tier", "last", "high"))).alias("cuts"))  # one for each tier
    df = scanned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    terms = stored(df.join(cuts, "term").select("term", "df", w.alias("w"), "cuts"), "ranked-terms")
    known = terms.agg(F.count("*").alias("n"), F.max(F.element_at("cuts", -1)["tier"]).alias("t")).collect()[0]
    tiers = (known["t"] or 0) + 1
    rest = F.transform(F.sequence(F.lit(0), F.lit(tiers - 1)), lambda k: F.coalesce(F.array_max(F.transform(F.filter("cuts", lambda c: c["tier"] > k), lambda c: c["high"])), F.lit(0)))
    placed = pairs.withColumn("level", level).join(_small(terms.select("term", "cuts"), known["n"]), "term")
    placed = placed.select("term", "row", "impact", F.filter("cuts", lambda c: c["last"] >= F.col("level"))[0]["tier"].alias("tier"))
    path = f"{shared_dir(spark)}/ranked-postings-{uuid.uuid4().hex}"
    placed.sortWithinPartitions("tier", "term").write.partitionBy("tier").parquet(path)
    postings = spark.read.schema("term bigint, row bigint, impact int, tier int").parquet(path)
    return Index(forward, terms.select("term", "df", "w", F.element_at("cuts", 1)["high"].alias("best"), rest.alias("rest")), postings, n_docs, n_terms, top, tiers)


def wanted_terms(items: DataFrame) -> np.ndarray | None:
    """The sorted hashes of all terms of the scanned items; None if there are more than WANTED_TERMS."""
    terms = items.select(F.explode("terms").alias("term")).distinct().limit(WANTED_TERMS + 1)
    found = terms.toArrow()["term"].to_numpy().astype(np.int64).view(np.uint64)
    return np.sort(found) if len(found) <= WANTED_TERMS else None


def search(index: Index, items: DataFrame, log: list | None = None) -> DataFrame:
    """(q, item, rank, id, score) of each scanned item's best documents; items without a document that scores have no row.

    items: scan() of the items with q, a row number. Equal scores come by id, null last. Repeated rows of items are each
    answered. log: gets a dict for each tier: items open before it, proven by it, and postings joined.
    """
    own = items.select("q", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).selectExpr("q", "x.terms AS term", "x.tfs AS c")
    own = stored(own.join(index.terms, "term").where("w > 0").select("q", "term", (F.col("c") * F.col("w")).alias("cw"), "best", "rest"), "ranked-items")
    n_own = own.count()
    state = stored(own.select("q").distinct().withColumn("theta", F.lit(0).cast("long")), "ranked-state")  # of the open items
    found = None
    for k in range(index.tiers):
        last = k == index.tiers - 1
        # terms by rising greatest gain: those that together stay below half the threshold aren't read
        small = F.sum(F.col("cw") * F.col("best")).over(Window.partitionBy("q").orderBy(F.col("cw") * F.col("best"), "term"))
        used = own.join(state, "q").withColumn("skip", 2 * small < F.col("theta"))
        used = stored(used.select("q", "term", "cw", "theta", "skip", F.when(F.col("skip"), F.col("best")).otherwise(F.col("rest")[k]).alias("left")), "ranked-used")
        seen = used.where("NOT skip").select("q", "term", "cw", "left")
        hits = index.postings.where(F.col("tier") <= k).join(_small(seen, n_own), "term")
        sums = stored(hits.groupBy("q", "row").agg(F.sum(F.col("cw") * F.col("impact")).alias("low"), F.sum(F.col("cw") * (F.col("impact") - F.col("left"))).alias("gain")), "ranked-sums")
        nth = sums.select("q", "low", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("low"))).alias("nth")).where(F.col("nth") <= index.top)
        kth = nth.where(F.col("nth") == index.top).select("q", F.col("low").alias("kth"))
        bound = used.groupBy("q").agg(F.max("theta").alias("theta"), F.sum(F.col("cw") * F.col("left")).alias("most"))
        after = bound.join(kth, "q", "left").select("q", "most", F.greatest("theta", F.coalesce("kth", F.lit(0))).alias("theta"))
        after = stored(after.withColumn("proven", (F.col("most") < F.col("theta")) | (F.lit(last))), "ranked-state")
        passed = sums.join(_small(after.where("proven"), n_own), "q").where(F.col("most") + F.col("gain") >= F.col("theta")).select("q", "row")
        found = passed if found is None else found.unionByName(passed)
        state = after.where("NOT proven").select("q", "theta")
        n_open = state.count()
        if log is not None:
            log.append({"tier": k, "open": after.count(), "proven": after.where("proven").count(), "postings": hits.count()})
        if not n_open:
            break
    if found is None:  # pragma: no cover
        raise ValueError("an index has one tier at least")
    impacts = index.forward.join(found, "row").select("q", "row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).selectExpr("q", "row", "id", "x.terms AS term", "n", "x.tfs AS tf")
    impacts = impacts.select("q", "row", "id", "term", F.expr(impact_sql(index.n_docs, index.n_terms)).alias("impact"))
    scores = impacts.join(_small(own.select("q", "term", "cw"), n_own), ["q", "term"]).groupBy("q", "row", "id").agg(F.sum(F.col("cw") * F.col("impact")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row"))
    ranked = scores.where("score > 0").withColumn("rank", rank).where(F.col("rank") <= index.top)
    return ranked.join(items.select("q", F.col("id").alias("item")), "q").select("q", "item", "rank", "id", "score")


def top_documents(docs: DataFrame, items: DataFrame, *, doc_key: str = "doc_id", item_key: str = "item_id", text_column: str = "text", top: int = TOP, log: list | None = None) -> DataFrame:
    """The `top` best documents of every item: item, rank, id, score. Null and empty texts match nothing."""
    asked = stored(scan(items.select(item_key, F.col(text_column).alias("text")), item_key).withColumn("q", F.monotonically_increasing_id()), "ranked-asked")
    index = build(docs.select(doc_key, F.col(text_column).alias("text")), wanted=wanted_terms(asked), id_column=doc_key, top=top)
    return search(index, asked, log)
