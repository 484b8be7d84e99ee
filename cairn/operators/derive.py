"""Derived corpora: what is pending, packed into bounded batches, run once, merged by source document.

Rows count as done if the state and the output both carry the identity of the row as it is now (a hash of its fields and
of the method). The work is an anti-join, the merge an anti-join and a union; only one batch at a time is on the driver.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files, utc_now
from ..functions.classify import rights_eligible
from ..functions.text import canonical_json, stable_id
from ..session import stored
from ..sources.local import write_jsonl

#: Layout of a run's files; segments it may have, and rows of a file of a merged one at most.
VERSION, SEGMENTS, SEGMENT_ROWS = 3, 16, 200_000
# Fields that are derived, and default bounds.
FIELDS = ("id", "title", "text", "place", "genre")
MAX_BATCH, MAX_DOCUMENT_CHARS, MAX_BATCH_CHARS, MAX_INPUT_CHARS = 50, 100_000, 200_000, 10_000_000


@dataclass(frozen=True)
class Method:
    """What makes a derived row: the function's name and its settings. run: list of field dicts -> list of field dicts."""

    name: str
    run: Callable[[list[dict[str, str]]], list[dict[str, str]]]
    prompt: str = ""
    settings: dict = field(default_factory=dict)

    @property
    def key(self) -> str:
        text = json.dumps([self.name, self.prompt, self.settings], ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(text.encode()).hexdigest()


def source_hash() -> Column:
    """SHA-256 of the canonical JSON of the derived fields and the language."""
    return F.sha2(canonical_json(**{k: F.col(k) for k in (*FIELDS, "language")}), 256)


def request_size() -> Column:
    """Code points of a document's canonical request."""
    return F.length(canonical_json(**{k: F.col(k) for k in FIELDS}))


def identity(method_key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", source_hash(), F.lit(method_key)), 256)


def validated(docs: DataFrame, country: str, language: str) -> DataFrame:
    """docs, or an error that names the first rule broken: unique ids, country, language, native mode, rights."""
    override = F.coalesce(F.get_json_object("metadata", "$.rights_status") == "operator_override", F.lit(False))
    bad = docs.agg(
        (F.count("*") - F.count_distinct("id")).alias("duplicate ids"),
        F.count_if(~F.col("country").eqNullSafe(F.lit(country))).alias("other countries"),
        F.count_if(~(F.col("language").eqNullSafe(F.lit(language)) & F.col("content_mode").eqNullSafe(F.lit("native")))).alias("rows not native"),
        F.count_if(~(rights_eligible(F.col("rights")) | override)).alias("rows without rights"),
    ).collect()[0].asDict()
    if any(bad.values()):
        raise ValueError("documents can't be derived from: " + ", ".join(f"{n} {k}" for k, n in bad.items() if n))
    return docs


def pending(docs: DataFrame, state: DataFrame, output: DataFrame, method_key: str) -> DataFrame:
    """Documents not yet done. state: (document_id, identity, derived_id); output: (id, source_document_id, identity)."""
    return not_done(docs.withColumn("identity", identity(method_key)), state, output).select(*docs.columns, "identity")


def not_done(keyed: DataFrame, state: DataFrame, output: DataFrame) -> DataFrame:
    """pending() of rows (id, identity) with any other columns; those without texts make small joins."""
    done = state.join(output.select(F.col("id").alias("derived_id"), F.col("source_document_id").alias("document_id"), F.col("identity").alias("own")), ["document_id", "derived_id"]).where(F.col("identity") == F.col("own"))
    return keyed.join(done.select(F.col("document_id").alias("id"), "identity"), ["id", "identity"], "left_anti")


#: Documents that one task packs, about.
PACKED_ROWS = 50_000


def batches(docs: DataFrame, *, size: int = 10, max_document: int = MAX_DOCUMENT_CHARS, max_batch: int = MAX_BATCH_CHARS, order: str = "pos", group: Column | None = None, task_rows: int = PACKED_ROWS, chars: Column | None = None) -> DataFrame:
    """(id, pos, chars, batch, batch_chars, grp): greedy batches in order, bounded by rows and by characters of a JSON array.

    Packing one sequence is a chain, but a task only has to know how many of its first rows (less than `size`) the batch
    before it takes. So rows (texts left behind) are dealt by ranges of (group, order); each task packs its range for
    every such beginning and returns the few results; the driver links them, with a few numbers for each range; a second
    pass packs with the beginnings found. Equal orders go by id. A document over a bound fails the query. chars: the
    request_size() of each row, if it is known.
    """
    if not 1 <= size <= MAX_BATCH:
        raise ValueError(f"size must be from 1 to {MAX_BATCH}")
    n = request_size() if chars is None else chars
    fits = F.when((n > max_document) | (n + 2 > max_batch), F.raise_error(F.concat(F.lit("document too long: "), F.col("id")))).otherwise(n)
    a = docs.select((group if group is not None else F.lit("")).cast("string").alias("grp"), F.col(order).cast("bigint").alias("pos"), "id", fits.alias("chars"))
    ranges = max(1, -(-a.select("pos").count() // task_rows))
    a = stored(a.repartitionByRange(ranges, "grp", "pos", "id").sortWithinPartitions("grp", "pos", "id").withColumn("part", F.spark_partition_id()), "packing")

    def beginnings(key: tuple, t: pa.Table) -> pa.Table:
        grp, chars = _columns(t)
        ends = [_pack(grp, chars, e, size, max_batch)[1] for e in range(min(size, len(grp)))]
        own = json.dumps({"head": [[g, c] for g, c in zip(grp[:size], chars[:size], strict=True)], "n": len(grp), "ends": ends})
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "found": [own]})

    links = {r["part"]: json.loads(r["found"]) for r in a.groupBy("part").applyInArrow(beginnings, "part int, found string").collect()}
    # the open batch as [group, rows, chars, number]
    opened: list | None = None
    begin: dict[int, tuple[int, list | None]] = {}
    for part in sorted(links):
        x, e, now = links[part], 0, list(opened) if opened else None
        while now and e < len(x["head"]) and x["head"][e][0] == now[0] and now[1] < size and now[2] + x["head"][e][1] + 1 <= max_batch:
            now[1], now[2], e = now[1] + 1, now[2] + x["head"][e][1] + 1, e + 1
        begin[part] = (e, opened)
        if e < x["n"]:
            g, rows, chars, number = x["ends"][e]
            opened = [g, rows, chars, number + (now[3] + 1 if now and now[0] == g else 0)]
        else:
            opened = now

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        grp, chars = _columns(t)
        e, before = begin[key[0].as_py()]
        of, _ = _pack(grp, chars, e, size, max_batch)
        # batches of the group that was open before count on from there
        first = [before[3] if k < e else b + (before[3] + 1 if before and before[0] == g else 0) for k, (g, b) in enumerate(zip(grp, of, strict=True))]
        return t.select(["grp", "pos", "id", "chars"]).append_column("batch", pa.array(first, pa.int32()))

    rows = a.groupBy("part").applyInArrow(pack, "grp string, pos bigint, id string, chars int, batch int")
    total = rows.groupBy("grp", "batch").agg((F.sum("chars") + F.count("*") + 1).alias("batch_chars"))
    return rows.join(total, ["grp", "batch"]).select("id", "pos", "chars", "batch", "batch_chars", *(["grp"] if group is not None else []))


def _columns(t: pa.Table) -> tuple[list[str], list[int]]:
    t = t.sort_by([("grp", "ascending"), ("pos", "ascending"), ("id", "ascending")])
    return t.column("grp").to_pylist(), t.column("chars").to_pylist()


def _pack(grp: list[str], chars: list[int], begin: int, size: int, most: int) -> tuple[list[int], list]:
    """Batch numbers from row `begin` on, each group from 0 (rows before it get -1), and the open batch at the end.

    The open batch: group, rows, characters, number.
    """
    out, g, rows, total, number = [-1] * begin, None, 0, 0, -1
    for k in range(begin, len(grp)):
        if grp[k] != g or rows >= size or total + chars[k] + 1 > most:
            number = number + 1 if grp[k] == g else 0
            g, rows, total = grp[k], 1, chars[k] + 2
        else:
            rows, total = rows + 1, total + chars[k] + 1
        out.append(number)
    return out, [g, rows, total, number]


def merged(output: DataFrame, new: DataFrame) -> DataFrame:
    """output with new rows in place of those of the same source_document_id."""
    return output.join(new.select("source_document_id"), "source_document_id", "left_anti").select(*output.columns).unionByName(new.select(*output.columns))


def checked_reply(asked: list[dict[str, str]], got: list[dict[str, str]]) -> list[dict[str, str]]:
    """The reply in order of the request; other fields, other types or other ids raise."""
    if not isinstance(got, list) or any(not isinstance(r, dict) or set(r) != set(FIELDS) for r in got):
        raise RuntimeError("a reply row has other fields than asked for")
    if any(not isinstance(v, str) for r in got for v in r.values()):
        raise RuntimeError("reply fields must be texts")
    by_id = {r["id"]: r for r in got}
    if len(by_id) != len(got) or set(by_id) != {r["id"] for r in asked}:
        raise RuntimeError("reply ids don't match the batch")
    return [by_id[r["id"]] for r in asked]


def digest(rows: list[dict[str, str]]) -> str:
    """SHA-256 of the canonical JSON of rows."""
    return hashlib.sha256(json.dumps(rows, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


@dataclass(frozen=True)
class Reply:
    """What a method may return in place of plain rows: the rows and what it says of them, which is checked."""

    rows: list[dict[str, str]]
    input_sha256: str
    output_sha256: str
    response_id: str = ""
    model: str = ""
    usage: dict = field(default_factory=dict)


def verified(asked: list[dict[str, str]], got: Reply | list[dict[str, str]]) -> Reply:
    """The checked rows in order of the request with both hashes; hashes of a Reply that differ from these raise."""
    rows = checked_reply(asked, got.rows if isinstance(got, Reply) else got)
    if not isinstance(got, Reply):
        return Reply(rows, digest(asked), digest(rows))
    if got.input_sha256 != digest(asked):
        raise RuntimeError("the reply is to another input: its input hash differs")
    if got.output_sha256 != digest(rows):
        raise RuntimeError("the reply's output hash differs from its rows")
    return replace(got, rows=rows)


def unique_rows(output: DataFrame) -> DataFrame:
    """output, if every row has an id and no id and no source_document_id stands twice; else it raises."""
    bad = output.agg(
        F.count_if(F.coalesce(F.col("id"), F.lit("")) == "").alias("rows without an id"),
        (F.count("id") - F.count_distinct("id")).alias("repeated ids"),
        (F.count("source_document_id") - F.count_distinct("source_document_id")).alias("repeated source documents"),
    ).collect()[0].asDict()
    if any(bad.values()):
        raise RuntimeError("refusing derived rows: " + ", ".join(f"{n} {k}" for k, n in bad.items() if n))
    return output


class Run:
    """Files of a derived corpus under a directory: segments of rows as Parquet, and one JSON marker that lists them.

    A batch is marked before it runs; then its rows are written as a new segment, then the marker lists it in one atomic
    replace. Segments that the marker doesn't list are as if they weren't there. Readers take the last row of a source
    document. Small segments are merged into larger ones, each of which is about as large as all that are newer, so that a
    row is written anew a few times only, and files and marker stay small, however many batches there were.

    A marker that is still in flight stops the next run until retry is allowed; one that can't be read, or of another
    country, raises. Each row carries the hash of what was derived, and its batch's hashes of input and output; a row that
    has changed since, or that stands twice in one batch, raises when the rows are read.
    """

    OUTPUT = "id string, source_document_id string, title string, text string, place string, genre string, language string, content_mode string, identity string, method string"
    STATE = "document_id string, identity string, derived_id string"
    ROWS = f"{OUTPUT}, seq bigint, batch_id string, row_sha256 string, input_sha256 string, output_sha256 string, response_id string, model string, usage string, completed string"
    DERIVED = "batch_id string, source_document_id string, title string, text string, place string, genre string, identity string, input_sha256 string, output_sha256 string, response_id string, model string, usage string, completed string"

    def __init__(self, spark: SparkSession, path: str, country: str | None = None):
        self.spark, self.path, self.files = spark, path, Files(spark)
        self.files.make(path)
        self.marker = {"version": VERSION, "country": country, "in_flight": None, "segments": [], "next": 0, "batches": 0}
        if self.files.exists(f"{path}/marker.json") or self.files.exists(f"{path}/.marker.json.old"):
            try:
                self.marker = self.files.read_json(f"{path}/marker.json")
            except ValueError as e:
                raise RuntimeError("the marker can't be read") from e
            if not isinstance(self.marker, dict) or self.marker.get("version") != VERSION or not isinstance(self.marker.get("segments"), list) or "in_flight" not in self.marker:
                raise RuntimeError("the marker is malformed")
            if country is not None and self.marker.get("country") not in (None, country):
                raise ValueError(f"the run belongs to {self.marker['country']}, not {country}")

    def _commit(self, **changes) -> None:
        self.marker = {**self.marker, **changes}
        self.files.write_json(f"{self.path}/marker.json", self.marker)

    def _read(self, segments: list[dict]) -> DataFrame:
        """The rows of segments as they were written; a changed row raises."""
        if not segments:
            return self.spark.createDataFrame([], self.ROWS)
        a = self.spark.read.schema(self.ROWS).parquet(*[f"{self.path}/segments/{s['name']}" for s in segments])
        changed = F.raise_error(F.concat(F.lit("refusing a derived row that has changed: "), F.coalesce("id", F.lit("null"))))
        return a.withColumn("row_sha256", F.when(F.col("row_sha256") == row_hash(), F.col("row_sha256")).otherwise(changed))

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last row of each source document; one that stands twice in a batch raises."""
        names = [c for c in rows.columns if c != "source_document_id"]
        # a set of the few seqs, as a distinct count would shuffle the rows twice
        last = rows.groupBy("source_document_id").agg(F.max_by(F.struct(*names), "seq").alias("x"), F.count("*").alias("n"), F.size(F.collect_set("seq")).alias("m"))
        twice = F.raise_error(F.concat(F.lit("refusing a source document that stands twice in a batch: "), "source_document_id"))
        own = F.when(F.col("n") == F.col("m"), F.col("source_document_id")).otherwise(twice)
        return last.select(own.alias("source_document_id"), "x.*").select(*rows.columns)

    def table(self, name: str) -> DataFrame:
        """`output` or `state` as committed: the last row of each source document."""
        if name == "output":
            return self._last(self._read(self.marker["segments"])).where("row_sha256 IS NOT NULL").select(*[c.split()[0] for c in self.OUTPUT.split(", ")])
        return self._keys().select(F.col("source_document_id").alias("document_id"), "identity", F.col("id").alias("derived_id"))

    def _keys(self) -> DataFrame:
        """(source_document_id, identity, id) as committed: rows are checked where they are read, and texts stay there."""
        rows = self._read(self.marker["segments"]).select("source_document_id", "identity", "id", "seq", "row_sha256")
        return self._last(rows).where("row_sha256 IS NOT NULL").select("source_document_id", "identity", "id")

    def verify(self) -> int:
        """The number of batches whose rows, all of them there, give the batch's hash of output.

        A batch of which a later one has replaced rows isn't whole and doesn't count.
        """
        rows = self._read(self.marker["segments"])
        form = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_document_id", derived_json().alias("j")))), lambda x: x["j"]), ","), F.lit("]"))
        whole = rows.groupBy("batch_id", "output_sha256").agg(F.sha2(form, 256).alias("own"))  # rows of one batch
        return whole.agg(F.count_if(F.col("own") == F.col("output_sha256")).alias("n")).first()["n"]

    def publish(self, path: str) -> None:
        """The output as JSON Lines in place of what is there, after unique_rows()."""
        write_jsonl(unique_rows(self.table("output")), path)

    def plan(self, docs: DataFrame, method: Method, **bounds) -> DataFrame:
        return self._dealt(docs, method, None, bounds)[1]

    def _dealt(self, docs: DataFrame, method: Method, limit: int | None, bounds: dict) -> tuple[DataFrame, DataFrame]:
        """What is pending (id, identity), the first `limit` of it, and its batches(); without the texts."""
        bounds, own = dict(bounds), {"id": F.col("id"), "identity": identity(method.key), "__chars": request_size()}
        own |= {c: F.col(c) for c in ("pos", bounds.get("order", "pos")) if c in docs.columns}
        if bounds.get("group") is not None:
            own["__grp"], bounds["group"] = bounds["group"], F.col("__grp")
        done = stored(self._keys(), "done")
        state = done.select(F.col("source_document_id").alias("document_id"), "identity", F.col("id").alias("derived_id"))
        todo = not_done(docs.select(*[c.alias(k) for k, c in own.items()]), state, unique_rows(done))
        if limit is not None:
            todo = todo.orderBy("pos").limit(max(0, limit))
        todo = stored(todo, "pending")
        return todo.select("id", "identity"), batches(todo, chars=F.col("__chars"), **bounds)

    def _append(self, derived: DataFrame, method: Method, n_batches: int) -> int:
        """Writes derived rows as a segment and lists it; returns their number."""
        seq, name = self.marker["next"], f"seq-{self.marker['next']}"
        rows = derived.withColumns({"id": F.concat(F.lit("derived:"), stable_id(F.lit(method.name), F.col("source_document_id"), F.col("identity"))), "language": F.lit("en"), "content_mode": F.lit("english_translation"), "method": F.lit(method.key), "seq": F.lit(seq).cast("bigint"), "row_sha256": row_hash()})
        rows.select(*[c.split()[0] for c in self.ROWS.split(", ")]).write.mode("overwrite").parquet(f"{self.path}/segments/{name}")
        n = unique_rows(self._read([{"name": name}])).count()
        self._commit(in_flight=None, segments=[*self.marker["segments"], {"name": name, "rows": n}], next=seq + 1, batches=self.marker["batches"] + n_batches)
        self.compact()
        return n

    def compact(self, most: int | None = None) -> None:
        """Merges the newest segments while there are more than `most` (SEGMENTS): as many as aren't larger than those after them."""
        most = SEGMENTS if most is None else most
        segments = self.marker["segments"]
        if len(segments) <= most:
            return
        k, total = len(segments), 0
        while k > 0 and (len(segments) - k < most or segments[k - 1]["rows"] <= 2 * total):
            k, total = k - 1, total + segments[k - 1]["rows"]
        merged, name = segments[k:], f"merged-{self.marker['next']}-{uuid.uuid4().hex[:8]}"
        # adaptive execution sizes the parts of the one shuffle
        self._last(self._read(merged)).write.option("maxRecordsPerFile", SEGMENT_ROWS).parquet(f"{self.path}/segments/{name}")
        n = self._read([{"name": name}]).count()
        self._commit(segments=[*segments[:k], {"name": name, "rows": n}])
        for s in merged:
            self.files.delete(f"{self.path}/segments/{s['name']}")

    def execute(self, docs: DataFrame, method: Method, *, limit: int | None = None, retry: bool = False, max_input: int = MAX_INPUT_CHARS, bulk: bool = False, **bounds) -> int:
        """Derives what is pending, batch by batch; returns the number of rows. Over max_input characters it raises.

        bulk: all batches run on the executors in one job, and are one segment; nothing of them is on the driver. A task
        that is lost runs its batches again, so the method must bear that. Else a batch at a time runs on the driver,
        marked in flight, and none runs twice unasked.
        """
        if self.marker["in_flight"] and not retry:
            raise RuntimeError(f"batch {self.marker['in_flight']['batch_id']} may have run; look at it or allow a retry")
        todo, dealt = self._dealt(docs, method, limit, bounds)
        dealt = stored(todo.join(dealt.select("id", "batch", "batch_chars"), "id"), "dealt")
        each = dealt.groupBy("batch").agg(F.max("batch_chars").alias("chars"))
        planned = each.agg(F.count("*").alias("n"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars")).first()
        if planned["chars"] > max_input:
            raise ValueError("the planned input is over the ceiling")
        if not planned["n"]:
            return 0
        # only here the texts join, once
        keyed = docs.drop("identity", "batch").join(dealt.select("id", "identity", "batch"), "id").select("pos", "batch", "identity", *FIELDS)
        if bulk:
            self._commit(in_flight={"batch_id": f"all {planned['n']}", "since": utc_now()})
            run = lambda table: pa.Table.from_pylist(_derived(table.sort_by("pos").to_pylist(), method), _ARROW)
            return self._append(keyed.groupBy("batch").applyInArrow(run, self.DERIVED), method, planned["n"])
        # a batch reads its own row groups: rows lie in order of the batches
        keyed.repartitionByRange("batch", "pos").sortWithinPartitions("batch", "pos").write.mode("overwrite").parquet(f"{self.path}/todo")
        keyed, done = self.spark.read.parquet(f"{self.path}/todo"), 0
        for b in each.select("batch").orderBy("batch").toLocalIterator():
            rows = [r.asDict() for r in keyed.where(F.col("batch") == b["batch"]).orderBy("pos").collect()]
            self._commit(in_flight={"batch_id": batch_key(rows, method), "ids": [r["id"] for r in rows], "since": utc_now()})
            done += self._append(self.spark.createDataFrame(pa.Table.from_pylist(_derived(rows, method), _ARROW)).coalesce(1), method, 1)
        return done


_ARROW = pa.schema([(c.split()[0], pa.string()) for c in Run.DERIVED.split(", ")])


def batch_key(rows: list[dict], method: Method) -> str:
    """24 hex digits of a batch: its method and the identities of its rows in order."""
    return hashlib.sha256("\x1f".join([method.key, *(r["identity"] for r in rows)]).encode()).hexdigest()[:24]


def _derived(rows: list[dict], method: Method) -> list[dict[str, str]]:
    """The checked rows of one batch, in order of the source documents' ids, as Run.DERIVED has them."""
    asked = [{k: r[k] or "" for k in FIELDS} for r in rows]
    reply = verified(asked, method.run(asked))
    own = {"batch_id": batch_key(rows, method), "input_sha256": reply.input_sha256, "response_id": reply.response_id, "model": reply.model, "usage": json.dumps(reply.usage, sort_keys=True), "completed": utc_now()}
    by_id = {r["id"]: (r, g) for r, g in zip(rows, reply.rows, strict=True)}
    ordered = [by_id[i] for i in sorted(by_id)]
    own["output_sha256"] = digest([g for _, g in ordered])  # in an order that the rows themselves have
    return [{**own, "source_document_id": r["id"], "identity": r["identity"], **{k: g[k] for k in FIELDS if k != "id"}} for r, g in ordered]


def derived_json() -> Column:
    """The canonical JSON of what was derived of a row of Run."""
    return canonical_json(id=F.col("source_document_id"), **{k: F.col(k) for k in FIELDS if k != "id"})


def row_hash() -> Column:
    """SHA-256 of what was derived, of the row's identity and of its batch."""
    return F.sha2(F.concat_ws("\x1f", derived_json(), "identity", "batch_id", "input_sha256", "output_sha256"), 256)
