"""python -m cairn.cli VERB: list-sources, harvest, collect, build, query, derive-plan, derive, audit, review."""

from __future__ import annotations

import argparse
import json
import re
import sys

from pyspark.sql import functions as F

from .files import Files, utc_now
from .functions.text import earliest_year
from .operators import audit, index, responses, search
from .operators.derive import FIELDS, Method, Run, batches, validated
from .operators.embed import HashingEmbedder, query_vector
from .session import local_session, ship_package, stored
from .sources import harvest, local, registry, tei


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cairn")
    sub = p.add_subparsers(dest="verb", required=True)
    s = sub.add_parser("list-sources")
    s.add_argument("registry")
    s = sub.add_parser("harvest", help="documents of a country's source, from an export or by its protocol, appended or replaced")
    for name in ("registry", "country", "source"):
        s.add_argument(name)
    s.add_argument("root", help="folder of the export; - asks the source itself")
    s.add_argument("out")
    s.add_argument("--limit", type=int)
    s.add_argument("--rights-override", default="")
    s.add_argument("--max-bytes", type=int, default=local.MAX_BYTES)
    s.add_argument("--append", action="store_true")
    s = sub.add_parser("collect", help="documents of a collection, in its order: " + ", ".join(sorted(harvest.COLLECTIONS)) + ", or batches")
    s.add_argument("name")
    s.add_argument("out")
    s.add_argument("--limit", type=int)
    s.add_argument("--replies", help="a table of replies: what it has isn't fetched again, and new replies are added")
    s.add_argument("--query", default="", help="newspapers: what the search looks for")
    s.add_argument("--date-from", type=int, default=1900)
    s.add_argument("--date-to", type=int, default=1929)
    s.add_argument("--listing", help="letters: a file of their list; books: a file of the catalogue's records")
    s.add_argument("--manifest", help="books: a file of the list of files")
    s.add_argument("--root", help="TEI: the folder of the files")
    s.add_argument("--base", action="append", default=[], help="batches: the address of a batch's data; may be repeated")
    s.add_argument("--uncertain", action="store_true", help="books and TEI: those that the rules aren't sure of, too")
    s.add_argument("--max-bytes", type=int, default=local.MAX_BYTES)
    s.add_argument("--append", action="store_true")
    s = sub.add_parser("build")
    s.add_argument("corpus")
    s.add_argument("index")
    s.add_argument("--target", type=int, default=350)
    s.add_argument("--overlap", type=int, default=50)
    s.add_argument("--country")
    s.add_argument("--content-mode")
    s = sub.add_parser("query")
    s.add_argument("index")
    s.add_argument("question")
    s.add_argument("--top-k", type=int, default=8)
    s.add_argument("--source", default="")
    s.add_argument("--date-from", type=int)
    s.add_argument("--date-to", type=int)
    s.add_argument("--per-document", type=int, default=2)
    s.add_argument("--prompt", action="store_true")
    s.add_argument("--country")
    s.add_argument("--content-mode")
    s = sub.add_parser("derive-plan", help="batches that a derivation would run; runs nothing")
    s.add_argument("corpus")
    s.add_argument("country")
    s.add_argument("language")
    s.add_argument("--size", type=int, default=10)
    s = sub.add_parser("review", help="the list of TEI texts to review, as CSV")
    s.add_argument("root")
    s.add_argument("out")
    s = sub.add_parser("derive", help="runs what is pending through a remote model; needs --execute")
    for name in ("corpus", "country", "language", "run", "out", "model", "instructions"):
        s.add_argument(name)
    s.add_argument("--size", type=int, default=10)
    s.add_argument("--limit", type=int)
    s.add_argument("--retry", action="store_true")
    s.add_argument("--execute", action="store_true")
    s = sub.add_parser("audit-newspapers", help="a sample of the newspapers' records in four periods: a report and, beside it, the records")
    s.add_argument("report", help="a JSON file; the records go to <its name>_records.jsonl")
    s.add_argument("--per-period", type=int, default=15)
    s = sub.add_parser("audit", help="coverage of the fields and documents by period")
    s.add_argument("corpus")
    s.add_argument("--report", help="a JSON file for the figures")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = local_session("cairn-cli")
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    show = lambda df: [print(json.dumps(r.asDict(recursive=True), ensure_ascii=False, default=str)) for r in df.toLocalIterator()]
    if a.verb == "list-sources":
        show(registry.sources(registry.registry(spark, a.registry)))
    elif a.verb == "harvest":
        m = registry.country(spark, a.country, a.registry)
        registry.usable_source(m, a.source)
        options = {"max_bytes": a.max_bytes}
        docs = harvest.collect_country(spark, {**m, "id": a.country}, m["sources"][a.source], input_root=None if a.root == "-" else a.root, rights_override=a.rights_override, limit=a.limit, **options)
        if a.append:
            print(json.dumps({"added": harvest.add_new(docs, a.out)}))
        else:
            local.write_jsonl(docs, a.out)
    elif a.verb == "collect":
        docs = harvest.collect_named(spark, a.name, replies=a.replies, limit=a.limit, query=a.query, date_from=a.date_from, date_to=a.date_to, listing=a.listing, manifest=a.manifest, root=a.root, bases=a.base, uncertain=a.uncertain, max_bytes=a.max_bytes)
        if a.append:
            print(json.dumps({"added": harvest.add_new(docs, a.out)}))
        else:
            local.write_jsonl(docs, a.out)
    elif a.verb == "build":
        print(json.dumps(index.build(local.read_jsonl(spark, a.corpus), a.index, HashingEmbedder(), target=a.target, overlap=a.overlap, country=a.country, content_mode=a.content_mode), ensure_ascii=False))
    elif a.verb == "query":
        chunks, vectors, lexical = index.open_index(spark, a.index, a.country, a.content_mode)
        found = search.search(chunks, vectors, a.question, query_vector(spark, HashingEmbedder(), a.question), lexical_index=lexical, top_k=a.top_k, source=a.source, date_from=a.date_from, date_to=a.date_to, per_document=a.per_document)
        if a.prompt:
            print(search.context_prompt(a.question, found).first()["prompt"])
        else:
            show(found.select(F.format_string("%.5f", "score").alias("score"), "title", "date", "url", F.translate(F.substring("text", 1, 700), "\n", " ").alias("text")))
    elif a.verb == "derive-plan":
        docs = validated(local.read_jsonl(spark, a.corpus), a.country, a.language).withColumn("pos", F.monotonically_increasing_id())
        show(batches(docs.select("pos", "language", *FIELDS), size=a.size).groupBy("batch").agg(F.count("*").alias("documents"), F.max("batch_chars").alias("characters")).orderBy("batch"))
    elif a.verb == "review":
        n, listed = tei.write_review_list(tei.read(spark, a.root), a.out)
        print(json.dumps({"files": n, "listed": listed}))
    elif a.verb == "audit-newspapers":
        records, errors = harvest.newspaper_sample(spark, a.per_period)
        records = stored(records, "sample")
        report = {**audit.field_report(records), "periods": [f"{lo}-{hi}" for lo, hi in audit.PERIODS], "errors": errors, "important_limitation": audit.LIMITATION}
        Files(spark).write_json(a.report, report)
        records.orderBy("pos").select("item").write.mode("overwrite").text(re.sub(r"(?<=[^/])[.][^./]*$", "", a.report) + "_records.jsonl")
        print(json.dumps({"records": report["records"], "errors": errors}, ensure_ascii=False))
    elif a.verb == "derive":
        docs = validated(local.read_jsonl(spark, a.corpus), a.country, a.language).withColumn("pos", F.monotonically_increasing_id())
        client = responses.Client(a.model, a.instructions, execute=a.execute)
        run = Run(spark, a.run, a.country)
        n = run.execute(docs, Method(a.model, client.run, a.instructions, client.settings()), size=a.size, limit=a.limit, retry=a.retry)
        run.publish(a.out)
        print(json.dumps({"derived": n, "requests": client.log}))
    else:
        docs = local.read_jsonl(spark, a.corpus)
        names = [c for c in docs.columns if c != "id"]
        fields = docs.select(F.col("id").alias("record"), F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.to_json(F.array(F.col(c).cast("string"))) for c in names]))).alias("field", "v"))
        coverage = audit.field_coverage(fields.select("record", "field", F.regexp_replace("v", r"\A\[|\]\z", "").alias("value"))).orderBy("field")
        periods = audit.by_period(docs, earliest_year(F.array(F.coalesce("date", F.lit(""))))).groupBy("period").count().orderBy("period")
        show(coverage)
        show(periods)
        if a.report:
            rows = lambda df: [r.asDict() for r in df.collect()]
            Files(spark).write_json(a.report, {"at": utc_now(), "fields": rows(coverage), "periods": rows(periods)})
    return 0


if __name__ == "__main__":
    sys.exit(main())
