"""XML as arrays of elements: one Arrow pass reads a document, Column expressions do the rest.

Spark's XML functions raise on a malformed document where these sources skip it, and read text at fixed depths only. A
document becomes array<struct<nth, name, space, scope, attributes, text>>: the elements that are asked for, in order of
their beginning, with all text inside them. `scope` is the nth of the nearest element around it (or itself) that opens a
scope, -1 if there is none. Attributes of a namespace have its address in braces before their name.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SPACE, clean_text, strip

_S = T.StringType()
ELEMENTS = T.ArrayType(T.StructType([T.StructField("nth", T.IntegerType()), T.StructField("name", _S), T.StructField("space", _S), T.StructField("scope", T.IntegerType()), T.StructField("attributes", T.MapType(_S, _S)), T.StructField("text", _S)]))
_ARROW = pa.list_(pa.struct([("nth", pa.int32()), ("name", pa.string()), ("space", pa.string()), ("scope", pa.int32()), ("attributes", pa.map_(pa.string(), pa.string())), ("text", pa.string())]))
# Namespaces and element names of the formats.
DUBLIN_CORE = "http://purl.org/dc/elements/1.1/"
HREF = "{http://www.w3.org/1999/xlink}href"
TEI_PARAGRAPHS = ("p", "head", "l", "item", "note")
TEI_HEADER = ("publisher", "pubPlace", "language", "wordCount", "pageCount", "defectRate", "finalGrade", "tcp", "stc")


def scan(xml: str | bytes, names: Iterable[str], scopes: Iterable[str] = (), spaces: Iterable[str] = ()) -> list[dict]:
    """The elements of those names (or of those namespaces), and the root's attributes as an element named #root.

    The name #text asks for one more element at the end, all text of the document, its pieces stripped and parted by blanks.
    Raises ET.ParseError if the document is malformed.
    """
    names, scopes, spaces = set(names), set(scopes), set(spaces)
    found: list[dict] = []
    around: list[int] = [-1]  # the scope at each depth
    opened: list[tuple[dict, ET.Element] | None] = []
    for event, node in ET.iterparse(io.BytesIO(xml if isinstance(xml, bytes) else xml.encode()), events=("start", "end")):
        if not isinstance(node.tag, str):
            continue
        space, _, name = node.tag.rpartition("}")
        if event == "start":
            nth = len(found)
            row = None
            if not opened:
                found.append({"nth": 0, "name": "#root", "space": space[1:], "scope": -1, "attributes": list(node.attrib.items()), "text": None})
                nth = 1
            if name in names or space[1:] in spaces:
                row = {"nth": nth, "name": name, "space": space[1:], "scope": nth if name in scopes else around[-1], "attributes": list(node.attrib.items()), "text": None}
                found.append(row)
            around.append(row["scope"] if row else around[-1])
            opened.append((row, node) if row else None)
        else:
            around.pop()
            own = opened.pop()
            if own:
                own[0]["text"] = "".join(node.itertext())
            if not opened and "#text" in names:
                pieces = (v.strip() for v in node.itertext())
                found.append({"nth": len(found), "name": "#text", "space": "", "scope": -1, "attributes": [], "text": " ".join(v for v in pieces if v)})
            elif not opened and found[0]["text"] is None and len(found) == 1:
                found[0]["text"] = " ".join(node.itertext())  # nothing asked for is there: all text
    return found


def elements(df: DataFrame, names: Iterable[str], scopes: Iterable[str] = (), spaces: Iterable[str] = (), *, column: str = "xml", strict: bool = False) -> DataFrame:
    """df with `elements` in place of the column; see scan(). A malformed or null document has null, or raises if strict."""
    keep = [c for c in df.columns if c != column]
    names, scopes, spaces = list(names), list(scopes), list(spaces)
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField("elements", ELEMENTS)])

    def one(xml: str | None) -> list[dict] | None:
        try:
            return scan(xml or "", names, scopes, spaces)
        except ET.ParseError:
            if strict:
                raise
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(x) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(rows, _ARROW)], schema.names)

    return df.select(*keep, column).mapInArrow(run, schema)


def _named(*names: str) -> Column:
    """The elements of a document with one of the names, any case."""
    low = [n.lower() for n in names]
    return F.filter("elements", lambda e: F.lower(e["name"]).isin(*low))


def _texts(found: Column) -> Column:
    """Cleaned texts that aren't empty."""
    return F.filter(F.transform(found, lambda e: clean_text(e["text"])), lambda v: v != "")


def _first(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(1)), F.lit(""))


def parse_oai(pages: DataFrame, column: str = "xml") -> DataFrame:
    """(other columns, oai_identifier, fields, token, nth): a row for each record of a page that isn't deleted.

    fields: texts by name of the Dublin Core elements, in order. A record without a header is none. A page without a
    record gives one row with its token and nth -1. A malformed page fails the query.
    """
    a = elements(pages, ("record", "header", "identifier", "resumptionToken"), ("record",), (DUBLIN_CORE,), column=column, strict=True)
    token = F.coalesce(strip(_first(F.transform(_named("resumptionToken"), lambda e: e["text"]))), F.lit(""))
    # the elements of a record, by the record's place
    inside = lambda r, test: F.filter("elements", lambda e: (e["scope"] == r["nth"]) & test(e))
    head = lambda r: F.try_element_at(inside(r, lambda e: e["name"] == "header"), F.lit(1))
    live = F.filter(_named("record"), lambda r: head(r).isNotNull() & (F.coalesce(F.try_element_at(head(r)["attributes"], F.lit("status")), F.lit("")) != "deleted"))
    identifier = lambda r: _first(F.transform(inside(r, lambda e: (e["name"] == "identifier") & (e["space"] != DUBLIN_CORE)), lambda e: e["text"]))
    core = lambda r: F.filter(F.transform(inside(r, lambda e: e["space"] == DUBLIN_CORE), lambda e: F.struct(e["name"].alias("k"), clean_text(e["text"]).alias("v"))), lambda x: x["v"] != "")
    record = lambda r: F.struct(identifier(r).alias("oai_identifier"), core(r).alias("pairs"))
    names = F.array_distinct(F.transform("x.pairs", lambda p: p["k"]))
    fields = F.map_from_arrays(names, F.transform(names, lambda k: F.transform(F.filter("x.pairs", lambda p: p["k"] == k), lambda p: p["v"])))
    own = [c for c in a.columns if c != "elements"]
    a = a.select(*own, token.alias("token"), F.posexplode_outer(F.transform(live, record)).alias("nth", "x"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    return a.select(*own, F.coalesce("x.oai_identifier", F.lit("")).alias("oai_identifier"), F.when(F.col("x").isNull(), empty).otherwise(fields).alias("fields"), "token", F.coalesce("nth", F.lit(-1)).alias("nth"))


def page_token(xml: str) -> str:
    """The token by which a page names the next one; empty on the last."""
    return next(((e["text"] or "").strip() for e in scan(xml, ("resumptionToken",)) if e["name"] == "resumptionToken"), "")


def parse_alto(pages: DataFrame, column: str = "xml") -> DataFrame:
    """(other columns, text): the words of each line of an OCR page, at any depth. A malformed page fails the query."""
    a = elements(pages, ("TextLine", "String"), ("TextLine",), column=column, strict=True)
    # words come line after line: their line's number is their scope
    word = lambda e: F.coalesce(F.try_element_at(e["attributes"], F.lit("CONTENT")), F.lit(""))
    words = F.filter(F.transform(F.filter("elements", lambda e: (e["name"] == "String") & (e["scope"] >= 0)), lambda e: F.struct(e["scope"].alias("line"), word(e).alias("w"))), lambda x: x["w"] != "")
    own = [c for c in a.columns if c != "elements"]
    a = a.select(*own, words.alias("words"))
    parted = F.transform("words", lambda x, i: F.concat(F.when(i == 0, "").when(x["line"] == F.try_element_at(F.col("words"), i)["line"], " ").otherwise("\n"), x["w"]))
    return a.select(*own, clean_text(F.array_join(parted, "")).alias("text"))


def parse_tei(files: DataFrame, column: str = "xml") -> DataFrame:
    """(other columns, title, date, authors, subjects, text, header) of each well-formed file; malformed ones are skipped.

    The text is that of the paragraphs, nested ones again; of a file without any it is all there is.
    """
    a = elements(files, ("title", "publicationYear", "author", "term", *TEI_HEADER, *TEI_PARAGRAPHS, *(n.upper() for n in TEI_PARAGRAPHS), *(n.capitalize() for n in TEI_PARAGRAPHS)), column=column).where("elements IS NOT NULL")
    exact = lambda name: F.filter("elements", lambda e: e["name"] == name)
    paragraphs = F.filter(F.transform(_named(*TEI_PARAGRAPHS), lambda e: strip(F.regexp_replace(e["text"], rf"(?U){SPACE}+", " "))), lambda v: v != "")
    whole = F.coalesce(F.try_element_at(F.col("elements"), F.lit(1))["text"], F.lit(""))
    header = F.map_from_arrays(F.array(*map(F.lit, TEI_HEADER)), F.array(*[_first(_texts(exact(n))) for n in TEI_HEADER]))
    own = [c for c in a.columns if c != "elements"]
    return a.select(
        *own, _first(_texts(exact("title"))).alias("title"), _first(_texts(exact("publicationYear"))).alias("date"), _texts(exact("author")).alias("authors"),
        F.array_distinct(_texts(exact("term"))).alias("subjects"), clean_text(F.when(F.size(paragraphs) > 0, F.array_join(paragraphs, "\n\n")).otherwise(whole)).alias("text"), header.alias("header"),
    )


def parse_batch(batches: DataFrame, column: str = "xml") -> DataFrame:
    """(other columns, path, lccn, date, edition, nth) of the issues that a batch lists. A malformed list fails the query."""
    a = elements(batches, ("issue",), column=column, strict=True)
    own = [c for c in a.columns if c != "elements"]
    a = a.select(*own, F.explode(F.filter("elements", lambda e: e["name"] == "issue")).alias("e")).withColumn("path", strip(F.col("e.text"))).where("path != ''")
    get = lambda k, d: F.coalesce(F.try_element_at("e.attributes", F.lit(k)), F.lit(d))
    return a.select(*own, "path", get("lccn", "").alias("lccn"), get("issueDate", "").alias("date"), get("editionOrder", "1").alias("edition"), F.col("e.nth").alias("nth"))


def parse_issue(issues: DataFrame, column: str = "xml") -> DataFrame:
    """(other columns, label, pos, href): a row for each OCR file of each well-formed issue; an absent address is empty."""
    a = elements(issues, ("file", "FLocat"), ("file",), column=column).where("elements IS NOT NULL")
    attribute = lambda e, k: F.try_element_at(e["attributes"], F.lit(k))
    ocr = F.filter("elements", lambda e: (e["name"] == "file") & (attribute(e, "USE") == "ocr"))
    place = lambda f: F.try_element_at(F.filter("elements", lambda e: (e["name"] == "FLocat") & (e["scope"] == f["nth"])), F.lit(1))
    own = [c for c in a.columns if c != "elements"]
    label = attribute(F.try_element_at(F.col("elements"), F.lit(1)), "LABEL")
    return a.select(*own, label.alias("label"), F.posexplode(F.transform(ocr, lambda f: F.coalesce(attribute(place(f), HREF), F.lit("")))).alias("pos", "href"))
