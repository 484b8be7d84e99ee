"""Values of nested catalogue records (JSON text), whatever shape they have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# The keys of a catalogue record that hold each kind of value.
KEYS = {
    "subjects": ("subject", "subjects", "subject_headings"),
    "call_numbers": ("call_number",),
    "formats": ("format", "original_format", "type"),
    "descriptions": ("description", "notes"),
    "contributors": ("contributor", "contributors", "contributor_names"),
    "languages": ("language", "languages"),
    "locations": ("location", "locations", "place_of_publication"),
}
#: Tokens of JSON text: texts, brackets and colons, other values.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{}:]|[^\s,:\[\]{}"]++'


def strings_in(text: Column) -> Column:
    """array<string> of JSON text: a text itself, the keys of an object in their order, those of all parts of a list at any
    depth, True and False, else its JSON; null has none.

    One fold over the tokens; what an object holds besides its keys is passed over by counting brackets.
    """
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    near = F.transform(tokens, lambda t, i: F.struct(t.alias("t"), (F.coalesce(F.try_element_at(tokens, i + 2), F.lit("")) == ":").alias("key")))
    plain = lambda t: F.get_json_object(F.concat(F.lit("["), t, F.lit("]")), "$[0]")
    start = F.struct(F.lit(0).alias("d"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        t, d = x["t"], s["d"]
        opens, closes = t.isin("{", "["), t.isin("}", "]")
        depth = F.when(d == 0, F.when(t == "{", 1).otherwise(0)).otherwise(d + opens.cast("int") - closes.cast("int"))
        quoted = t.startswith('"')
        value = F.when(quoted & ((d == 0) | ((d == 1) & x["key"])), plain(t)).when((d == 0) & ~quoted & ~opens & ~closes & (t != "null"), F.when(t == "true", "True").when(t == "false", "False").otherwise(t))
        return F.struct(depth.alias("d"), F.when(value.isNotNull(), F.array_append(s["out"], value)).otherwise(s["out"]).alias("out"))

    return F.coalesce(F.aggregate(near, start, step, lambda s: s["out"]), F.array().cast("array<string>"))


def strings(value: Column) -> Column:
    """strings_in() of a variant, which knows its keys in alphabetical order only."""
    return strings_in(F.to_json(value))


def both_levels(record: Column, *keys: str) -> Column:
    """Distinct stripped values of the keys, each first in the record itself and then in its nested `item`; blanks are left out."""
    parsed = F.try_parse_json(record)

    def at(path: str) -> Column:
        """Lists and objects from their text, which has keys in order; a text would lose its quotes there."""
        value = F.try_variant_get(parsed, path, "variant")
        kind = F.schema_of_variant(value)
        return F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), strings_in(F.get_json_object(record, path))).otherwise(strings(value))

    found = F.concat(*[at(path) for k in keys for path in (f"$.{k}", f"$.item.{k}")])
    return F.array_distinct(F.filter(F.transform(found, strip), lambda v: v != ""))


def catalogue_fields(record: Column) -> Column:
    """struct of KEYS: the values of a record (JSON text). A null or malformed record has none."""
    return F.struct(*[both_levels(record, *keys).alias(name) for name, keys in KEYS.items()])
