"""Text functions as Columns: cleaning, years, ids, terms and small string rules. All stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, with U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"
# Scripts without spaces between words, words, and years.
UNSPACED = r"[\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7af}]"
WORD = r"[\p{L}\p{N}]+"
YEAR = r"\b(1[5-9]\d{2}|20\d{2})\b"
ANY_YEAR = r"\b(1[0-9]{3}|20[0-9]{2})\b"


def strip(x: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(x, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def clean_text(x: Column) -> Column:
    """Line ends to LF, hyphens at line ends joined, runs of blanks and of empty lines shortened, ends stripped."""
    x = F.regexp_replace(x, r"\r\n?", "\n")
    x = F.regexp_replace(x, r"(?U)(?<=\w)-\n(?=\w)", "")
    x = F.regexp_replace(x, r"[ \t]+", " ")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def stable_id(*parts: Column) -> Column:
    """24 hex digits of the SHA-256 of the parts joined by U+001F; a null part is empty."""
    joined = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, 24)


def first_year(x: Column) -> Column:
    """The first year from 1500 to 2099 in a text, or null."""
    return F.nullif(F.regexp_extract(x, "(?U)" + YEAR, 1), F.lit("")).cast("int")


def earliest_year(values: Column) -> Column:
    """The least year from 1000 to 2099 over an array of texts, or null."""
    found = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit("(?U)" + ANY_YEAR), F.lit(1))))
    return F.array_min(F.transform(found, lambda y: y.cast("int")))


def words(x: Column) -> Column:
    """White-space-separated words."""
    return F.filter(F.split(x, rf"(?U){SPACE}+"), lambda w: w != "")


def terms(x: Column) -> Column:
    """Runs of letters and digits, case kept."""
    return F.regexp_extract_all(x, F.lit(WORD), F.lit(0))


def bigrams(x: Column) -> Column:
    """All pairs of neighbouring characters."""
    n = F.length(x)
    none = F.array().cast("array<string>")
    return F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(2)))).otherwise(none)


def search_terms(x: Column) -> Column:
    """terms(x); of unspaced scripts also each character and pair of characters. Distinct, in order."""

    def more(t: Column) -> Column:
        letters = F.filter(F.split(t, ""), lambda c: c != "")
        return F.when(t.rlike(UNSPACED), F.concat(F.array(t), letters, bigrams(t))).otherwise(F.array(t))

    return F.array_distinct(F.flatten(F.transform(terms(x), more)))


def _fold_table() -> tuple[str, str]:
    """Code points whose lower case decomposes to a Latin letter with marks, and that letter."""
    a, b = [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        if not c.isalpha():
            continue
        low = "i" if c == "İ" else c.lower()
        base = unicodedata.normalize("NFD", low)[:1]
        if "a" <= base <= "z" and len(low) == 1 and (low != base or c != low):
            a.append(c)
            b.append(base)
    return "".join(a), "".join(b)


_FROM, _TO = _fold_table()


def folded(x: Column) -> Column:
    """Lower case, and Latin letters without their marks; other scripts keep theirs."""
    return F.lower(F.translate(x, _FROM, _TO))


def index_tokens(x: Column) -> Column:
    """Tokens of the lexical index: folded runs of letters and digits."""
    return terms(folded(x))


def paragraphs(x: Column) -> Column:
    """Texts between blank lines, stripped, without empty ones."""
    parts = F.split(x, r"\n(?U:[\s\x1c-\x1f])*\n")
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def first_value(values: Column, default: str = "") -> Column:
    """The first element of an array as text; the default if it is null or empty."""
    return F.coalesce(F.try_element_at(values, F.lit(1)).cast("string"), F.lit(default))


def present_values(values: Column) -> Column:
    """Elements as text, without nulls and blanks."""
    return F.filter(F.transform(values, lambda v: v.cast("string")), lambda v: v.isNotNull() & (strip(v) != ""))


def text_url(identifiers: Column, relations: Column) -> Column:
    """The first address that ends in .txt or .text before any query; empty if none does."""
    both = F.concat(F.coalesce(identifiers, F.array()), F.coalesce(relations, F.array()))
    fit = F.filter(both, lambda v: F.substring_index(F.lower(v), "?", 1).rlike(r"\.(txt|text)\z"))
    return F.coalesce(F.try_element_at(fit, F.lit(1)), F.lit(""))


def last_segment(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1)


def with_scheme(url: Column) -> Column:
    """//host/... and host/... with https; http stays."""
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).otherwise(url)


def class_prefix(call_number: Column) -> Column:
    """One to three leading letters of a shelf mark, upper case; empty if there are none."""
    return F.upper(F.regexp_extract(call_number, r"(?U)\A\s*([A-Za-z]{1,3})", 1))


def model_prefixes(model: Column) -> Column:
    """struct<query, document>: what retrieval models want before a query and a passage."""
    # Names of models and their prefixes.
    low = F.lower(model)
    e5 = low.rlike(r"(?:^|[/_-])(?:multilingual-)?e5(?:$|[/_-])")
    bge = low == "baai/bge-small-en-v1.5"
    q = F.when(e5, "query: ").when(bge, "Represent this sentence for searching relevant passages: ").otherwise("")
    return F.struct(q.alias("query"), F.when(e5, "passage: ").otherwise("").alias("document"))


def canonical_json(**fields: Column) -> Column:
    """A JSON object of texts with sorted keys and no blanks; a null is the empty text."""
    return F.to_json(F.struct(*[F.coalesce(fields[k], F.lit("")).alias(k) for k in sorted(fields)]))
