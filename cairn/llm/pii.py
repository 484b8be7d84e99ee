"""Personal data: fixed patterns plus information-theoretic sanitisation, with DataFrame functions only.

A protected entity is a value that the patterns find. A term discloses the entity if the pointwise mutual information
of both over the corpus, as a share of the entity's information content, reaches a threshold:

    PMI(t; e) = log2(N * n(t, e) / (n(t) * n(e))),  IC(e) = log2(N / n(e)),  disclosed if PMI >= alpha * IC

n counts documents: n(t) those with the word, n(t, e) those with both, wherever they stand. Every occurrence of a
disclosing term becomes a span of kind `term` in the documents that hold the entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import outside, packed, regex_spans, running_max, stored, unpacked

# The base patterns, written so that no input makes them backtrack. A run is entered at its start (or
# where the last match ended), which finds the same leftmost matches.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_FITS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"
CARD = r"[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-])*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")

#: Share of the entity's information content beyond which a term discloses it.
ALPHA = 0.9
#: Documents that hold both at least.
SUPPORT = 3


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(x: str) -> str:
    d = "cast(substring(d, length(d) - i, 1) as int)"
    total = f"aggregate(sequence(0, length(d) - 1), 0, (a, i) -> a + CASE WHEN i % 2 = 0 THEN {d} WHEN {d} > 4 THEN 2 * {d} - 9 ELSE 2 * {d} END)"
    return f"exists(array({_digits(x)}), d -> length(d) BETWEEN 14 AND 19 AND {total} % 10 = 0)"


#: Words of the corpus statistics: runs of letters and digits that begin with a letter.
TERM = r"\p{L}[\p{L}\p{N}]*"


def scan(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, key, base, terms): the kept columns of docs as a struct, a hash of the text, its base spans as
    array<struct<s,rank,kind,e,m>> in order, and, where there are any, the words outside them as array<struct<s,e,m>>, m a
    hash of the lower-cased word. A null or empty text has none.

    A caller that counts and finds on the same documents writes this table once, without the text.
    """
    empty = "cast(array() as array<struct<s:int,e:int,m:string>>)"
    a = packed(docs, keep).select(
        "row",
        "t",
        F.expr(f"CASE WHEN contains(t, '@') THEN {regex_spans('t', EMAIL)} ELSE {empty} END").alias("email"),
        F.expr(f"CASE WHEN t rlike '[0-9][.][0-9]' THEN filter({regex_spans('t', IP)}, x -> x.m rlike r'{IP_FITS}') ELSE {empty} END").alias("ip"),
        F.expr(f"CASE WHEN t rlike '[0-9]{{2}}|[0-9][ -][0-9]' THEN filter({regex_spans('t', CARD)}, x -> length(x.m) >= 14 AND {_luhn('x.m')}) ELSE {empty} END").alias("card"),
        F.expr(f"CASE WHEN contains(t, '+') THEN filter({regex_spans('t', PHONE)}, x -> length({_digits('x.m')}) BETWEEN 10 AND 15) ELSE {empty} END").alias("phone"),
    )
    part = lambda k, r: f"transform({k}, x -> struct(x.s AS s, {r} AS rank, '{k}' AS kind, x.e AS e, x.m AS m))"
    a = a.select("row", "t", F.expr("array_sort(concat(" + ", ".join(part(k, r) for r, k in enumerate(KINDS[:4])) + "))").alias("base"))
    words = f"transform({regex_spans('t', TERM)}, x -> struct(x.s AS s, x.e AS e, xxhash64(lower(x.m)) AS m))"
    free = f"transform(array(struct({words} AS w, base AS b)), c -> {outside('c.w', 'c.b', 'bigint')})[0]"
    none = "cast(array() as array<struct<s:int,e:int,m:bigint>>)"
    return a.select("row", F.xxhash64("t").alias("key"), "base", F.expr(f"CASE WHEN size(base) > 0 THEN {free} ELSE {none} END").alias("terms"))


def _texts(scanned: DataFrame) -> DataFrame:
    """(key, m, own, entities): each text with an entity once, its number of rows, its distinct words and entities."""
    a = scanned.where("size(base) > 0").selectExpr("key", "array_distinct(transform(terms, x -> x.m)) AS own", "array_distinct(transform(base, x -> xxhash64(x.m))) AS entities")
    return a.groupBy("key").agg(F.count("*").alias("m"), F.first("own").alias("own"), F.first("entities").alias("entities"))


def _grouped(held: DataFrame, value: str, support: int) -> DataFrame:
    """(value, n, class): the values that `support` rows hold. held: (key, m, value). Values of equal sets of texts have one
    class, a hash of the number of rows and of two sums over the texts."""
    sums = held.groupBy(value).agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.pmod(F.xxhash64("key"), F.lit(2147483647))).alias("s"), F.bit_xor(F.xxhash64("key", F.lit("x"))).alias("x"))
    return sums.where(F.col("n") >= support).select(value, "n", F.xxhash64("n", "s", "x").alias(f"{value}_class"))


def disclosing(docs: DataFrame, *, alpha: float = ALPHA, support: int = SUPPORT, scanned: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(terms, members): the terms that disclose the entities of a class, and the entities of each class.

    terms: (entity_class, term, n_both, n_term, n_entity, pmi); members: (entity, entity_class). Counts are over all rows
    of docs. Only sets of texts matter to them, so entities that the same texts hold are one class, and so are terms: a
    contact list of n addresses and n words that stands in several documents makes one pair, not n * n. Pairs are counted
    only for entities and terms that `support` rows hold. Entities and terms are 64-bit hashes (xxhash64) of the value and
    of the lower-cased word. Terms may have any length and never lie inside an entity. Copies count as documents. An empty
    table discloses nothing. scanned: scan() of the same documents, if it is there already.
    """
    texts = stored(_texts(scan(docs, ()) if scanned is None else scanned), "entity-texts")
    # the lists come first, as what stands beside a generator is computed for each row that it makes
    held = texts.selectExpr("key", "m", "explode_outer(entities) AS entity").where("entity IS NOT NULL")
    members = stored(_grouped(held, "entity", support), "entity-classes")
    classes = held.join(members, "entity").select("key", "m", "entity_class").distinct()
    near = texts.join(classes.select("key").distinct(), "key", "left_semi").selectExpr("key", "m", "explode_outer(own) AS term").where("term IS NOT NULL")
    terms = stored(_grouped(near, "term", support), "term-classes")
    both = classes.join(near.join(terms, "term").select("key", "term_class").distinct(), "key").groupBy("entity_class", "term_class").agg(F.sum("m").alias("n_both")).where(F.col("n_both") >= support)
    words = docs.selectExpr(f"explode_outer(array_distinct(transform(regexp_extract_all(lower(text), r'{TERM}', 0), w -> xxhash64(w)))) AS term").where("term IS NOT NULL")
    counts = words.groupBy("term").agg(F.count("*").alias("n_term"))
    total = float(max(1, docs.count()))
    sizes = members.groupBy("entity_class").agg(F.first("n").alias("n_entity"))
    out = both.join(terms.select("term", "term_class"), "term_class").join(counts, "term").join(sizes, "entity_class")
    out = out.withColumn("pmi", F.log2(F.lit(total) * F.col("n_both") / (F.col("n_term") * F.col("n_entity"))))
    kept = (F.col("pmi") > 0) & (F.col("pmi") >= F.lit(alpha) * F.log2(F.lit(total) / F.col("n_entity")))
    return out.where(kept).select("entity_class", "term", "n_both", "n_term", "n_entity", "pmi"), members.select("entity", "entity_class")


def disclosures(docs: DataFrame, *, alpha: float = ALPHA, support: int = SUPPORT, scanned: DataFrame | None = None) -> DataFrame:
    """(entity, term, n_both, n_term, n_entity, pmi): disclosing() with a row for each entity of a class, for reports; the
    rows grow with entities times terms, so find() takes disclosing() itself as well."""
    terms, members = disclosing(docs, alpha=alpha, support=support, scanned=scanned)
    return members.join(terms, "entity_class").select("entity", "term", "n_both", "n_term", "n_entity", "pmi")


def find(docs: DataFrame, disclosed: DataFrame | tuple[DataFrame, DataFrame], *, scanned: DataFrame | None = None) -> DataFrame:
    """docs with __personal: array<struct<s,rank,kind,e,m>> by start, then kind as listed.

    Base spans always stay; spans of kind `term` are all occurrences of the words that disclose an entity of the same
    text. Positions are code points, ends exclusive. A null or empty text has no spans; repeated rows keep their own.
    A column of docs named __personal gives way. disclosed: disclosing() or disclosures(). scanned: scan() of the same
    documents, whose kept columns then come out.
    """
    a = scan(docs) if scanned is None else scanned
    if isinstance(disclosed, DataFrame):
        disclosed = disclosed.select(F.col("entity").alias("entity_class"), "term"), disclosed.select("entity", F.col("entity").alias("entity_class")).distinct()
    known, members = disclosed[0].select("entity_class", "term"), disclosed[1]
    # texts without an entity that anything discloses send no terms
    texts = _texts(a)
    telling = members.join(known.select("entity_class").distinct(), "entity_class", "left_semi")
    classes = texts.selectExpr("key", "explode_outer(entities) AS entity").where("entity IS NOT NULL").join(telling, "entity").select("key", "entity_class").distinct()
    pairs = texts.select("key", "own").join(classes, "key").selectExpr("key", "entity_class", "explode_outer(own) AS term").where("term IS NOT NULL")
    hits = pairs.join(known, ["entity_class", "term"]).groupBy("key").agg(F.collect_set("term").alias("hits"))
    a = a.join(hits, "key", "left")
    # in order of hash, a word is a hit if the last hit at or before it has its hash
    merged = "array_sort(concat(transform(hits, x -> struct(x AS h, 0 AS k, 0 AS s, 0 AS e)), transform(terms, x -> struct(x.m AS h, 1 AS k, x.s AS s, x.e AS e))))"
    lowest = "cast(-9223372036854775808 as bigint)"
    last = running_max(f"transform(l, x -> if(x.k = 0, x.h, {lowest}))", lowest)
    own = f"transform(array({merged}), l -> transform(array({last}), g -> filter(transform(l, (x, i) -> struct(x AS x, g[i] AS g)), z -> z.x.k = 1 AND z.g = z.x.h))[0])[0]"
    terms = f"transform({own}, z -> struct(z.x.s AS s, 4 AS rank, 'term' AS kind, z.x.e AS e, cast(null as string) AS m))"
    return unpacked(a, __personal=F.expr(f"CASE WHEN hits IS NULL THEN base ELSE array_sort(concat(base, {terms})) END"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the hash of the base spans and all spans as text: a row for each of find()'s.

    A row without spans has zeros, the hash of the empty text and an empty text; a null doc_id stays null.
    """
    text = lambda l: f"array_join(transform({l}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(__personal, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:4]],
        F.expr(f"sha2({text('filter(__personal, x -> x.rank < 4)')}, 256)").alias("base_sha256"),
        F.expr(text("__personal")).alias("spans"),
        F.expr("cast(size(filter(__personal, x -> x.kind = 'term')) as bigint)").alias("n_term"),
        F.expr("cast(size(__personal) as bigint)").alias("n_spans"),
    )


def sanitised(found: DataFrame) -> DataFrame:
    """The texts with entities removed (their kind stays in brackets) and disclosing terms generalised to [WORD].

    Overlapping spans are replaced as one. Other columns stay, null texts stay null.
    """
    own = [c for c in found.columns if c != "__personal"]
    fill = "CASE WHEN x.kind = 'term' THEN '[WORD]' ELSE concat('[', upper(x.kind), ']') END"
    step = f"named_struct('out', CASE WHEN x.s >= a.at THEN concat(a.out, substring(coalesce(text, ''), a.at + 1, x.s - a.at), {fill}) ELSE a.out END, 'at', greatest(a.at, x.e))"
    body = f"aggregate(__personal, named_struct('out', '', 'at', 0), (a, x) -> {step}, a -> concat(a.out, substring(text, a.at + 1)))"
    return found.select(*[F.expr(body).alias("text") if c == "text" else F.col(c) for c in own])
