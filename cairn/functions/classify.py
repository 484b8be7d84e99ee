"""Rules on metadata and text as Columns: struct<status, confidence, reasons> decisions and the rights predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabularies and patterns of the rules.
FICTION_TERMS = ("drama", "fairy tales", "fiction", "juvenile fiction", "novel", "novels", "plays", "poems", "poetry", "romance", "romances", "short stories")
NONFICTION_TERMS = (
    "agriculture", "autobiography", "biography", "cookery", "correspondence", "description and travel", "diaries", "domestic economy", "education",
    "handbooks, manuals, etc", "history", "labor", "law", "medicine", "personal narratives", "politics and government", "public health", "religion",
    "reports", "sermons", "slavery", "social conditions", "social life and customs", "statistics", "trials", "working class",
)
FICTION_TITLES = (r"\ba novel\b", r"\ba romance\b", r"\bnovel\b", r"\bpoems?\b", r"\bshort stories\b", r"\bfairy tales\b", r"\ba play in\b")
NONFICTION_TITLES = (
    r"\breport of\b", r"\bannual report\b", r"\bproceedings of\b", r"\btestimony\b", r"\bhearing(?:s)?\b", r"\bhistory of\b", r"\bautobiograph",
    r"\bmemoir", r"\brecollections?\b", r"\bjournal of\b", r"\bletters? of\b", r"\bmanual of\b", r"\bhandbook\b", r"\bguide to\b", r"\bsermon",
    r"\baddress(?:es)?\b", r"\bconstitution\b", r"\bby-laws\b",
)
NONFICTION_CLASSES = ("A", "B", "C", "D", "E", "F", "G", "H", "J", "K", "L", "M", "N", "Q", "R", "S", "T", "U", "V", "Z")
REVIEW_TERMS = ("ballad", "drama", "elegy", "fiction", "hymn", "hymns", "novel", "play", "poems", "poetry", "psalm", "psalms", "romance", "song", "songs", "verse")
LITERARY_TERMS = ("drama", "fiction", "juvenile fiction", "literary periodicals", "novel", "novels", "plays", "poems", "poetry", "short stories")
LITERARY_TITLES = (r"\bliterary (?:magazine|journal|gazette|review)\b", r"\bfiction (?:magazine|weekly)\b", r"\bstory paper\b")
STRONG_MARKS = (
    r"(?im)^\s*chapter\s+(?:[ivxlcdm]+|\d+)\b", r"(?i)\bto be continued\b", r"(?i)\bcontinued in (?:our|the) next\b",
    r"(?i)\b(?:our|a|the) new serial (?:story|novel)\b", r"(?i)\bserial (?:story|romance|novel)\b", r"(?i)\ba thrilling romance\b",
)
WEAK_MARKS = (
    r"(?i)\bcontinued from (?:yesterday|last week|page \w+)\b", r"(?im)^\s*(?:poetry|selected verse|a poem)\s*$",
    r"(?i)\binstallment of (?:our|the|this) (?:story|novel|romance)\b", r"(?i)\bcopyright(?:ed)?[, ]+\d{4}.*?by\b",
)
GRANTS = (
    r"\bpublic[ -]domain\b", r"\bdominio p[uú]blico\b", r"\bdom[ií]nio p[uú]blico\b", r"\bdomaine public\b", r"\bgemeinfrei\b", r"保護期間満了", r"저작권 만료",
    r"creativecommons\.org/publicdomain/(?:zero|mark)", r"\bcc0(?:[ -]?1\.0)?\b", r"\bpublic domain mark\b", r"\bpdm\b", r"creativecommons\.org/licenses/by(?:-sa)?/",
    r"\bcc[ -]by(?:[ -]sa)?\b", r"\bopen parliament licence\b", r"\bopendatacommons\.org/licenses/pddl\b", r"\bpddl\b", r"\bno known copyright restrictions?\b", r"\bno restrictions?\b",
)
REFUSALS = (
    r"\bnot (?:in )?(?:the )?public[ -]domain\b", r"\bpublic[ -]domain (?:status )?(?:unknown|unavailable|not established)\b",
    r"\blicen[cs](?:e|ing) (?:unknown|unavailable|not available)\b", r"\bno derivatives?\b", r"\bno-derivatives?\b", r"\bby-nd\b", r"\bby-nc-nd\b", r"creativecommons\.org/licenses/by-(?:nc-)?nd/",
)


def contained(text: Column, terms: tuple[str, ...]) -> Column:
    """Those of the terms that the text contains, anywhere, in order of the list."""
    return F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(text, t))


def matching(text: Column, patterns: tuple[str, ...], flags: str = "(?iU)") -> Column:
    """Those of the patterns that the text matches, in order."""
    tests = [F.when(text.rlike(flags + p), F.lit(p)) for p in patterns]
    return F.filter(F.array(*tests), lambda p: p.isNotNull())


def _listed(label: str, hits: Column) -> Column:
    one = F.array(F.concat(F.lit(label), F.array_join(hits, ", ")))
    return F.when(F.size(hits) > 0, one).otherwise(F.array().cast("array<string>"))


def _each(label: str, hits: Column) -> Column:
    return F.transform(hits, lambda p: F.concat(F.lit(label), p))


def decision(status: Column, confidence: Column, reasons: Column) -> Column:
    return F.struct(status.alias("status"), confidence.alias("confidence"), reasons.alias("reasons"))


def joined_lower(values: Column) -> Column:
    return F.lower(F.array_join(F.coalesce(values, F.array()), " | "))


# The reasons that decisions give.
CLASS_FICTION, CLASS_OTHER = "fiction-heavy LC class: PZ", "nonfiction LC class: "
FICTION_SUBJECT, FICTION_TITLE = "fiction subject: ", "fiction title pattern: "
OTHER_SUBJECT, OTHER_TITLE = "nonfiction subject: ", "nonfiction title pattern: "
NO_BOOK_SIGN = "no decisive subject, title, or LC-class signal"
REVIEW_SUBJECT, REVIEW_TITLE = "subject contains '{}'", "title contains '{}'"
LITERARY_SUBJECT, LITERARY_TITLE = "literary subject: ", "literary publication-title pattern: "
NEWSPAPER_SIGN, NO_NEWSPAPER_SIGN = "LOC genre/format identifies a newspaper", "record lacks a decisive newspaper genre/format"
SERIAL_MARK, NO_SERIAL_MARK = "OCR pattern: ", "no decisive serialized-fiction or poetry markers"


def book_decision(title: Column, subjects: Column, call_numbers: Column) -> Column:
    """fiction, nonfiction or uncertain; signs of fiction win. Terms count anywhere in the joined subjects."""
    from .text import class_prefix

    title, subject = F.coalesce(title, F.lit("")), joined_lower(subjects)
    prefixes = F.filter(F.transform(F.coalesce(call_numbers, F.array()), class_prefix), lambda p: p != "")
    pz = F.when(F.exists(prefixes, lambda p: p.startswith("PZ")), F.array(F.lit(CLASS_FICTION))).otherwise(F.array().cast("array<string>"))
    fiction = F.concat(_listed(FICTION_SUBJECT, contained(subject, FICTION_TERMS)), _each(FICTION_TITLE, matching(title, FICTION_TITLES)), pz)
    documentary = F.exists(prefixes, lambda p: F.substring(p, 1, 1).isin(*NONFICTION_CLASSES))
    classes = F.when(documentary, F.array(F.concat(F.lit(CLASS_OTHER), F.array_join(prefixes, ", ")))).otherwise(F.array().cast("array<string>"))
    other = F.concat(_listed(OTHER_SUBJECT, contained(subject, NONFICTION_TERMS)), _each(OTHER_TITLE, matching(title, NONFICTION_TITLES)), classes)
    none = F.array(F.lit(NO_BOOK_SIGN))
    return (
        F.when(F.size(fiction) > 0, decision(F.lit("fiction"), F.lit("high"), fiction))
        .when(F.size(other) > 0, decision(F.lit("nonfiction"), F.lit("high"), other))
        .otherwise(decision(F.lit("uncertain"), F.lit("low"), none))
    )


def review_reasons(title: Column, subjects: Column) -> Column:
    """Why a text needs a look: a term anywhere in the subjects, or else as a word of the title; by term."""
    low, subject = F.lower(F.coalesce(title, F.lit(""))), joined_lower(subjects)
    tests = [
        F.when(F.contains(subject, F.lit(t)), F.lit(REVIEW_SUBJECT.format(t))).when(low.rlike(rf"(?U)\b{t}\b"), F.lit(REVIEW_TITLE.format(t)))
        for t in REVIEW_TERMS
    ]
    return F.filter(F.array(*tests), lambda r: r.isNotNull())


def periodical_decision(title: Column, subjects: Column, genres: Column, formats: Column) -> Column:
    """literary, newspaper or uncertain; literary signs win."""
    hits = F.concat(_listed(LITERARY_SUBJECT, contained(joined_lower(subjects), LITERARY_TERMS)), _each(LITERARY_TITLE, matching(F.coalesce(title, F.lit("")), LITERARY_TITLES)))
    both = F.concat(F.coalesce(genres, F.array()), F.coalesce(formats, F.array()))
    paper = F.exists(both, lambda v: F.contains(F.lower(v), F.lit("newspaper")))
    return (
        F.when(F.size(hits) > 0, decision(F.lit("literary"), F.lit("high"), hits))
        .when(paper, decision(F.lit("newspaper"), F.lit("high"), F.array(F.lit(NEWSPAPER_SIGN))))
        .otherwise(decision(F.lit("uncertain"), F.lit("low"), F.array(F.lit(NO_NEWSPAPER_SIGN))))
    )


def serial_decision(text: Column) -> Column:
    """literary (one strong mark or two weak ones) or retain, for a piece of newspaper text."""
    # the d flag: line anchors know only LF
    strong, weak = matching(text, STRONG_MARKS, "(?dU)"), matching(text, WEAK_MARKS, "(?dU)")
    literary = (F.size(strong) > 0) | (F.size(weak) >= 2)
    sure = F.when(F.size(strong) > 0, F.lit("high")).otherwise(F.lit("medium"))
    return F.when(literary, decision(F.lit("literary"), sure, _each(SERIAL_MARK, F.concat(strong, weak)))).otherwise(
        decision(F.lit("retain"), F.lit("medium"), F.array(F.lit(NO_SERIAL_MARK)))
    )


def rights_eligible(rights: Column) -> Column:
    """True for an affirmative grant without a refusal; null and blank are false."""
    from .text import SPACE, strip

    x = strip(F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(rights, F.lit("")), "ß", "ss")), rf"(?U){SPACE}+", " "))
    refused = F.lit(False)
    for p in REFUSALS:
        refused = refused | x.rlike("(?U)" + p)
    granted = F.lit(False)
    for p in GRANTS:
        granted = granted | x.rlike("(?U)" + p)
    return ~refused & granted
