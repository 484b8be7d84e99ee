"""Main text of web pages: flat text blocks, classified by a decision tree that a small labelled table trains.

A scanner cuts a page into flat blocks, the runs of text between block-level tags, and gives each its number of words,
how many of them are linked, and the zone it stands in. Spark then puts these numbers beside those of the blocks before
and after it and applies the tree, one CASE expression, to every block; the blocks that it keeps are the main text.

The tree is grown (CART, Gini) on the blocks of PAGES, small pages in shorthand whose words say whether they belong to the
main text. They hold pages with marked articles, where the zone decides, and pages of bare divisions and tables, where
words and links of a block and its neighbours decide.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, unpacked

#: A comment, a declaration, or a tag with its attributes; quotes count after "=" only. Ends that are missing are at the end of the page.
_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: Elements whose content is raw text up to their end tag, elements without content, and others that show no text of their own.
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("select button svg object audio video canvas datalist".split())
#: Elements that end the block of text before them. All others stand inside a line.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and roles of the article, and of what stands around one.
ARTICLE, ARTICLE_ROLES = frozenset(("article", "main")), frozenset(("main", "article"))
AROUND = frozenset("nav aside footer header form menu dialog search fieldset address".split())
AROUND_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Parts of class names and ids that hint at either; parts after a word of _WITHOUT say what a layout has or hasn't.
CONTENT_HINTS = frozenset("content article post entry story main body text prose".split())
AROUND_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup signin login paywall cta sidebar aside rail widget widgets popular trending"
    " nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer colophon comment comments commentlist respond reply replies disqus discussion related recommended recirculation share sharing social popup modal overlay"
    " pagination pager toolbar copyright legal disclaimer skip".split()
)
#: Of these, what inside an article is its own head, whose headings belong to it.
HEAD_HINTS = frozenset(("header", "masthead"))
_WITHOUT = frozenset("has no not with without".split())
#: What a start tag closes, if that was opened after what comes second.
_CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "tr": (("tr",), ("table",)), **{n: (("dt", "dd"), ("dl",)) for n in ("dt", "dd")}, **{n: (("td", "th"), ("tr", "table")) for n in ("td", "th")}}
_SPOKEN = HEADINGS | frozenset("p article main section table ul ol".split())
AROUND_ZONE, PLAIN, HINTED, MARKED = -1, 0, 1, 2
#: Inside the head of an article: headings stand in the article's zone, all else around it.
HEAD_ZONE = -2
BLOCKS = "array<struct<text:string,words:int,linked:int,zone:int,heading:int>>"
#: What the tree may ask: words and linked words (in thousandths) of the block, its predecessor and its successor (-1: none),
#: how far its zone is below the highest of the page, the zone, and whether it is a heading.
FEATURES = ("words", "words_before", "words_after", "links", "links_before", "links_after", "zone", "below", "heading")

# Pages in shorthand: +5 stands for five words of the main text, -5 for five others.
PAGES = (
    "<html><head><title>x</title></head><body><nav><ul><li><a>-1</a><li><a>-2</a></ul></nav><div class=ad>-8</div><article><h1>+7</h1><p>+60<p>+1<p>+12</p><p><a>+4</a></p><p>+9 <a>+3</a></p></article><footer>-9</footer></body></html>",
    "<body><header><h2>-3</h2><p>-14</p></header><main><h1>+5</h1><p>+45</p><ul><li>+3</li><li><a>+2</a></li></ul><h2>+2</h2><p>+30 <a>+6</a></p><aside><p>-35</p></aside><p>+2</p></main><div>-40</div><footer><p>-12</p><a>-2</a></footer></body>",
    "<body><form><label>-2</label></form><article><p>+25</p><form><p>-9</p></form><blockquote>+18</blockquote><section class=comments><h3>-2</h3><p>-40</p><p>-4</p></section></article><section id=comments><p>-33</p></section></body>",
    "<body><div id=header><a>-2</a><a>-2</a></div><div id=content><h1>+6</h1><p>+50</p><p>+3</p><p>+28</p></div><div id=sidebar><h3>-2</h3><p>-20</p><ul><li><a>-3</a><li><a>-4</a></ul></div><div id=footer>-10</div></body>",
    "<body><div class='cookie-notice'><p>-24</p></div><div class='post has-sidebar'><h2>+8</h2><div>+33</div><div>+1</div><div><a>+5</a></div></div><div>-3</div><div>-30 <a>-2</a></div></body>",
    "<body><div><a>-1</a> <a>-1</a> <a>-2</a></div><div><h1>+6</h1><p>+48</p><p>+35</p><p>+4</p><p>+52</p></div><div><a>-3</a></div><div><a>-5</a></div><div>-6</div></body>",
    "<body><table><tr><td><a>-1</a></td><td><a>-2</a></td></tr><tr><td>+70</td></tr><tr><td>+22</td></tr><tr><td>+40 <a>+3</a></td></tr></table><p><a>-2</a> <a>-2</a></p><p>-5</p></body>",
    "<body><div>-2</div><div><a>-2</a></div><div><a>-3</a></div><h1>+9</h1><p>+26</p><p>+31</p><p>+64</p><p>+17</p><p><a>-4</a></p><p><a>-1</a></p><p>-8</p></body>",
    "<body><p>+40</p><p>+55</p><p>+7</p><p>+38</p></body>",
    "<body>+90</body>",
    "<body>+4</body>",
    "<body><ul><li><a>-2</a><li><a>-3</a><li><a>-2</a><li><a>-6</a></ul><div>-4</div><div><a>-9</a></div></body>",
    "<body><div><a>-4</a> -1</div><div>-3</div><p>+19</p><p>+80</p><p>+15</p><div>-4 <a>-6</a></div><div>-2</div><div><a>-2</a></div></body>",
    "<body><div>-12 <a>-8</a></div><div><a>-2</a></div><h2>+4</h2><p>+36 <a>+5</a></p><h3>+2</h3><p>+41</p><p>+11</p><p>+29</p><h3>-2</h3><ul><li><a>-5</a></li><li><a>-7</a></li></ul></body>",
    "<body><nav>-30</nav><div>-25</div><article><header><h1>+5</h1></header><p>+8</p><p>+1</p></article><div>-60</div><div>-45</div></body>",
    "<body><div>-1</div><div><a>-2</a></div><div><a>-1</a></div><div><h1>+4</h1><p>+57</p><p>+44</p><p>+2</p><p>+39</p></div><div><a>-2</a></div><div><a>-2</a></div><div>-3</div></body>",
    "<body><p>-5</p><ul><li><a>-1</a></li><li><a>-1</a></li></ul><div>+34</div><div>+6</div><div>+21</div><div>+47</div><p>-9 <a>-2</a></p><p>-7</p></body>",
    "<body><h1>+3</h1><p>+28</p><p>+16</p></body>",
    "<body><div>-1</div><div>-2</div><div><a>-3</a></div><div>-1</div></body>",
    "<body><div class=content><article><p>+30</p><p>+3</p><div><a>+4</a></div></article><div>-5 <a>-5</a></div><p>-20</p></div><p>-30</p></body>",
    "<body><aside>-50</aside><aside>-20</aside><footer>-30</footer><div hidden>-30</div></body>",
)


def zone_of(name: str, rest: str, zone: int) -> int:
    """The zone inside an element that stands in `zone`: marked or hinted as the article, its head, plain, or around it (for good)."""
    if zone == AROUND_ZONE or name in ("html", "body"):
        return zone
    article, around, head, hints = name in ARTICLE, name in AROUND and name != "header", name == "header", False
    for m in _ATTRIBUTE.finditer(rest) if rest else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role":
            article, around = article or value.lower() in ARTICLE_ROLES, around or value.lower() in AROUND_ROLES
        elif key == "hidden" and not value.lower().startswith("until"):
            around = True
        elif key == "style":
            around = around or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        elif key in ("class", "id"):
            for token in value.split():
                parts = [x.lower() for x in re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", token)]
                if _WITHOUT.intersection(parts):
                    continue
                # an article names its topics and its parts, so only whole names count there
                found = AROUND_HINTS.intersection([token.lower()] if article else parts)
                around, head = around or not found <= HEAD_HINTS, head or not HEAD_HINTS.isdisjoint(found)
                hints = hints or not CONTENT_HINTS.isdisjoint(parts)
    if around or head and zone == PLAIN:
        return AROUND_ZONE
    if head or zone == HEAD_ZONE:
        return HEAD_ZONE
    return MARKED if article else max(zone, HINTED) if hints else zone


def blocks_of(page: str) -> list[tuple[str, int, int, int, int]]:
    """(text, words, linked words, zone, heading) of the page's flat blocks in order; those without text aren't listed."""
    out: list[tuple[str, int, int, int, int]] = []
    stack: list[tuple[str, int]] = []
    parts: list[tuple[str, bool]] = []
    at, silent, linked, zone = 0, [], False, PLAIN
    opened: Counter[str] = Counter()

    def flush() -> None:
        if parts:
            text = " ".join("".join(x for x, _ in parts).split())
            if text:
                words = text.count(" ") + 1
                links = sum(len(x.split()) for x, own in parts if own)
                heading = any(n in HEADINGS for n, _ in stack[-2:])
                own = zone
                if zone == HEAD_ZONE:
                    own = next((z for _, z in reversed(stack) if z > PLAIN), AROUND_ZONE) if heading else AROUND_ZONE
                out.append((text, words, min(links, words), own, int(heading)))
            parts.clear()

    def say(text: str) -> None:
        if text and not silent:
            parts.append((html.unescape(text) if "&" in text else text, linked))

    def close(k: int) -> None:
        opened.subtract(n for n, _ in stack[k:])
        del stack[k:]

    while m := _TAG.search(page, at):
        say(page[at : m.start()])
        at, name = m.end(), (m["name"] or "").lower()
        if m["end"] is None or name == "":
            continue
        if m["end"]:
            if name in SILENT:
                silent = silent[:-1]
            elif name == "a":
                linked = False
            elif name in BLOCK:
                flush()
                if opened[name] > 0:
                    close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
                    zone = stack[-1][1] if stack else PLAIN
                    linked = False
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name == "br":
            say(" ")
        elif name in SILENT:
            silent = silent if m["rest"].endswith("/") else [*silent, name]
        elif name == "a":
            linked = not m["rest"] or "href" in m["rest"].lower()
        elif name in BLOCK:
            flush()
            if name == "hr":
                continue
            if stack and stack[-1][0] == "p" or stack and stack[-1][0] in HEADINGS and name in HEADINGS:
                close(len(stack) - 1)
            shut, until = _CLOSES.get(name, ((), ()))
            for k in range(len(stack) - 1, -1, -1) if any(opened[n] > 0 for n in shut) else ():
                if stack[k][0] in until:
                    break
                if stack[k][0] in shut:
                    close(k)
                    break
            if name in _SPOKEN and silent and not {"button", "select", "datalist"}.isdisjoint(silent):
                silent = []  # its end tag is missing
            zone = zone_of(name, m["rest"], stack[-1][1] if stack else PLAIN)
            stack.append((name, zone))
            opened[name] += 1
    say(page[at:])
    flush()
    return out


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """The small labelled table: FEATURES and labels of the blocks of PAGES."""
    rows, labels = [], []
    for page in PAGES:
        spelled = re.sub(r"(?<=[>\s])([+-])(\d+)", lambda m: " ".join([m[1] + "w"] * int(m[2])), page)
        found = blocks_of(spelled)
        top = max(b[3] for b in found)
        share = [1000 * b[2] // b[1] for b in found]
        for i, (text, words, _, zone, heading) in enumerate(found):
            near = [(found[k][1], share[k]) if 0 <= k < len(found) else (-1, -1) for k in (i - 1, i + 1)]
            rows.append((words, near[0][0], near[1][0], share[i], near[0][1], near[1][1], zone, top - zone, heading))
            labels.append(text.startswith("+"))
    return np.array(rows), np.array(labels)


@functools.cache
def tree(depth: int = 8) -> tuple:
    """The decision tree: (feature, threshold, tree up to it, tree above it), or (keep,) as a leaf."""
    return _grown(*labelled(), depth)


def _grown(x: np.ndarray, y: np.ndarray, depth: int) -> tuple:
    if depth == 0 or y.all() or not y.any():
        return (bool(2 * y.sum() > len(y)),)
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for t in (values[:-1] + values[1:]) // 2:
            left = x[:, k] <= t
            n, a, b = left.sum(), y[left].sum(), y[~left].sum()
            gini = a * (n - a) / n + b * (len(y) - n - b) / (len(y) - n)
            if best is None or gini < best[0]:
                best = (gini, k, int(t))
    if best is None:
        return (bool(2 * y.sum() > len(y)),)
    left = x[:, best[1]] <= best[2]
    return (FEATURES[best[1]], best[2], _grown(x[left], y[left], depth - 1), _grown(x[~left], y[~left], depth - 1))


def rule(node: tuple, values: dict[str, Column]) -> Column:
    """The tree as a Spark condition on the columns of its features."""
    if len(node) == 1:
        return F.lit(node[0])
    name, most, low, high = node
    return F.when(values[name] <= most, rule(low, values)).otherwise(rule(high, values))


def blocks(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, b): the kept columns of pages (all by default) as one struct, and the page's blocks; a null page has none."""

    @lean("pages")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("words", pa.int32()), ("linked", pa.int32()), ("zone", pa.int32()), ("heading", pa.int32())]))
        for batch in batches:
            size, begin = 0, 0
            for i in range(len(batch)):  # a few MB of pages at a time
                size += len(batch.column(1)[i].as_buffer() or b"")
                if size > 1 << 21 or i == len(batch) - 1:
                    found = [blocks_of(page) for page in batch.column(1).slice(begin, i + 1 - begin).to_pylist()]
                    flat = list(zip(*(b for f in found for b in f), strict=True)) or [()] * 5
                    items = pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip(flat, kind.value_type, strict=True)], fields=list(kind.value_type))
                    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), items)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i + 1 - begin), lists], ["row", "b"])
                    size, begin = 0, i + 1

    names = ["`" + c.replace("`", "``") + "`" for c in (pages.columns if keep is None else keep)]
    own = pages.select(F.struct(*names).alias("row"), F.coalesce(F.col(html_column), F.lit("")).alias("t"))
    schema = T.StructType([own.schema["row"], T.StructField("b", T._parse_datatype_string(BLOCKS))])
    return own.mapInArrow(run, schema)


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The kept columns of pages (all by default) with __text, the main text of the page, and __n_chars, its code points.

    Blocks keep their order and are joined by an empty line. Nothing that a block holds is cut. Null and empty pages, and
    pages of which no block is kept, have an empty text; repeated rows are each answered.
    """
    share = lambda b: F.floor(1000 * b["linked"] / b["words"])
    near = lambda i: F.try_element_at("b", i.cast("int"))

    def kept(b: Column, i: Column) -> Column:
        before, after = F.when(i > 0, near(F.greatest(i, F.lit(1)))), near(i + 2)
        none = F.lit(-1)
        values = {"words": b["words"], "words_before": F.coalesce(before["words"], none), "words_after": F.coalesce(after["words"], none)}
        values |= {"links": share(b), "links_before": F.coalesce(share(before), none), "links_after": F.coalesce(share(after), none)}
        values |= {"zone": b["zone"], "below": F.col("top") - b["zone"], "heading": b["heading"]}
        return rule(tree(), values)

    found = blocks(pages, html_column, keep).withColumn("top", F.coalesce(F.array_max(F.transform("b", lambda b: b["zone"])), F.lit(0)))
    text = F.array_join(F.transform(F.filter("b", kept), lambda b: b["text"]), "\n\n")
    found = found.select("row", text.alias("t"))
    return unpacked(found, __text=F.col("t"), __n_chars=F.length("t").cast("long"))
