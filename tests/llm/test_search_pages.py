import html
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cairn.llm import negatives, pages, ranked
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_ranks(docs, items, top=20):
    """(item row, rank, doc_id, score), every document scored for every item."""
    held = [(i, k, Counter(WORD.findall((t or "").translate(LOWER)))) for k, (i, t) in enumerate(docs)]
    held = [x for x in held if x[2]]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, _, c in held)
    df = Counter(t for _, _, c in held for t in c)
    out = []
    for q, (_, text) in enumerate(items):
        own = Counter(WORD.findall((text or "").translate(LOWER)))
        scored = []
        for i, k, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, x in own.items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, k, i))
        out += [(q, r + 1, x[4], -x[0]) for r, x in enumerate(sorted(scored)[:top])]
    return out


def ranks(spark, docs, items, top=20, tier_rows=None, log=None):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(items)], "item_id bigint, text string")
    asked = ranked.scan(i, "item_id").withColumn("q", F.monotonically_increasing_id())
    asked = ranked.stored(asked, "asked")
    index = ranked.build(d, wanted=ranked.wanted_terms(asked), top=top, tier_rows=tier_rows or ranked.TIER_ROWS)
    return [(r["item"], r["rank"], r["id"], r["score"]) for r in ranked.search(index, asked, log).orderBy("item", "rank").collect()], index


def test_tiers_give_what_scoring_all_documents_gives(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    zipf = [1 / (k + 1) for k in range(300)]
    docs = [(k, " ".join(rng.choices(words, zipf, k=rng.choice([3, 20, 60, 400])))) for k in range(600)]
    items = [(k, " ".join(rng.choices(words, zipf, k=rng.choice([1, 2, 12, 40])))) for k in range(25)]
    log = []
    got, index = ranks(spark, docs, items, top=5, tier_rows=8, log=log)
    assert got == brute_ranks(docs, items, 5)
    assert index.tiers >= 3 and len(log) >= 2 and 0 < log[0]["proven"] < log[0]["open"]  # some items fall through
    held = {(r.term): (r.df, r.rest) for r in index.terms.collect()}
    counts = {(r.term, r.tier): (r.n, r.high) for r in index.postings.groupBy("term", "tier").agg(F.count("*").alias("n"), F.max("impact").alias("high")).collect()}
    for term, (df, rest) in held.items():
        assert sum(n for (t, _), (n, _) in counts.items() if t == term) <= df
        for k in range(index.tiers):
            assert rest[k] == max([h for (t, i), (_, h) in counts.items() if t == term and i > k], default=0)
    assert log[-1]["postings"] < sum(len(set(WORD.findall(t))) for _, t in items) * 600


def test_ranked_search_of_awkward_rows(spark):
    same = "alpha beta beta gamma"
    docs = [(None, same), (7, same), (7, same), (3, same.upper()), (1, None), (2, ""), (4, "... !"), (5, "É é ALPHA İ"), (6, "alpha " * 400_000 + "x" * 3_000_000 + " beta"), *[(100 + k, same) for k in range(40)]]
    items = [(0, "Alpha alpha beta"), (1, None), (2, "nothing here"), (3, "É"), (4, ""), (5, "alpha beta")]
    got, _ = ranks(spark, docs, items)
    assert got == brute_ranks(docs, items)
    assert ranks(spark, [], items)[0] == [] and ranks(spark, docs, [])[0] == []
    many = [(k, f"u{k} v{k % 3} common") for k in range(50)]
    d, i = spark.createDataFrame(many, "doc_id bigint, text string"), spark.createDataFrame([(9, "u7 v1 common")], "item_id bigint, text string")
    old, ranked.WANTED_TERMS = ranked.WANTED_TERMS, 1  # more terms than may be sent: the index holds all terms
    try:
        rows = ranked.top_documents(d, i).orderBy("rank").collect()
    finally:
        ranked.WANTED_TERMS = old
    assert [(r.item, r["rank"], r.id, r.score) for r in rows] == [(9, *x[1:]) for x in brute_ranks(many, [(9, "u7 v1 common")])]


def brute_negatives(rows):
    held = []
    for k, (i, v, label) in enumerate(rows):
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((i, k, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out, order = [], lambda p: (-p[0], p[1] is None, p[1] or 0, p[2])
    for i, k, label, v in held:
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, m, o) for j, m, o, w in held if m != k]
        for ps, pid, _, _ in sorted((p for p in scored if p[3] == label), key=order)[:5]:
            fits = sorted((p for p in scored if p[3] != label and 50 * ps <= 100 * p[0] <= 95 * ps), key=order)
            out += [(i, pid, r + 1, p[1], ps, p[0]) for r, p in enumerate(fits[:3])]
    return sorted(map(repr, out))


def mined(spark, rows):
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(repr(tuple(r)) for r in negatives.mine(v.withColumn("label", label), F.col("vec_id") % 50 == 0).collect())


def vectors(n, seed=1, dim=16, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    out = []
    for k in range(n):
        v = centre[k % labels] + rng.normal(size=dim) * 0.8
        out.append((k, [float(np.float32(x)) for x in v / np.linalg.norm(v)], k % labels))
    return out


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = vectors(700)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 5)
    monkeypatch.setattr(negatives, "ROW_BLOCK", 90)  # many blocks of the grid
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_awkward_rows(spark):
    rows = vectors(120)
    hot = rows[3][1]
    rows += [(200 + k, hot, 3) for k in range(40)] + [(50, rows[50][1], rows[50][2]), (None, hot, 1), (None, hot, 3)]  # copies, a repeated anchor, null ids
    rows += [(300, None, 1), (350, [1.0] * 16, None), (400, [float("nan")] * 16, 1), (450, [float("inf")] + [0.0] * 15, 1), (500, [None] + [0.1] * 15, 1), (550, [], 2), (551, [0.5], 2), (600, [0.0] * 16, 1)]
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == []


def test_bounds_discard_most_pairs_and_hold(spark):
    rng = np.random.default_rng(3)
    axes = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    a, b = (np.floor(256 * (rng.normal(size=(n, 32)) * 0.8 ** np.arange(32)) @ axes.T).astype(np.int64) for n in (40, 3000))
    pairs = negatives.Pairs(a, b, np.linalg.eigh((b.T @ b).astype(float))[1][:, ::-1])
    i, j = np.arange(40), np.arange(3000)
    exact, wide = a @ b.T, []
    for lower, upper, _ in pairs.bounds(np.arange(40), np.arange(3000)):
        assert (lower <= exact).all() and (exact <= upper).all()
        wide.append((upper - lower).mean())
    assert len(wide) > 1 and wide == sorted(wide, reverse=True)
    label, count = np.zeros(40, np.int64), [0]
    found = negatives.best_same(pairs, label, np.zeros(3000, np.int64), count)
    assert count[0] < 0.01 * exact.size  # whole products of less than a hundredth of the pairs
    for k in range(40):
        assert sorted(found[2][found[0] == k])[-6:] == sorted(exact[k])[-6:]


def test_negatives_grid_has_no_python_per_pair(spark):
    rows = vectors(60)
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    plan = negatives.mine(v, F.col("vec_id") % 50 == 0)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def texts(spark, *htmls):
    rows = spark.createDataFrame([(k, "u", h) for k, h in enumerate(htmls)], "page_id bigint, url string, html string")
    return [r["__text"] for r in pages.extract(rows).orderBy("page_id").collect()]


LONG = " ".join(f"word{k}" for k in range(60))


def test_main_text_of_marked_pages(spark):
    page = (
        f"<html><head><title>T</title><script>var a='<p>no</p>';</script><style>p{{}}</style></head><body class='has-sidebar'><header><h2>Site</h2></header><nav><ul><li><a href=/a>Home</a><li>More</ul></nav>"
        f"<!-- <p>gone</p> --><div class='ad-top'>Buy {LONG}</div><article class=post><header><h1>Caf&eacute; &amp; bar</h1><p>By me</p></header><p><b>One<br>two&nbsp;three <p>{LONG} <a href=x>link</a>.</p><p>Short</p>"
        "<form><label>Mail</label><input><button>Go</button></form><div class=adSlot>Buy</div><ul><li>first<li><a href=x>second</a></ul><aside>Side</aside><table><tr><td>c1<td>c2</table><p>a &lt; b, 1 < 2</p>"
        f"<section id=comments><article class=comment><p>{LONG}</p></article></section><noscript>Turn on</noscript></article><div role=alert>{LONG}</div><div>{LONG}</div><footer>&copy; me</footer></body></html>"
    )
    assert texts(spark, page)[0].split("\n\n") == ["Café & bar", "One two three", LONG + " link.", "Short", "first", "second", "c1", "c2", "a < b, 1 < 2"]


def test_main_text_of_bare_pages(spark):
    links = "".join(f"<div><a href=/{k}>page {k}</a></div>" for k in range(6))
    page = f"<body><div id=top>Name</div>{links}<div><h1>Head line here now</h1><p>{LONG}</p><p>{LONG} x</p><p>{LONG} y</p></div>{links}<div>All rights</div></body>"
    got = texts(spark, page, "just words without any tag", links)
    assert got[0].split("\n\n") == ["Head line here now", LONG, LONG + " x", LONG + " y"] and got[1:] == ["just words without any tag", ""]


def test_heads_of_articles_and_pages(spark):
    head = f"<div class='entry-header'><h1>Title</h1><p>{LONG}</p><div class=share>Share</div></div>"
    got = texts(spark, f"<body><div class=page-header><h1>Site</h1></div><div class=post>{head}<p>Text</p></div></body>", f"<body><header><h1>Site</h1></header><main>{head}<p>Text</p><div class='no-sidebar story-body'><p>More</p></div></main></body>")
    assert got == ["Title\n\nText", "Title\n\nText\n\nMore"]


def test_awkward_pages(spark):
    deep = "<div>" * 20_000 + LONG
    got = texts(spark, None, "", "<", "<p", "<!--", "<article><p>a<!-- open", f"<article><p title='x>y'>{LONG}</p><p a='>open", "<article><button>no<p>yes</p></article>", deep, f"<article><p>{'lorem ' * 300_000}</p></article>")
    assert got[:6] == ["", "", "<", "", "", "a"] and got[6] == LONG + "\n\nopen" and got[7] == "yes" and got[8] == LONG and len(got[9]) == 6 * 300_000 - 1
    rows = spark.createDataFrame([(1, "a", "t", 5)], "page_id bigint, html string, text string, __n_chars int")
    got = pages.extract(rows)
    assert [tuple(r) for r in got.collect()] == [(1, "a", "t", "a", 1)] and got.columns == ["page_id", "html", "text", "__text", "__n_chars"]
    assert pages.extract(rows, keep=("page_id",)).columns == ["page_id", "__text", "__n_chars"]
    assert pages.extract(rows.limit(0)).collect() == [] and pages.extract(rows.unionAll(rows)).count() == 2


def test_tree_is_trained_and_fits_its_table():
    x, y = pages.labelled()
    assert len(x) == len(y) > 100 and 0.3 < y.mean() < 0.7

    def said(node, row):
        while len(node) > 1:
            node = node[2] if row[pages.FEATURES.index(node[0])] <= node[1] else node[3]
        return node[0]

    assert np.mean([said(pages.tree(), row) == keep for row, keep in zip(x, y, strict=True)]) == 1.0
    held = [said(pages._grown(np.delete(x, k, 0), np.delete(y, k), 8), x[k]) == y[k] for k in range(len(y))]
    assert np.mean(held) > 0.9  # each block by a tree that has not seen it


def test_pages_equal_their_articles(spark):
    sf = "/root/testdata/sf0.001"
    for r in pages.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["__text"] == "\n\n".join(p for p in parts if p) and r["__n_chars"] == len(r["__text"])


@pytest.mark.parametrize("text", ["", "a", "x" * 3_000_000, "ab " * 700_000, ("y" * 1_048_575 + " ") * 3])
def test_pieces_part_no_term(text):
    buf = np.frombuffer(text.encode(), np.uint8)
    parts = list(ranked._pieces(buf))
    assert b"".join(bytes(buf[a:b]) for a, b in parts) == text.encode()
    assert [w for a, b in parts for w in WORD.findall(bytes(buf[a:b]).decode())] == WORD.findall(text)
