import random
import re

import pytest
from cairn.operators.chunking import chunk_documents, chunk_texts
from pyspark.sql import functions as F


def model(text, target, overlap):
    """Windows and packing, written from the rules."""
    out, now, n = [], [], 0
    for p in [q.strip() for q in re.split(r"\n\s*\n", text) if q.strip()]:
        w = p.split()
        cjk = re.search(r"[぀-ヿ㐀-鿿가-힯]", p) and len(p) > target
        if cjk or len(w) > target:
            seq = p if cjk else w
            if now:
                out.append("\n\n".join(now))
            now, n = [], 0
            parts = [seq[i : i + target] for i in range(0, len(seq) - overlap, target - overlap)]
            out += parts if cjk else [" ".join(x) for x in parts]
        elif now and n + len(w) > target:
            whole = "\n\n".join(now)
            out.append(whole)
            room = min(overlap, max(0, target - len(w)))
            tail = whole.split()[-room:] if room else []
            now, n = ([" ".join(tail)] if tail else []) + [p], len(tail) + len(w)
        else:
            now.append(p)
            n += len(w)
    return out + (["\n\n".join(now)] if now else [])


@pytest.mark.parametrize(("target", "overlap"), [(4, 1), (10, 3), (7, 0), (16, 15)])
def test_random_documents(spark, target, overlap):
    rng = random.Random(target)
    piece = lambda: " ".join(rng.choice(["a", "bb", "日本", "é", "x\ty"]) for _ in range(rng.randint(0, 14))) + rng.choice(["", "日本語の文章がここに続きます"])
    rows = [("\n\n".join(piece() for _ in range(rng.randint(0, 6))),) for _ in range(120)]
    got = spark.createDataFrame(rows, "t string").select("t", chunk_texts(F.col("t"), target, overlap).alias("c")).collect()
    assert all(list(r.c) == model(r.t, target, overlap) for r in got)


def test_edges(spark):
    df = spark.createDataFrame([("1", None, "u"), ("2", " \n\n ", "u"), ("3", "One two three.\n\nFour five six.", "u")], "id string, text string, url string")
    rows = chunk_documents(df, 4, 1).orderBy("ordinal").collect()
    assert [(r.document_id, r.ordinal, r.url, r.text) for r in rows] == [("3", 0, "u", "One two three."), ("3", 1, "u", "three.\n\nFour five six.")]
    assert chunk_documents(df.where("id = '0'"), 4, 1).count() == 0
    for bad in ((0, 0), (4, 4), (4, -1)):
        with pytest.raises(ValueError):
            chunk_texts(F.col("text"), *bad)
    assert [len(c.split()) for c in spark.range(1).select(chunk_texts(F.lit("word " * 1000)).alias("c")).collect()[0].c] == [350, 350, 350, 100]


def test_a_paragraph_of_very_many_words(spark):
    import time

    began = time.time()
    text = " ".join(f"w{i}" for i in range(400_000))
    got = spark.createDataFrame([(text,), ("字" * 200_000,)], "t string").select(chunk_texts(F.col("t"), 50, 10).alias("c")).collect()
    assert [len(r.c) for r in got] == [10_000, 5000] and got[0].c[1].split()[0] == "w40" and time.time() - began < 60
