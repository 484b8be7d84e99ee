import random

from cairn.functions import text
from pyspark.sql import functions as F


def one(spark, *columns):
    return list(spark.range(1).select(*columns).collect()[0])


def cleaned(t):
    """The rules of clean_text, character by character."""
    letter = lambda c: c.isalnum() or c == "_"
    t = "".join("\n" if c == "\r" else c for k, c in enumerate(t) if not (c == "\n" and k and t[k - 1] == "\r"))
    out = ""
    k = 0
    while k < len(t):
        if t[k] == "-" and t[k + 1 : k + 2] == "\n" and k and letter(t[k - 1]) and k + 2 < len(t) and letter(t[k + 2]):
            k += 2
            continue
        if t[k] in " \t":
            if not (k and t[k - 1] in " \t"):
                out += " "
        elif not (t[k] == "\n" and out.endswith("\n\n")):
            out += t[k]
        k += 1
    return out.strip()


def test_clean_text_equals_a_model(spark):
    rng = random.Random(5)
    rows = [("".join(rng.choice("ab é-\n\r\t .漢-\n") for _ in range(rng.randint(0, 40))),) for _ in range(400)]
    got = spark.createDataFrame(rows, "t string").select("t", text.clean_text(F.col("t")).alias("c")).collect()
    assert all(r.c == cleaned(r.t) for r in got)


def test_years(spark):
    lit = F.lit
    assert one(spark, text.first_year(lit("in 1898年 or 1700")), text.first_year(lit("1499 21000")), text.earliest_year(F.array(lit("1900-1850"), lit("x 1023")))) == [1700, None, 1023]  # a letter after a year hides it


def test_stable_id_and_canonical_json(spark):
    import hashlib

    got = one(spark, text.stable_id(F.lit("a"), F.lit(None), F.lit("é")), text.canonical_json(b=F.lit('x"\n'), a=F.lit(None)))
    assert got == [hashlib.sha256("a\x1f\x1fé".encode()).hexdigest()[:24], '{"a":"","b":"x\\"\\n"}']


def test_terms(spark):
    got = one(spark, text.terms(F.lit("Food_food açúcar ½")), text.search_terms(F.lit("帝国人 abc 帝国人 A a")), text.folded(F.lit("AÇÚCAR Łódź ガ ß")))
    assert got == [["Food", "food", "açúcar", "½"], ["帝国人", "帝", "国", "人", "帝国", "国人", "abc", "A", "a"], "acucar łodz ガ ß"]


def test_small_rules(spark):
    empty = F.array().cast("array<string>")
    got = one(
        spark, text.text_url(F.array(F.lit("http://a/x.pdf"), F.lit("http://a/B.TXT?q=1")), empty), text.text_url(empty, empty), text.last_segment(F.lit("http://a/b/c/")),
        text.class_prefix(F.lit(" pz3 .A")), text.first_value(empty, "d"), text.model_prefixes(F.lit("intfloat/multilingual-e5-small"))["query"], text.model_prefixes(F.lit("x/some"))["query"],
    )
    assert got == ["http://a/B.TXT?q=1", "", "c", "PZ", "d", "query: ", ""]
