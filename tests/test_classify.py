import pytest
from cairn.functions import classify as c
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0]["x"]


def arr(*v):
    return F.array(*map(F.lit, v)) if v else F.array().cast("array<string>")


@pytest.mark.parametrize(
    ("title", "subjects", "shelf", "status"),
    [("A story", ["Domestic fiction"], ["PZ3 .A1"], "fiction"), ("Annual report of factory conditions", ["Labor", "Social conditions"], ["HD8051 .A2"], "nonfiction"), ("Collected works", [], ["PS1000 .A1"], "uncertain"), ("x", ["Novelty goods"], [], "fiction"), (None, [], [], "uncertain")],
)
def test_books(spark, title, subjects, shelf, status):
    assert one(spark, c.book_decision(F.lit(title).cast("string"), arr(*subjects), arr(*shelf)))["status"] == status


def test_periodicals_and_review(spark):
    assert one(spark, c.periodical_decision(F.lit("Daily Tribune"), arr(), arr("Newspapers"), arr()))["status"] == "newspaper"
    assert one(spark, c.periodical_decision(F.lit("A Literary Magazine"), arr(), arr("Periodicals"), arr()))["status"] == "literary"
    assert one(spark, c.review_reasons(F.lit("A book of Psalms"), arr("Psalmody"))) == ["subject contains 'psalm'", "title contains 'psalms'"]


def test_serials(spark):
    assert one(spark, c.serial_decision(F.lit("CHAPTER XII\nfoo To be continued."))) == ("literary", "high", [f"OCR pattern: {c.STRONG_MARKS[0]}", f"OCR pattern: {c.STRONG_MARKS[1]}"])
    assert one(spark, c.serial_decision(F.lit("copyright 1899 by x. continued from page 3")))["confidence"] == "medium"
    assert one(spark, c.serial_decision(F.lit("Wheat rose two cents.")))["status"] == "retain"


@pytest.mark.parametrize(
    ("rights", "ok"),
    [("Public Domain", True), ("public-domain", True), ("not in the public domain", False), ("CC BY-SA", True), ("CC BY-NC", True), ("by-nc-nd", False), ("dominio  público", True), ("保護期間満了", True), ("", False), (None, False), ("license unknown; public domain", False), ("http://creativecommons.org/licenses/by-nd/4.0", False)],
)
def test_rights(spark, rights, ok):
    assert one(spark, c.rights_eligible(F.lit(rights).cast("string"))) is ok
