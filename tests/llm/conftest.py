import pytest


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, and columns whose names could clash."""
    rows = [
        (1, None, "en", "a", "x", 1.0),
        (2, "", "en", None, None, None),
        (None, "the cat sat on the mat and the dog ran away from it", None, "a", "x", 2.0),
        (4, "the cat sat on the mat and the dog ran away from it", "en", "a", "x", 2.0),
        (4, "the cat sat on the mat and the dog ran away from it", "en", "a", "x", 2.0),
        (5, "¿ 漢字 ½ \x1c  \n\n ... ", "zz", "b", "x", 0.0),
        (6, "word " * 300_000, "en", "b", "x", 0.0),
        (7, "der hund und die katze sind nicht hier sondern dort", "de", "c", "x", 0.0),
        (8, "a", "de", "", "x", 0.0),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score string, n double")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 0, 1), (7, 0, 0), (8, None, None), (None, 1, 1), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
