import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and long texts, ties, repeats and clashing columns."""
    passage = "a fairly long passage of words that is on many pages of this small corpus, with more words. "
    rows = [
        (1, "Hello brave new world, this is a text.\nwith two lines", "en", "s"), (2, None, None, None), (3, "", "en", "s"),
        (4, "Hello brave new world, this is a text.\nwith two lines", "en", "s"), (4, "Hello brave new world, this is a text.\nwith two lines", "en", "s"),
        (None, "no id here but a few words", "en", None), (None, None, None, None), (5, "12 34 !!", "en", "t"), (6, "x", "de", "t"),
        (7, passage * 300, "en", "s"), (8, passage * 3 + "é ü ñ 😀", "fr", "s"), (9, "\n\n \t", "en", "s"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.selectExpr(
        "*", "1 as n_chars", "'k' as kept", "2 as piece", "'h' as host", "3 as keys", "'p' as lang_pred", "4 as n", "5 as text_key",
        "6 as length", "7 as bucket", "8 as node", "9 as cell", "10 as blob", "11 as base")


@pytest.fixture(scope="session")
def texts(spark, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    return frame, {r.doc_id: r.text or "" for r in frame.select("doc_id", "text").collect()}
