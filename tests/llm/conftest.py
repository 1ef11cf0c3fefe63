import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="session")
def code(spark):
    from quaylake.llm.common import share_code
    return share_code(spark)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing column names."""
    long_text = " ".join(f"word{i % 977} the" for i in range(60_000))
    rows = [(1, "The house and the garden are big. " * 12, "en", "a", 5, 1.0, "x"),
            (1, "The house and the garden are big. " * 12, "en", "a", 5, 1.0, "x"),
            (2, "", "de", None, 0, None, None), (3, None, None, "b", None, 2.0, "y"),
            (None, "Der Hund und die Katze. " * 15, "de", "b", 3, 3.0, "z"), (None, None, None, None, None, None, None),
            (4, " \n\t ", "en", "c", 3, 4.0, "x"), (5, long_text, "en", "c", 9, 5.0, "x"),
            (6, "日本語 テキスト 🎉 é́ <|endoftext|> \x00\x1c end", "fr", "d", 2, 6.0, "x"),
            (7, "1234 !!", "es", "d", 2, 6.0, "x"), (8, "x" * 30_000, "en", "d", 2, 6.0, "x")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_words long, score double, `key` string")


def tables(spark, *names):
    return [spark.read.parquet(os.path.join(SF, f"{n}.parquet")) for n in names]
