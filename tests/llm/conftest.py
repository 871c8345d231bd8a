import pytest

#: Rows that every operator has to bear: null, empty, blank, ties, repeated rows, non-Latin text, one very long word.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five"), (5, "one two three four five"),
       (5, "one two three four five"), (6, "Ünïcode 漢字 🙂 é́ <|endoftext|> it's  two   spaces \n\n x"),
       (7, "w" * 5000), (8, "the cat sat on the mat. " * 800), (None, "no id at all, only a text"), (9, "x")]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string")


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture()
def folder(spark):
    from farebox.llm.common import scratch
    return scratch(spark, "test")
