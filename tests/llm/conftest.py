import pytest

from pyspark.sql import Row

# Texts that every operator has to take: null, empty, white, very long, odd
# characters, repeated rows; and columns whose names clash with inner ones.
ODD = [None, "", " \n\t ", "a", "x" * 30_000, "word " * 9_000, "<|endoftext|> a  b c\x1c d é \U0001F600 ΣΣ 1½2²", "\r\n\r\nA. B! C? 　",
       "the same text of some seven words", "the same text of some seven words"]


@pytest.fixture
def odd_docs(spark):
    rows = [Row(doc_id=i if i != 4 else None, text=t, lang="en", source="s", n_chars=len(t or ""), n=1, spans="x", node=2, k1=3, row="r")
            for i, t in enumerate(ODD)]
    rows.append(rows[-1])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n int, spans string, node int, k1 int, row string")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
