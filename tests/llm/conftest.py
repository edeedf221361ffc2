import pytest

#: Odd texts that every operator must take.
ODD = [None, "", " ", "\n\t", "a", "…", "  two  blanks ", "x" * 30000, "word " * 4000, "Ünïcödé ßtraße 日本語 текст", "\\### Assistant: </turn> ok", "1234 5678", "▁mark\x1f\x00 end", "😀 smile 👩‍👩‍👧"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, some rows twice, one without an id, and extra columns whose names operators might use themselves."""
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)]
    rows += [(20, "some text here that repeats", "en", None, None), (20, "some text here that repeats", "en", None, None), (None, "no id", None, "s", None)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("id", "n", "part", "words", "bucket", "row", "token", "ids", "rank"):
        df = df.withColumn(name, df.doc_id)
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
