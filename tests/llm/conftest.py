import pytest

WORDS = "the of and to in for was that with on as by at from are this be or an have not which it were but".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty fields, a very long text, ties, repeated rows, and columns whose names clash with inner ones."""
    long_text = " ".join(WORDS[i * 7 % len(WORDS)] + str(i % 311) for i in range(30000))
    rows = [(1, "The the cat. password=abcdefgh12345 me@x.org", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
            (None, "un texte de la rue", "fr", "b"), (4, long_text, "en", "b"), (5, "x", None, "a"), (5, "x", None, "a"),
            (6, "12 34 +1 (555) 123-4567", "en", None), (7, "\t\n ", "en", "é"), (8, "The the cat. password=abcdefgh12345 me@x.org", "en", "a")]
    cols = ("_row", "_key", "k", "size", "copy", "q", "shard", "slot", "_cell", "lang_pred", "score")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in cols)
    return spark.createDataFrame([(*r, len(r[1] or ""), *cols) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs001(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def docs01(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
