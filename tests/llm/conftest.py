import pytest

NULLS = [
    (None, None, None, None, None), (1, None, None, None, 0), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4),
    (4, "word", "en", "s", 4), (4, "word", "en", "s", 4), (4, "another text of the same id", "en", "s", 27),
    (5, "é ü x\r\n\r\n  y\x1cz ́ <|endoftext|> it's 12.5 ok", None, "s", 40), (6, "a" * 50_000, "en", "t", 50_000),
    (7, "1 " * 30_000, "en", "t", 60_000), (8, "mail a@b.c_d@e.f, 1.2.3.4.5 +1 (499) 555-6503, 4539 1488 0343 6467", "en", "s", 60),
]
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that hold nulls, empty, repeated and long texts."""
    return spark.createDataFrame(NULLS, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def clashing(df):
    """The same table with columns whose names operators could use themselves."""
    from pyspark.sql import functions as F

    names = ["fp", "row", "n", "list", "pair", "units", "rank", "bucket", "first", "last", "start", "end", "ids", "kept", "node", "root", "shard",
        "_key", "_keep", "_many", "_least", "_id", "_fp", "_hot", "_split", "_pair", "_lang", "_source", "least", "id", "key"]
    return df.withColumns({n: F.lit("x") for n in names})
