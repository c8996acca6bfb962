import pytest

SF = "/root/testdata/sf0.001"
# Rows every operator has to cope with: nulls anywhere, empty, blank and long texts, repeated rows and ids.
LONG = "lorem ipsum dolor sit amet " * 4000
EDGE = [
    (1, "one two three four five six seven eight nine ten " * 3, "en", "a", 10),
    (1, "one two three four five six seven eight nine ten " * 3, "en", "a", 10),
    (2, None, "en", "a", None), (3, "", None, "a", 0), (4, " \n\t ", "en", None, 4),
    (None, "a row without id but with some words in it", "de", "b", 1), (None, None, None, None, None),
    (5, LONG, "en", "b", len(LONG)), (6, "1234 5678 !!", "en", "b", 12), (7, "é ü ß\u0000x \U0001f642 <|endoftext|>", "fr", "c", 1),
    (7, "another text under the same id", "fr", "c", 1),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F
    clash = {c: F.lit("x") for c in ("id", "n", "path", "key", "h", "at", "w", "start", "end", "good", "score", "file", "i", "c", "t")}
    return spark.createDataFrame(EDGE, COLUMNS).withColumns(clash)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
