import duckdb
import pytest

from barflow.llm.common import prepare
from barflow.llm.tokens import default_vocabulary, encoder

SMALL = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, node long, rank int, rule string, "
    "label int, sequence_id string, spans string, component_id string"
)
LONG = " ".join(f"w{i % 7919}x{i}" for i in range(60_000))


@pytest.fixture(scope="session")
def docs(spark):
    return prepare(spark).read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def messy(spark):
    """NULLs in every column, empty and long texts, repeated rows, columns with names used inside."""
    texts = [
        (1, "One two three four five six."), (2, None), (3, ""), (None, "One two three four five six."),
        (4, LONG), (5, "  \n "), (6, "ünï cödé — “x” 日本語 é́"), (7, "One two three four five six."),
        (7, "One two three four five six."), (8, "short"), (None, None), (9, "a" * 5000),
    ]
    rows = [(i, t, None if n % 3 else "en", None, None, n, None, "x", None, "y", None, "z")
            for n, (i, t) in enumerate(texts)]
    return prepare(spark).createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def library():
    return encoder(default_vocabulary()).library


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{name}.parquet')")
    return con
