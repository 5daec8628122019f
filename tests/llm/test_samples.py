"""What the classifier learns from where one doc_id, or none, has a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from barflow.llm import quality


@pytest.fixture
def seen(monkeypatch):
    out = {}
    monkeypatch.setattr(quality, "train", lambda *sets: out.update(zip(("positive", "unlabelled", "negative"), sets)))
    return out


@pytest.mark.parametrize("hot", [0, None])
@pytest.mark.parametrize("equal", [True, False])
def test_every_row_is_unlabelled_and_labelled_ones_are_bounded(spark, seen, hot, equal):
    plain = [(i, f"word {i} " * 5) for i in range(10, 2010)]
    rows = [(hot, "12 34" if equal else f"12 34 {'1' * (i % 50)}{i}") for i in range(1000)]
    docs = spark.createDataFrame(plain + rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(10, 2010)] + [(0, 1)], "doc_id long, quality int")
    quality.fit(docs, labels, 150)
    assert len(seen["positive"]) <= 150 and len(seen["negative"]) <= 150
    corpus, hot_rows = seen["unlabelled"].documents, F.col("text").startswith("12 34")
    assert corpus.count() == docs.filter(~quality.is_held_out(F.col("doc_id"))).count()
    assert corpus.filter(hot_rows).count() == 1000
    for some in (corpus, corpus.filter(hot_rows)):
        assert 0.45 <= some.agg(F.avg("half")).first()[0] <= 0.55


def test_a_labelled_id_is_one_row(spark, seen):
    docs = spark.createDataFrame([(0, f"text {i}") for i in range(500)] + [(1, "other")], "doc_id long, text string")
    quality.fit(docs, spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int"), 50)
    assert len(seen["positive"]) <= 2 and seen["unlabelled"].documents.count() == 501
