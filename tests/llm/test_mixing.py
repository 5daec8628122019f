"""Mixing against sharing in rounds, word by word."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from barflow.llm import mixing
from barflow.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Targets by sharing again and again what lies above a cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values()) * percent / 100
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: unit * weight[s] for s in open_}
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= above
    return target


def check(documents, rows):
    texts = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in documents.collect()]
    sizes = {}
    for _, source, n in texts:
        sizes[source] = sizes.get(source, 0) + n
    target = shared(sizes)
    expected = sorted((repr(d), n, sizes[s], round(target[s], 6)) for d, s, n in texts)
    assert sorted((repr(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6)) for r in rows) == expected
    for r in rows:
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["taken"] == r["copies"] * r["size"] and math.floor(rate) <= r["copies"] <= math.ceil(rate) <= 2
    return texts, target


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = queries()["op12_source_mix"](spark, folder).collect()
    texts, target = check(documents, rows)
    source = {d: s for d, s, _ in texts}
    for name, words in target.items():
        taken = sum(r["taken"] for r in rows if source[r["doc_id"]] == name)
        assert abs(taken - words) <= 0.03 * words
    again = queries()["op12_source_mix"](spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_no_python_on_the_way(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.shares(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("most", [0, 100_000])
def test_messy_rows(spark, messy, nothing, most, monkeypatch):
    """Also with sources joined by salt instead of broadcast."""
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", most)
    frame = messy.withColumn("source", F.when(F.col("node") % 4 != 0, F.concat(F.lit("s"), F.col("node") % 3))).withColumn(
        "copy", F.lit("clash"))
    rows = mixing.shares(frame).collect()
    assert len(rows) == frame.count()
    check(frame, rows)
    mixed = mixing.mix(frame)
    assert sorted(mixed.columns) == sorted(frame.columns)
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.shares(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_mix_repeats_rows_as_the_shares_say(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    times = {r["doc_id"]: r["copies"] for r in mixing.shares(documents).collect()}
    mixed = mixing.mix(documents)
    found = {r["doc_id"]: (r["n"], r["last"]) for r in mixed.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max("copy").alias("last")).collect()}
    assert found == {d: (n, n) for d, n in times.items() if n}
    assert mixed.drop("copy").distinct().exceptAll(documents.distinct()).isEmpty()


def test_targets_of_random_sources(spark):
    rng = random.Random(4)
    for trial in range(6):
        sizes = {f"n{i}": rng.choice([0, 1, 5, 50, 2000, 300_000_000]) * rng.randrange(1, 9) for i in range(rng.randrange(1, 30))}
        sizes |= {None: 77} if trial % 2 else {}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r["source"]: r["target"] for r in mixing.targets(frame, (3, 1, 2), 150, 2).collect()}
        assert found.keys() == sizes.keys()
        for s, words in shared(sizes).items():
            assert abs(found[s] - words) <= 1e-9 * max(1, words)


def test_last_copies_are_drawn_with_the_fraction(spark):
    frame = spark.range(40_000).select(F.xxhash64("id").alias("draw"), F.lit(1.3).alias("rate"), F.lit(5).alias("seed"))
    found = frame.agg(F.avg(mixing.copies()), F.min(mixing.copies()), F.max(mixing.copies())).first()
    assert abs(found[0] - 1.3) < 0.01 and tuple(found)[1:] == (1, 2)
