"""The store with a manifest: what is visible, which files a reader opens, and the numbers of rows."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import same_rows
from pyspark.sql import functions as F

from barflow import store
from barflow.operators.numbering import numbered, running
from barflow.session import children

START = datetime(2024, 1, 1)
SCHEMA = "symbol string, timestamp timestamp, signal string, close double"


def signals(spark, symbols, days, first=0, step=timedelta(days=1)):
    return spark.createDataFrame([
        (f"S{s}", START + (first + d) * step, "BUY" if d % 2 else "SELL", float(d)) for s in range(symbols) for d in range(days)
    ], SCHEMA)


def at(day):
    return F.lit(START + timedelta(days=day)).cast("timestamp")


def opened(rows):
    return len(rows.inputFiles())


def test_numbers_have_no_gaps(spark):
    rows = spark.createDataFrame([(i % 7, i) for i in range(1000)], "a long, b long").repartition(9)
    for n in (None, 1, 5):
        found = [tuple(r) for r in numbered(rows, ["a", "b"], "id", 10, n).orderBy("id").collect()]
        assert [(a, b) for a, b, _ in found] == sorted((i % 7, i) for i in range(1000))
        assert [i for *_, i in found] == list(range(10, 1010))
    assert numbered(rows.filter("false"), ["a"]).count() == 0
    assert numbered(rows.withColumn("a", F.lit(None).cast("long")), ["a"]).agg(F.countDistinct("id")).first()[0] == 1000


def test_running_sums(spark):
    values = [(i, random.Random(i).randrange(-5, 50), None if i % 9 == 0 else i) for i in range(500)]
    rows = spark.createDataFrame(values, "i long, x long, y long").repartition(5)
    found = running(rows, ["i"], {"xs": "x", "ys": "y"}).orderBy("i").collect()
    for k, r in enumerate(found):
        assert r["xs"] == sum(x for _, x, _ in values[:k + 1]) and r["ys"] == sum(y or 0 for *_, y in values[:k + 1])


def test_no_window_over_all_rows(spark):
    plan = numbered(spark.range(1000), ["id"], "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "HashAggregate" in plan.split("Window [")[1]


def test_a_round_is_there_once_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "s")
    first, second = signals(spark, 3, 5), signals(spark, 3, 5, 5)
    with pytest.raises(ValueError):
        store.read(spark, path)
    store.append(first, path, 0, at(5))
    crashed = store.stage(second, path, 1, at(10))
    assert store.read(spark, path).count() == 15
    store.append(second, path, 1, at(10))
    store.append(second, path, 1, at(11))
    store.append(first, path, 0, at(11))
    rows = store.read(spark, path)
    assert rows.count() == 30 == rows.select("symbol", "timestamp").distinct().count()
    assert [r[0] for r in rows.select("id").orderBy("id").collect()] == list(range(1, 31))
    assert rows.filter(F.col(store.CREATED) == at(5)).count() == 15
    assert crashed.rsplit("/", 1)[1] not in children(spark, f"{path}/data/round=1")


def test_a_manifest_that_was_not_finished_does_not_count(spark, tmp_path):
    path = str(tmp_path / "s")
    store.append(signals(spark, 2, 3), path, 0, at(0))
    store.append(signals(spark, 2, 3, 3), path, 1, at(1))
    (tmp_path / "s/manifest/round=1/_SUCCESS").unlink()
    assert store.read(spark, path).count() == 6
    store.append(signals(spark, 2, 3, 3), path, 1, at(1))
    assert store.read(spark, path).count() == 12


def test_empty_rounds_and_batches(spark, tmp_path):
    path = str(tmp_path / "s")
    write = store.writer(path)
    for number, frame in enumerate((signals(spark, 1, 4), signals(spark, 1, 4).filter("false"), signals(spark, 1, 4, 4))):
        write(frame, number)
        write(frame, number)
    assert store.read(spark, path).agg(F.count("*"), F.max("id")).first() == (8, 8)
    assert store.read(spark, path, symbol="none").count() == 0


def test_merged_manifests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MERGE_ROUNDS", 3)
    path = str(tmp_path / "s")
    for number in range(8):
        store.append(signals(spark, 2, 1, number), path, number, at(number))
        assert len(store._committed(spark, path)) <= 3
    store.append(signals(spark, 2, 1, 2), path, 2, at(20))
    rows = store.read(spark, path)
    assert rows.agg(F.count("*"), F.max("id")).first() == (16, 16)
    assert store.read(spark, path, created_since=at(5)).count() == 6
    assert "round=1" not in children(spark, f"{path}/manifest")


def test_a_reader_opens_the_rounds_created_since(spark, tmp_path):
    path = str(tmp_path / "s")
    for number in range(5):  # later rounds hold older times
        store.append(signals(spark, 4, 6, 100 - 10 * number), path, number, at(number))
    rows = store.read(spark, path, created_since=at(3))
    assert rows.count() == 48 and opened(rows) <= opened(store.read(spark, path)) * 2 / 5
    few = store.read(spark, path, start=at(80), end=at(83))
    assert few.count() == 12 and opened(few) <= opened(store.read(spark, path)) / 5
    assert store.read(spark, path, created_since=at(9)).count() == 0


def test_one_symbol_is_in_few_clustered_files(spark, tmp_path):
    path, target = str(tmp_path / "s"), str(tmp_path / "c")
    for number in range(2):
        store.append(signals(spark, 64, 32, 32 * number), path, number, at(0))
    store.cluster(spark, path, target, 2, 64)
    store.cluster(spark, path, target, 2, 64)  # is there already
    store.append(signals(spark, 64, 1, 64), path, 2, at(1))
    both = {"clustered": (target, 2)}
    every = store.files(spark, target).count()
    assert every >= 50 and store.read(spark, path, **both).count() == 64 * 65
    for symbol in ("S0", "S17", "S63"):
        rows = store.read(spark, path, symbol=symbol, **both)
        assert rows.count() == 65
        assert opened(rows) - opened(store.read(spark, path, created_since=at(1))) <= every / 3
    rows = store.read(spark, path, start=at(10), end=at(12), **both)
    assert rows.count() == 128 and opened(rows) <= every / 3
    rows = store.read(spark, path, symbol="S5", start=at(10), end=at(12), **both)
    assert rows.count() == 2 and opened(rows) <= every / 8


def test_a_clustered_copy_goes_on_with_new_rounds_alone(spark, tmp_path):
    path, target = str(tmp_path / "s"), str(tmp_path / "c")
    for number in range(4):
        store.append(signals(spark, 64, 16, 16 * number), path, number, at(number))
    store.cluster(spark, path, target, 2, 64)
    before = {r["file"] for r in store.files(spark, target).collect()}
    for _ in range(2):
        store.cluster(spark, path, target, 4, 64)
    held = store.files(spark, target).collect()
    assert before < {r["file"] for r in held} and sum(r["rows"] for r in held) == 4 * 64 * 16
    assert all(r["first_time"] >= START + timedelta(days=32) for r in held if r["file"] not in before)
    same_rows(store.read(spark, path, clustered=(target, 4)), store.read(spark, path))
    same_rows(store.read(spark, path, clustered=(target, 2)), store.read(spark, path))
    rows = store.read(spark, path, symbol="S17", clustered=(target, 4))
    assert rows.count() == 64 and opened(rows) <= len(held) / 3


def test_a_hot_symbol_is_split(spark, tmp_path):
    path, target = str(tmp_path / "s"), str(tmp_path / "c")
    hot = signals(spark, 1, 2000, 0, timedelta(hours=1))
    store.append(hot.unionByName(signals(spark, 20, 50).filter("symbol <> 'S0'")), path, 0, at(0))
    store.cluster(spark, path, target, 1, 200)
    assert store.files(spark, target).agg(F.max("rows")).first()[0] < 800


def test_small_clustered_files_do_not_need_a_task_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "TASK_ROWS", 1000)
    path, target = str(tmp_path / "s"), str(tmp_path / "c")
    store.append(signals(spark, 64, 64), path, 0, at(0))
    store.cluster(spark, path, target, 1, 32)
    held = store.files(spark, target).collect()
    tasks = {r["file"].rsplit("/", 1)[1][:10] for r in held}  # part-00000
    assert len(held) >= 128 and len(tasks) <= 5 and max(r["rows"] for r in held) <= 32
    same_rows(store.read(spark, path, clustered=(target, 1)), store.read(spark, path))
    assert opened(store.read(spark, path, symbol="S17", clustered=(target, 1))) <= len(held) / 4


def test_places_on_the_curve(spark):
    pairs = [(5, 3), (65535, 0), (0, 65535), (40000, 123)]
    frame = spark.createDataFrame(pairs, "a int, b int")

    def place(a, b):
        return sum((a >> i & 1) << 2 * i + 1 | (b >> i & 1) << 2 * i for i in range(16))

    assert [r[0] for r in frame.select(store.interleaved(F.col("a"), F.col("b"))).collect()] == [place(*p) for p in pairs]
