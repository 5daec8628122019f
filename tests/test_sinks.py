"""Sinks: replays add nothing, stored signals are pruned, options are as declared.

No database runs here: the append is tested on files, the database part on its options.
"""

import random
import time
from datetime import date, timedelta

import pytest
from helpers import BASE, START, bar_frame, random_bars, same_rows, series
from pyspark.sql import functions as F

from barflow import sinks
from barflow.operators.signals import monitor
from barflow.plans.flow import signals_of_bars
from barflow.schema import BAR
from barflow.session import work_dir


@pytest.fixture(scope="module")
def signals(spark):
    rows = random_bars(random.Random(3), [f"S{i}" for i in range(8)], 120)
    return monitor(signals_of_bars(bar_frame(spark, rows))).cache()


def file_writer(path, key):
    def read_target(spark, span):
        return spark.read.schema(BAR).parquet(path).filter(span.holds())

    return sinks.append_once(
        read_target, lambda rows: rows.write.mode("append").parquet(path), key)


def test_append_once(spark, tmp_path):
    path = str(tmp_path / "table")
    bar_frame(spark, []).write.parquet(path)
    write = file_writer(path, sinks.BAR_KEY)
    first = bar_frame(spark, series("A", [BASE] * 5))
    more = bar_frame(spark, series("A", [BASE] * 8) + series("B", [BASE] * 2))
    write(first, 0)
    write(first, 0)
    assert spark.read.parquet(path).count() == 5
    write(more, 1)
    write(more.unionByName(more), 1)
    write(bar_frame(spark, []), 2)
    same_rows(spark.read.parquet(path), more)


def test_part_of_a_batch_already_written(spark, tmp_path):
    path = str(tmp_path / "table")
    whole = bar_frame(spark, series("A", [BASE] * 6))
    whole.limit(2).write.parquet(path)
    file_writer(path, sinks.BAR_KEY)(whole, 0)
    same_rows(spark.read.parquet(path), whole)


def test_batch_folder_replay(spark, tmp_path):
    write = sinks.batch_folder_writer(str(tmp_path))
    frame = bar_frame(spark, series("A", [BASE] * 4))
    for number in (0, 0, 1):
        write(frame, number)
    found = spark.read.parquet(str(tmp_path))
    assert {r["batch_id"]: r["count"] for r in found.groupBy("batch_id").count().collect()} == {0: 4, 1: 4}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_stored_signals_read_back(spark, signals, tmp_path):
    path = str(tmp_path / "signals")
    sinks.write_signals(signals, path)
    columns = signals.columns
    same_rows(sinks.read_signals(spark, path).select(columns), signals)
    sells = sinks.read_signals(spark, path, kind="SELL")
    same_rows(sells.select(columns), signals.filter("signal = 'SELL'"))
    assert "isnotnull(signal" in plan(sells).split("PartitionFilters")[1]
    start, end = F.lit(START + timedelta(hours=1)), F.lit(START + timedelta(hours=20))
    some = sinks.read_signals(spark, path, symbol="S1", start=start, end=end)
    ts = F.col("timestamp")
    same_rows(some.select(columns), signals.filter((ts >= start) & (ts < end) & (F.col("symbol") == "S1")))
    scan = plan(some)
    assert "EqualTo(symbol,S1)" in scan and "GreaterThanOrEqual(timestamp" in scan
    assert "day#" in scan.split("PartitionFilters")[1]


def test_a_batch_written_again_replaces_itself(spark, signals, tmp_path):
    write = sinks.signal_store_writer(str(tmp_path / "s"))
    half = signals.filter("symbol < 'S4'")
    for rows, number in ((half, 0), (signals.filter("symbol >= 'S4'"), 1), (half, 0)):
        write(rows, number)
    same_rows(sinks.read_signals(spark, str(tmp_path / "s")).select(signals.columns), signals)


def test_compacted_days(spark, signals, tmp_path):
    live, old = str(tmp_path / "live"), str(tmp_path / "old")
    write = sinks.signal_store_writer(live)
    for i in range(4):
        write(signals.filter(F.pmod(F.hash("symbol"), F.lit(4)) == i), i)
    days = sorted(r[0] for r in signals.select(F.to_date("timestamp")).distinct().collect())
    assert len(days) > 1
    sinks.compact_signals(spark, live, old, days[0])
    sinks.compact_signals(spark, live, old, days[0])
    found = sinks.read_signals(spark, live, compacted=(old, days[1]))
    same_rows(found.select(signals.columns), signals)
    assert len(spark.read.parquet(old).inputFiles()) < len(
        spark.read.parquet(live).filter(F.col("day") == F.lit(days[0])).select("day").inputFiles())


def test_signals_since_reads_its_days_once(spark, signals, tmp_path):
    path = str(tmp_path / "signals")
    assert sinks.newest_day(spark.createDataFrame([], "day date")) is None
    sinks.write_signals(signals, path)
    found = sinks.signals_since(sinks.read_signals(spark, path), 1)
    newest = signals.agg(F.max("timestamp")).first()[0]
    same_rows(found.select(signals.columns), signals.filter(F.col("timestamp") >= F.lit(newest - timedelta(days=1))))
    text = plan(found)
    assert text.count("FileScan") == 1 and "day#" in text.split("PartitionFilters")[1].split("PushedFilters")[0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_the_drivers_zone_plays_no_part(spark, tmp_path, monkeypatch, zone):
    """An hour that the clock of New York repeats; the session reads times as UTC."""
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        rows = spark.sql(
            "SELECT 'A' AS symbol, timestamp_seconds(1730611800 + 600 * id) AS timestamp, 1D AS open, 1D AS high, "
            "1D AS low, 1D AS close, 1L AS volume FROM range(12)")
        span = sinks.time_range(rows)
        assert (span.first, span.last) == (1730611800000000, 1730618400000000)
        assert span.first_text == "2024-11-03 05:30:00.000000"
        path = str(tmp_path / "bars")
        rows.filter("false").write.parquet(path)
        write = file_writer(path, sinks.BAR_KEY)
        for number in range(2):
            write(rows, number)
        assert spark.read.parquet(path).count() == 12
        sinks.write_signals(rows.withColumn("signal", F.lit("BUY")), str(tmp_path / "s"))
        assert sinks.signals_since(sinks.read_signals(spark, str(tmp_path / "s")), 0).count() == 1
        assert sinks.newest_day(sinks.read_signals(spark, str(tmp_path / "s"))) == date(2024, 11, 3)
    finally:
        monkeypatch.undo()
        time.tzset()


def test_console_monitor(spark, tmp_path):
    bar_frame(spark, series("A", [BASE] * 3)).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(BAR).parquet(str(tmp_path / "in"))
    query = sinks.console(stream, str(tmp_path / "cp")).start()
    try:
        deadline = time.monotonic() + 60
        while not query.recentProgress and time.monotonic() < deadline:
            time.sleep(0.2)
        assert query.name == "signal_monitor"
        assert query.recentProgress[0].numInputRows == 3
        assert "Console" in query.recentProgress[0].sink.description
    finally:
        query.stop()


def test_database_read_is_split_by_time():
    span = sinks.TimeRange(0, 1, "2024-01-01 00:00:00.000000", "2024-01-02 03:04:05.000600")
    options = sinks.jdbc_read_options({"url": "jdbc:x", "user": "u"}, "trading_signals", span, 4)
    assert options == {
        "url": "jdbc:x", "user": "u", "dbtable": "trading_signals", "partitionColumn": "timestamp",
        "lowerBound": "2024-01-01 00:00:00.000000", "upperBound": "2024-01-02 03:04:05.000600",
        "numPartitions": "4",
    }


def test_work_folder_is_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and one.startswith(base + "/x-")
