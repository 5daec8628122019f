"""The two layouts of the history step against loops, and the plans they give."""

import random
from datetime import timedelta

import pytest
from helpers import BASE, START, bar_frame, between, brute_force, random_bars, same_rows, series, whole
from pyspark.sql import functions as F

from barflow.operators.enrich import add_history, enrich, enrich_range
from barflow.plans.queries import queries, user_day_bars
from barflow.schema import HISTORY_COLUMNS
from barflow.sources.bars import packed


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    # One symbol holds more than a third of all rows; some have fewer rows than the frame.
    return (
        random_bars(rng, ["HOT"], 1500) + random_bars(rng, [f"S{i}" for i in range(10)], 150)
        + random_bars(rng, ["T1", "T2"], 7)
    )


def test_history_equals_loops(spark, rows):
    expected = brute_force(rows)
    found = add_history(bar_frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert tuple(row[c] for c in HISTORY_COLUMNS.names) == expected[row["symbol"], row["timestamp"]]


@pytest.mark.parametrize("chunk", ["1 minute", "3 minutes", "1 hour", "1 day", "1000 days"])
def test_chunks_equal_whole_series(spark, rows, chunk):
    bars = bar_frame(spark, rows)
    same_rows(enrich(bars, chunk=chunk), whole(bars))


def test_chunks_with_ties_and_extra_columns(spark, rows):
    bars = bar_frame(spark, [r for r in rows if r[0] != "HOT"])
    twice = bars.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns({
        "close": F.col("close") + F.col("copy"), "note": F.lit("kept"),
    })
    same_rows(enrich(twice, ["copy"], chunk="20 minutes"), whole(twice, ["copy"]))


def test_chunks_with_a_bar_column_as_tie_break(spark):
    rows = [("A", START + timedelta(minutes=i // 3), 1.0, 2.0, 0.5, float(i), i) for i in range(200)]
    bars = bar_frame(spark, rows)
    same_rows(enrich(bars, ["close"], chunk="10 minutes"), whole(bars, ["close"]))


def test_chunks_take_times_without_zone(spark, rows):
    bars = bar_frame(spark, rows).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    same_rows(enrich(bars, chunk="1 hour"), whole(bars))


def test_chunks_keep_rows_without_symbol_or_time(spark, rows):
    odd = [(None, START, 1.0, 1.0, 1.0, 1.0, 5), ("S1", None, 1.0, 1.0, 1.0, 1.0, 5)]
    bars = bar_frame(spark, rows + odd)
    same_rows(enrich(bars, chunk="1 hour"), whole(bars))


@pytest.mark.parametrize("chunk", [None, "2 hours"])
@pytest.mark.parametrize("lookback", [None, "20 minutes", "5 hours", "900 days"])
def test_range_equals_full_series(spark, rows, chunk, lookback):
    bars = bar_frame(spark, rows)
    start, end = (F.lit(START + timedelta(hours=h)) for h in (5, 30))
    ts = F.col("timestamp")
    found = enrich_range(between(bars), start, end, chunk=chunk, lookback=lookback)
    same_rows(found, whole(bars).filter((ts >= start) & (ts < end)))


def test_older_bars_are_read_only_when_needed(spark, tmp_path):
    rows = series("A", [BASE] * 300) + series("B", [BASE] * 300)
    bar_frame(spark, rows).write.parquet(str(tmp_path / "bars"))
    bars = spark.read.parquet(str(tmp_path / "bars"))
    start, end = (F.lit(START + timedelta(minutes=m)) for m in (200, 300))
    scans = {}
    for lookback in ("10 minutes", "30 minutes"):
        found = enrich_range(between(bars), start, end, chunk=None, lookback=lookback)
        assert len(found.collect()) == 200
        scans[lookback] = plan(found).split("Initial Plan")[0].count("FileScan")
    assert scans["30 minutes"] < scans["10 minutes"]


def test_chunks_spread_a_hot_symbol(spark):
    rows = series("HOT", [BASE] * 4000) + [
        r for i in range(40) for r in series(f"S{i}", [BASE] * 200)]
    bars = bar_frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        largest = {
            chunk: max(
                r["count"] for r in enrich(bars, chunk=chunk)
                .groupBy(F.spark_partition_id())
                .agg(F.count("avg_volume_20").alias("count")).collect()
            ) for chunk in (None, "100 minutes")
        }
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert largest[None] >= 4000
    assert largest["100 minutes"] < len(rows) / 4


def test_one_window_per_series(spark):
    text = plan(whole(user_day_bars(spark, "/root/testdata/sf0.001")))
    assert text.count("Window [") == 1
    assert text.count("hashpartitioning(symbol") == 2
    assert text.count("HashAggregate") == 2


def test_symbol_filter_reaches_the_scan(spark, rows, tmp_path):
    bar_frame(spark, rows).write.parquet(str(tmp_path / "bars"))
    bars = spark.read.parquet(str(tmp_path / "bars"))
    text = plan(whole(bars).filter(F.col("symbol") == "HOT").select("symbol", "avg_volume_20"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "EqualTo(symbol,HOT)" in scan
    assert "high" not in scan.split("ReadSchema")[1]


def test_range_bounds_reach_the_scan(spark, rows, tmp_path):
    bar_frame(spark, rows).write.parquet(str(tmp_path / "bars"))
    bars = spark.read.parquet(str(tmp_path / "bars"))
    start, end = (F.lit(START + timedelta(hours=h)) for h in (5, 30))
    scans = [l for l in plan(enrich_range(between(bars), start, end)).splitlines() if "FileScan" in l]
    pushed = [l.split("PushedFilters")[1] for l in scans]
    assert "LessThan(timestamp,2024-01-01 05:00:00.0)" in pushed[0]
    assert "GreaterThanOrEqual(timestamp,2024-01-01 05:00:00.0), LessThan(" in pushed[1]


def test_weekly_bars_are_hashed(spark):
    text = plan(queries()["bars_supplier_week"](spark, "/root/testdata/sf0.001"))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


@pytest.mark.parametrize("name, scans", [("enriched_range", 2), ("enriched_range_lookback", 3)])
def test_range_bounds_reach_the_raw_time(spark, name, scans):
    text = plan(queries()[name](spark, "/root/testdata/sf0.001"))
    found = [line for line in text.splitlines() if "FileScan" in line]
    assert len(found) <= scans
    assert all("LessThan(l_shipdate,199" in line for line in found)
    assert any("GreaterThanOrEqual(l_shipdate,199" in line for line in found)


def test_packed_numbers_never_wrap(spark):
    rows = spark.createDataFrame([(5, 7), (5, 99), (-3, 0)], "a long, b long")
    order = packed([(F.col("a"), 3), (F.col("b"), 2)])
    assert [int(r[0]) for r in rows.select(order).collect()] == [507, 599, -300]
    for bad in ((5, 100), (1000, 0), (5, -1), (None, 0)):
        with pytest.raises(Exception, match="more digits"):
            spark.createDataFrame([bad], "a long, b long").select(order).collect()


def test_watch_list_is_applied_before_bars_are_built(spark):
    lines = plan(queries()["bars_symbol_subset"](spark, "/root/testdata/sf0.001")).splitlines()
    join = next(i for i, l in enumerate(lines) if "LeftSemi" in l)
    assert any("partial_sum" in l for l in lines[:join])


def test_tails_are_limited_before_the_exchange(spark):
    text = plan(queries()["enriched_bars_chunked"](spark, "/root/testdata/sf0.001"))
    assert "WindowGroupLimit" in text
    assert "hashpartitioning(symbol" in text and "_chunk" in text


def test_stored_bars_are_read_and_dealt_by_chunk_once(spark, rows, tmp_path):
    bars = bar_frame(spark, rows).withColumn("fetch_time", F.col("timestamp"))
    bars.write.parquet(str(tmp_path / "bars"))
    found = enrich(spark.read.parquet(str(tmp_path / "bars")), chunk="1 day")
    same_rows(found.drop("fetch_time"), whole(bar_frame(spark, rows)))
    found.collect()
    final = plan(found).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    assert found.filter(F.col("fetch_time") != F.col("timestamp")).isEmpty()


def test_copies_are_combined_by_hashing_before_the_exchange(spark):
    text = plan(queries()["signal_monitor_messages"](spark, "/root/testdata/sf0.001"))
    assert "SortAggregate" not in text
    assert "partial_max_by(open" in text


def test_rules_run_once_under_the_signal_checks(spark):
    text = plan(queries()["trading_signals_rows"](spark, "/root/testdata/sf0.001"))
    assert max(len(line) for line in text.splitlines() if "Filter" in line) < 4000
