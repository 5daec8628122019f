"""Streams against the batch result, whatever the order of arrival and across restarts."""

import random
from datetime import timedelta

import pytest
from helpers import BASE, START, bar_frame, random_bars, same_rows, series, whole
from pyspark.sql import functions as F

from barflow import sinks
from barflow.operators.signals import monitor
from barflow.plans.flow import bars_of_messages, signal_stream, signals_of_bars
from barflow.schema import BAR_COLUMNS, ENVELOPE
from barflow.sources import bars as bs
from barflow.sources import messages
from barflow.streaming.history import ROUND, history_rounds, late_bars, settled
from barflow.streaming.run import drain_to_end, run_once

FAR = START + timedelta(days=3000)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return random_bars(rng, ["HOT"], 400) + random_bars(rng, ["A", "B", "C"], 60)


def sentinel():
    """A bar far ahead, of a symbol of its own: it lets the watermark pass all others."""
    return series("Z", [BASE], start=FAR)


def send(spark, rows, folder, sent_at=None):
    sent = messages.encode(bar_frame(spark, rows), F.col("timestamp"), F.lit(sent_at) if sent_at else F.col("timestamp"))
    sent.coalesce(1).write.mode("append").parquet(str(folder))


def envelope(spark, folder, files=1):
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files).parquet(str(folder))


def go_on(spark, path, delay, chunk="30 minutes", lookback=None, files=1):
    """Work off what has arrived in ``path/in``; the enriched bars so far."""
    bars, _ = bars_of_messages(envelope(spark, path / "in", files))
    run = history_rounds(str(path / "bars"), [sinks.batch_folder_writer(str(path / "out"))], chunk, lookback)
    run_once(sinks.each_batch(settled(bars, delay), run, str(path / "cp"), "rounds"))
    return spark.read.parquet(str(path / "out"))


def enriched(frame):
    return whole(frame).drop("fetch_time")


def plain(found):
    return found.filter("symbol <> 'Z'").drop("batch_id", "fetch_time", "kafka_timestamp", "processing_time")


def test_any_arrival_order_gives_the_batch_result(spark, rows, tmp_path):
    shuffled = random.Random(1).sample(rows, len(rows))
    for part in [*[shuffled[i::4] for i in range(4)], sentinel()]:
        send(spark, part, tmp_path / "in")
    same_rows(plain(go_on(spark, tmp_path, "2000 days")), enriched(bar_frame(spark, rows)))


@pytest.mark.parametrize("chunk, lookback", [(None, None), ("30 minutes", "40 minutes")])
def test_restarts_continue_the_series(spark, rows, tmp_path, chunk, lookback):
    ordered = sorted(rows, key=lambda r: r[1])
    size = len(ordered) // 3 + 1
    before = 0
    for part in [*[ordered[i:i + size] for i in range(0, len(ordered), size)], sentinel()]:
        send(spark, part, tmp_path / "in")
        found = go_on(spark, tmp_path, "1 second", chunk, lookback)
        assert found.count() > before
        before = found.count()
    same_rows(plain(found), enriched(bar_frame(spark, rows)))


def test_a_round_run_again_gives_the_same_rows(spark, rows, tmp_path):
    ordered = sorted(rows, key=lambda r: r[1])
    run = history_rounds(str(tmp_path / "bars"), [sinks.batch_folder_writer(str(tmp_path / "out"))], None, None)
    empty = bar_frame(spark, [])
    for number, part in enumerate((ordered[:200], [], ordered[200:])):
        frame = bar_frame(spark, part) if part else empty
        run(frame, number)
        run(frame, number)
    run(bar_frame(spark, ordered[200:]), 2)
    same_rows(spark.read.parquet(str(tmp_path / "out")).drop(ROUND), whole(bar_frame(spark, rows)))


def test_every_sink_gets_every_round(spark, rows, tmp_path):
    seen = []
    run = history_rounds(str(tmp_path / "bars"), [
        lambda batch, number: seen.append(("a", number, batch.count())),
        lambda batch, number: seen.append(("b", number, batch.count()))], None, None)
    run(bar_frame(spark, rows), 0)
    assert seen == [("a", 0, len(rows)), ("b", 0, len(rows))]


def test_waiting_bars_close_to_the_watermark_are_not_lost(spark, tmp_path):
    rows = series("A", [BASE] * 40, step=timedelta(microseconds=500))
    for part in (rows[:15], rows[15:], sentinel()):
        send(spark, part, tmp_path / "in")
    same_rows(plain(go_on(spark, tmp_path, "5 milliseconds")), enriched(bar_frame(spark, rows)))


def test_late_bars_are_dropped_and_counted(spark, tmp_path):
    day = START + timedelta(days=9)
    for rows in (series("A", [BASE] * 3, start=day), series("A", [BASE] * 3, start=day + timedelta(hours=1)),
                 series("A", [BASE] * 2)):
        send(spark, rows, tmp_path / "in")
    bars, _ = bars_of_messages(envelope(spark, tmp_path / "in"))
    query = (
        settled(bars, "1 hour").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert late_bars(query) == 2


def test_messages_with_repeats_and_damage_over_many_rounds(spark, rows, tmp_path):
    """Each part repeats the end of the one before; the copy sent last counts. Nothing is filtered
    for a table: volumes may be missing and symbols long."""
    rows = [("A LONG SYMBOL" if r[0] == "B" else r[0], *r[1:]) for r in rows]
    ordered = sorted(rows, key=lambda r: r[1])
    size = len(ordered) // 4 + 1
    parts = [ordered[i:i + size] for i in range(0, len(ordered), size)]
    for number, part in enumerate(parts):
        later = START + timedelta(days=number + 1)
        if number:
            draft = [(*r[:5], 1.0, r[6]) for r in part[:5]]
            send(spark, draft, tmp_path / "in", later - timedelta(hours=1))
            send(spark, parts[number - 1][-5:], tmp_path / "in", later - timedelta(hours=1))
        send(spark, random.Random(number).sample(part, len(part)), tmp_path / "in", later)
    send(spark, sentinel(), tmp_path / "in")
    bad = messages.encode(bar_frame(spark, rows[:5])).withColumn("value", F.substring("value", 1, 9))
    bad.write.mode("append").parquet(str(tmp_path / "in"))
    run_once(signal_stream(
        envelope(spark, tmp_path / "in"), str(tmp_path / "bars"), "100 hours",
        [sinks.batch_folder_writer(str(tmp_path / "out"))], str(tmp_path / "cp"), "signals", "1 second"))
    found = spark.read.parquet(str(tmp_path / "out"))
    same_rows(monitor(found.filter("symbol <> 'Z'")), monitor(signals_of_bars(bar_frame(spark, rows), chunk=None)))
    assert {"kafka_timestamp", "fetch_time", "signal_context"} <= set(found.columns)
    assert bars_of_messages(spark.read.schema(ENVELOPE).parquet(str(tmp_path / "in")))[1].count() == 5


def test_bars_and_messages_give_the_same_signals(spark):
    """A breakout of a long symbol, and one missing volume before another breakout."""
    up = (100.0, 104.0, 99.5, 103.0, 400)
    rows = series("ELEVENCHARS", [*[BASE] * 25, up]) + series("A", [*[BASE] * 24, (*BASE[:4], None), up])
    bars = bar_frame(spark, rows)
    accepted, rejected = bars_of_messages(messages.encode(bars))
    assert rejected.isEmpty()
    same_rows(
        monitor(signals_of_bars(messages.last_copies(accepted).select(BAR_COLUMNS))), monitor(signals_of_bars(bars)))


def test_streamed_bars_equal_built_bars(spark, tmp_path):
    rng = random.Random(9)
    trades = [
        (f"S{rng.randrange(3)}", START + timedelta(seconds=rng.randrange(9 * 86400)),
         float(rng.randrange(100)), rng.randrange(50), i) for i in range(3000)
    ]
    schema = "symbol string, ts timestamp, price double, quantity long, id long"
    frame = spark.createDataFrame(trades, schema)
    far = spark.createDataFrame([("Z", FAR, 1.0, 1, 0)], schema)
    order = bs.time_then_id("ts", "id")
    for unit, length, offset in (("day", "1 day", "0 seconds"), ("week", "7 days", "4 days")):
        folder = str(tmp_path / unit / "in")
        frame.write.parquet(folder)
        found = drain_to_end(
            lambda: bs.build_bars_stream(
                spark.readStream.schema(schema).parquet(folder), length, order, "1 hour", offset),
            lambda: far.write.mode("append").parquet(folder), str(tmp_path / unit / "out"))
        same_rows(found, bs.build_bars(frame, unit, order))
