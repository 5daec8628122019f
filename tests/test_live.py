"""The live jobs, fed by files in the envelope of a topic."""

import random
from datetime import timedelta

import pytest
from helpers import BASE, START, bar_frame, random_bars, same_rows, series
from pyspark.sql import functions as F

from barflow import sinks
from barflow.operators import quality
from barflow.operators.signals import monitor
from barflow.plans import live
from barflow.plans.flow import signals_of_bars
from barflow.schema import ENVELOPE
from barflow.sources import messages
from barflow.sources.topic import TopicSettings


@pytest.fixture(scope="module")
def rows():
    return random_bars(random.Random(4), ["A", "B", "MUCH TOO LONG"], 90)


@pytest.fixture(scope="module")
def envelope(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("topic") / "in")
    far = series("Z", [BASE], start=START + timedelta(days=900))
    messages.encode(bar_frame(spark, rows + far)).coalesce(1).write.parquet(folder)
    return spark.readStream.schema(ENVELOPE).parquet(folder)


@pytest.fixture(scope="module")
def signals(spark, rows):
    return signals_of_bars(bar_frame(spark, rows), chunk=None)


def test_one_job_feeds_every_target(spark, envelope, signals, tmp_path, capsys, monkeypatch):
    """Console, files and the table; the database writer is replaced: no database runs in the tests."""
    seen = []

    def writer(connection, name, key):
        assert (connection["url"], name, key) == ("jdbc:x", "trading_signals", sinks.SIGNAL_KEY)
        return lambda batch, number: seen.append(batch.toPandas())

    monkeypatch.setattr(live.sinks, "jdbc_writer", writer)
    targets = [
        live.monitor_writer(5), sinks.signal_store_writer(str(tmp_path / "signals")),
        live.signal_table_writer({"url": "jdbc:x"}, str(tmp_path / "rejects")),
    ]
    live.start_signals(
        envelope, str(tmp_path / "bars"), targets, str(tmp_path / "cp"), "1 hour", "1 second", once=True
    ).awaitTermination()
    stored = sinks.read_signals(spark, str(tmp_path / "signals"))
    same_rows(monitor(stored), monitor(signals))
    rejected = spark.read.parquet(str(tmp_path / "rejects"))
    assert len(seen[0]) + rejected.count() == signals.count()
    reasons = {r[0] for r in rejected.select(quality.REASON).distinct().collect()}
    assert "symbol too long" in reasons and "close_price" in seen[0].columns
    assert f"Batch 1: {signals.count()} rows" in capsys.readouterr().out


def test_bar_table_and_its_rejects(spark, envelope, rows, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(live.sinks, "jdbc_writer", lambda *a: lambda batch, number: seen.append(batch.toPandas()))
    query = live.start_bar_table(envelope, {"url": "jdbc:x"}, str(tmp_path / "rejects"), str(tmp_path / "cp"), "1 hour")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rejected = spark.read.parquet(str(tmp_path / "rejects"))
    assert sum(map(len, seen)) + rejected.count() == len(rows)
    assert {r[0] for r in rejected.select(quality.REASON).distinct().collect()} == {"symbol too long", "no volume"}


def test_rejects_are_stored_by_reason_with_their_message(spark, tmp_path):
    good = messages.encode(bar_frame(spark, series("A", [BASE] * 3)))
    bad = good.withColumn("value", F.substring("value", 1, 5))
    good.unionByName(bad).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ENVELOPE).parquet(str(tmp_path / "in"))
    query = live.start_reject_files(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    stored = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["reject_reason"], bytes(r["message_value"])) for r in stored] == [("malformed", b'{"sym')] * 3


def test_publisher_needs_the_connector(spark, envelope, tmp_path):
    with pytest.raises(Exception, match="kafka"):
        live.start_publisher(messages.bars_of(messages.parse(envelope)), TopicSettings(), str(tmp_path))
