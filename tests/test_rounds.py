"""State of streams that does not grow with their age: tails, late rows, provisional bars, field errors."""

import random
from datetime import timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from helpers import BASE, START, bar_frame, random_bars, same_rows, series, whole
from pyspark.sql import functions as F

from barflow import sinks
from barflow.schema import BAR, BAR_COLUMNS, ENVELOPE, MESSAGE_BODY
from barflow.sources import bars as bs
from barflow.sources import messages
from barflow.streaming import history, late, provisional, tails
from barflow.streaming.history import ROUND, history_rounds, settled
from barflow.streaming.run import run_once


def put_round(store, number, rows):
    """Bars of a round as the history step writes them, without Spark."""
    folder = store / f"{ROUND}={number}"
    folder.mkdir(parents=True)
    columns = list(zip(*rows))
    pq.write_table(pa.table({
        "symbol": pa.array(columns[0]), "timestamp": pa.array(columns[1], pa.timestamp("us", "UTC")),
        **{c: pa.array(columns[i], pa.float64()) for i, c in enumerate(BAR_COLUMNS[2:6], 2)},
        "volume": pa.array(columns[6], pa.int64())}), folder / "part.parquet")


def last_bars(rows):
    by_symbol = {}
    for r in sorted(rows, key=lambda r: r[1]):
        by_symbol.setdefault(r[0], []).append((r[1], r[2]))
    return {s: r[-19:] for s, r in by_symbol.items()}


def test_five_hundred_rounds_list_as_many_folders_as_twenty(spark, tmp_path):
    """A symbol in every round, one in every tenth, and one in the first round alone."""
    rows, store = [], str(tmp_path)
    for number in range(500):
        at = START + timedelta(minutes=number)
        new = [("ALL", at, *BASE)] + [("TENTH", at, *BASE)] * (number % 10 == 0) + [("ONCE", at, *BASE)] * (number == 0)
        put_round(tmp_path, number, new)
        tails.write_snapshot(spark, store, BAR, number)
        assert len(tails.folders_before(spark, store, number)) <= tails.EVERY
        if number in (20, 250, 496, 499):
            found = [tuple(r) for r in tails.bars_before(spark, store, BAR, number).collect()]
            assert last_bars(found) == last_bars(rows)
        rows += new
    assert len(list((tmp_path / "_tails").iterdir())) <= 2
    assert tails.bars_before(spark, store, BAR, 500).count() <= 3 * 19 + 2 * tails.EVERY


def test_rounds_with_snapshots_give_the_batch_result_also_when_run_again(spark, tmp_path):
    rows = random_bars(random.Random(3), ["HOT", "A"], 90) + random_bars(random.Random(4), ["LATE"], 5)
    ordered = sorted(rows, key=lambda r: r[1])
    run = history_rounds(str(tmp_path / "bars"), [sinks.batch_folder_writer(str(tmp_path / "out"))], None, every=2)
    size = len(ordered) // 7 + 1
    for number in range(7):
        for _ in range(1 + (number in (2, 4, 5))):
            run(bar_frame(spark, ordered[number * size:(number + 1) * size]), number)
    same_rows(spark.read.parquet(str(tmp_path / "out")).drop(ROUND), whole(bar_frame(spark, rows)))
    same_rows(spark.read.parquet(str(tmp_path / "bars")).drop(ROUND), bar_frame(spark, rows))


def test_a_round_reads_the_columns_of_a_bar_alone_from_earlier_rounds(spark, tmp_path, monkeypatch):
    """The others of a message would be shuffled with bars that never come out."""
    seen, find = [], history.rows_before
    monkeypatch.setattr(history, "rows_before", lambda bars, *args, **named: seen.append(bars.columns) or find(bars, *args, **named))
    rows = series("A", [BASE] * 30)
    run = history_rounds(str(tmp_path / "bars"), [sinks.batch_folder_writer(str(tmp_path / "out"))], "10 minutes")
    for number in range(2):
        part = bar_frame(spark, rows[15 * number:15 * number + 15])
        run(part.withColumn("fetch_time", F.col("timestamp")), number)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert seen[1] == BAR_COLUMNS and found.filter(F.col("fetch_time") == F.col("timestamp")).count() == 30
    same_rows(found.drop(ROUND, "fetch_time"), whole(bar_frame(spark, rows)))


def test_a_store_without_snapshots_is_read_whole(spark, tmp_path):
    for number in range(20):
        put_round(tmp_path, number, [("A", START + timedelta(minutes=number), *BASE)])
    assert tails.bars_before(spark, str(tmp_path), BAR, 20).count() == 20
    assert tails.bars_before(spark, str(tmp_path / "none"), BAR, 3).count() == 0


def test_late_rows_are_kept_with_what_they_missed(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "gate")
    day = START + timedelta(days=9)
    parts = [series("A", [BASE] * 3, start=day), series("A", [BASE] * 2), series("B", [BASE] * 2, start=day),
             [("C", None, *BASE)], series("Z", [BASE], start=day + timedelta(days=900))]
    for part in parts:
        bar_frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(BAR).parquet(folder)
        run_once(sinks.each_batch(stream, late.gate(path, "1 hour"), str(tmp_path / "cp"), "gate"))
    found = late.late(spark, path, BAR)
    same_rows(found.select(BAR_COLUMNS), bar_frame(spark, parts[1]))
    missed = day + timedelta(minutes=2) - timedelta(hours=1)
    assert {r[0] for r in found.select(F.date_format(late.MISSED, "yyyy-MM-dd HH:mm")).collect()} == {f"{missed:%Y-%m-%d %H:%M}"}
    kept = spark.read.schema(BAR).parquet(f"{path}/passed").drop(ROUND)
    same_rows(kept, bar_frame(spark, [r for i, part in enumerate(parts) if i != 1 for r in part]))


def test_a_gate_run_again_splits_as_before(spark, tmp_path):
    run = late.gate(str(tmp_path), "1 hour")
    rounds = [series("A", [BASE] * 3, start=START + timedelta(days=d)) for d in (3, 1, 4)]
    for number, rows in enumerate(rounds):
        run(bar_frame(spark, rows), number)
        run(bar_frame(spark, rows), number)
    run(bar_frame(spark, rounds[1]), 1)
    run(bar_frame(spark, []), 3)
    same_rows(late.late(spark, str(tmp_path), BAR).select(BAR_COLUMNS), bar_frame(spark, rounds[1]))


def test_what_passes_the_gate_is_settled_whole(spark, tmp_path):
    """The stream behind the gate sees several rounds at once, or one at a time, and drops nothing."""
    rng = random.Random(6)
    path, columns = str(tmp_path / "gate"), messages.parse(spark.createDataFrame([], ENVELOPE))
    run = late.gate(path, "3 hours")
    sent = 0
    for number in range(6):
        at = [START + timedelta(hours=4 * number, minutes=rng.randrange(-600, 0)) for _ in range(30)]
        rows = [(f"S{number}-{i}", t, *BASE) for i, t in enumerate(at)]
        run(messages.parse(messages.encode(bar_frame(spark, rows), F.col("timestamp"), F.col("timestamp"))), number)
        sent += len(rows)
    run(messages.parse(messages.encode(bar_frame(spark, series("Z", [BASE], start=START + timedelta(days=99))))), 6)
    for files in (1, 100):
        stream = spark.readStream.schema(columns.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/passed")
        out = str(tmp_path / f"out{files}")
        run_once(sinks.each_batch(settled(stream, "3 hours"), sinks.batch_folder_writer(out), f"{out}-cp", "settled"))
        missed = late.late(spark, path, columns.schema).count()
        assert missed > 5 and spark.read.parquet(out).count() + missed == sent


def test_a_late_trade_replaces_its_bar(spark, tmp_path):
    schema = "symbol string, ts timestamp, price double, quantity long, id long"
    folder, path = str(tmp_path / "in"), str(tmp_path / "bars")
    noon = START + timedelta(hours=12)
    rounds = [
        [("A", noon, 10.0, 1, 2), ("B", noon, 5.0, 1, 3)],
        [("A", noon - timedelta(hours=1), 7.0, 2, 1)],
        [("A", noon + timedelta(days=1), 8.0, 3, 4)],
    ]
    expected = [[("A", 10.0, 10.0, 1), ("B", 5.0, 5.0, 1)], [("A", 7.0, 10.0, 3), ("B", 5.0, 5.0, 1)],
                [("A", 7.0, 10.0, 3), ("A", 8.0, 8.0, 3), ("B", 5.0, 5.0, 1)]]
    order = bs.time_then_id("ts", "id")
    for rows, told in zip(rounds, expected):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        run_once(provisional.start_bars(
            spark.readStream.schema(schema).parquet(folder), "1 day", order, "2 days", path, str(tmp_path / "cp")))
        bars = provisional.current_bars(spark, path)
        assert sorted(tuple(r) for r in bars.select("symbol", "open", "close", "volume").collect()) == told
    every = spark.read.schema(schema).parquet(folder)
    same_rows(provisional.current_bars(spark, path), bs.build_bars(every, "day", order))


def test_versions_are_merged_and_replays_change_nothing(spark, tmp_path):
    path = str(tmp_path)
    write = provisional.versions_writer(path, 3)
    newest = {}
    for number in range(11):
        rows = [(f"S{i}", START, float(number), 1.0, 1.0, 1.0, number) for i in range(number % 4 + 1)]
        newest |= {r[0]: r for r in rows}
        for _ in range(1 + (number % 3 == 0)):
            write(bar_frame(spark, rows), number)
        same_rows(provisional.current_bars(spark, path), bar_frame(spark, list(newest.values())))
    assert len(provisional.current_folders(spark, path)) <= 4
    assert len(list((tmp_path / "rounds").iterdir())) <= 8


def test_a_bar_is_merged_once_a_level_however_old_the_stream(spark, tmp_path):
    """220 rounds, six to a merge: a merge of all rounds so far would write each bar 18 times on average."""
    path, every, rounds, levels = str(tmp_path), 6, 220, 3
    schema = pa.schema([("symbol", pa.string()), ("timestamp", pa.timestamp("us", "UTC")), *[
        (c, pa.float64()) for c in BAR_COLUMNS[2:6]], ("volume", pa.int64()), ("version", pa.int64())])
    newest, written, opened = {}, {}, 0
    for number in range(rounds):
        rows = [(f"S{i}", START + timedelta(minutes=number - late), float(number), 1.0, 1.0, 1.0, number, number)
                for i, late in enumerate((0, 1, number % 50))]
        newest |= {r[:2]: r[:-1] for r in rows}
        folder = tmp_path / "rounds" / f"version={number}"
        folder.mkdir(parents=True)
        pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema), folder / "part.parquet")
        (folder / "_SUCCESS").touch()
        provisional.merge_rounds(spark, path, number, every)
        for merged in (tmp_path / "merged").glob("*/part-*.parquet"):
            written[merged] = pq.read_metadata(merged).num_rows
        opened = max(opened, len(provisional.current_folders(spark, path)))
    assert sum(written.values()) <= levels * 3 * rounds
    assert opened <= levels * (every - 1) + every + 1
    assert len(list((tmp_path / "rounds").iterdir())) <= 2 * every + 1
    assert len(list((tmp_path / "merged").iterdir())) <= 2 * every * levels
    same_rows(provisional.current_bars(spark, path), bar_frame(spark, list(newest.values())))


def test_a_round_that_is_not_written_to_its_end_does_not_show(spark, tmp_path):
    write = provisional.versions_writer(str(tmp_path), 2)
    for number in range(3):
        write(bar_frame(spark, series(f"S{number}", [BASE])), number)
    (tmp_path / "rounds" / "version=2" / "_SUCCESS").unlink()
    (tmp_path / "merged" / "0-2" / "_SUCCESS").unlink()
    seen = provisional.current_bars(spark, str(tmp_path)).select("symbol")
    assert sorted(r[0] for r in seen.collect()) == ["S0", "S1"]
    write(bar_frame(spark, series("S2", [BASE])), 2)
    assert len(provisional.current_folders(spark, str(tmp_path))) == 2
    assert provisional.current_bars(spark, str(tmp_path)).count() == 3


def test_every_field_of_every_message_is_accounted_for(spark):
    bodies = [
        '{"symbol":"A","timestamp":"2024-01-01T00:00:00","open":1,"high":"x","low":true,"close":null,"volume":1.5}',
        '{"symbol":7,"timestamp":"soon","open":{"a":1},"high":2.5,"volume":99999999999999999999,"fetch_time":"2024-01-01"}',
        "no json", "", "[1]", "{}", None, '{"symbol":"A", "open":1',
    ]
    sent = spark.createDataFrame([(None if b is None else b.encode(), START) for b in bodies], "value binary, timestamp timestamp")
    states = messages.field_states(sent)
    assert states.count() == len(bodies) * len(MESSAGE_BODY)
    read = messages.parse(sent)
    typed = sum(read.filter(F.col(c).isNotNull()).count() for c in BAR_COLUMNS) + read.filter(
        F.col("fetch_time").try_cast("timestamp").isNotNull()).count()
    counts = {r[0]: r[1] for r in states.groupBy("state").count().collect()}
    assert counts["accepted"] == typed
    wrong = {(r["field"], r["raw"]) for r in messages.field_errors(sent).collect()}
    assert wrong == {("high", "x"), ("low", "true"), ("volume", "1.5"), ("timestamp", "soon"), ("open", '{"a":1}'),
                     ("volume", "99999999999999999999")}
    assert counts["wrong"] == len(wrong) and sum(counts.values()) == len(bodies) * len(MESSAGE_BODY)
