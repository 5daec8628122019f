"""Named queries over the bundled tables. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow import sinks, store
from barflow.functions import rules
from barflow.operators import enrich as en
from barflow.operators import quality
from barflow.operators import signals as sg
from barflow.plans import live
from barflow.plans.flow import (
    bars_of_messages, signal_stream, signals_of_bars, signals_of_messages, signals_of_trades,
)
from barflow.schema import BAR_COLUMNS, ENVELOPE, HISTORY_COLUMNS, MONITOR_COLUMNS, PRICES
from barflow.session import DENSE, utc_session, work_dir
from barflow.sources import bars as bs
from barflow.sources import messages, tables
from barflow.streaming import late, provisional
from barflow.streaming.history import history_rounds, settled
from barflow.streaming.run import drain_to_end, run_once

Query = Callable[[SparkSession, str], DataFrame]

# Event-time delay of the streaming queries, and the time of the record that closes their input.
STREAM_DELAY = "3 days"
FAR = "2200-01-01"
# Days of weekly signals are stored by the quarter.
PERIOD = "quarter"
# Chunk of the split-series query: short enough for several chunks per weekly series.
WEEKLY_CHUNK = "400 days"

FLAGS = ["volume_ratio", "volume_spike", "high_volume_up", "high_volume_down"]
SHAPE = ["body_size", "upper_shadow", "lower_shadow"]
CHANGE = ["price_change", "price_change_pct"]
ENRICHED = [*BAR_COLUMNS, *HISTORY_COLUMNS.names, *SHAPE, *CHANGE, *FLAGS]


def user_day_bars(spark: SparkSession, folder: str) -> DataFrame:
    trades = tables.event_trades(spark, folder)
    return bs.build_bars(trades, "day", bs.time_then_id("ts", "event_id"))


def supplier_week_bars(spark: SparkSession, folder: str) -> DataFrame:
    trades = tables.lineitem_trades(spark, folder)
    return bs.build_bars(trades, "week", tables.supplier_order("week"))


def enriched_calendar_bars(bars: DataFrame) -> DataFrame:
    """Daily and weekly series are short: whole series, no chunks."""
    return en.enrich(bars, chunk=bs.chunk_of("day"))


def calendar_signals(bars: DataFrame) -> DataFrame:
    return signals_of_bars(bars, chunk=bs.chunk_of("day"))


def _weekly(step: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """A query that runs ``step`` on weekly supplier bars and keeps the given columns."""
    return lambda spark, folder: step(supplier_week_bars(spark, folder)).select(*columns)


def _decided_by(rule: str) -> Query:
    def decided(bars: DataFrame) -> DataFrame:
        ruled = enriched_calendar_bars(bars).withColumns(
            {"rule": rules.deciding_rule(), "signal": rules.signal()}
        )
        return ruled.filter(F.col("rule") == rule)

    return _weekly(
        decided, "symbol", "timestamp", "open", "close", "prev_close", "prev_high", "prev_low",
        "volume_ratio", "price_change_pct", "signal",
    )


def _classified(bars: DataFrame) -> DataFrame:
    return sg.classify(enriched_calendar_bars(bars))


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Watch list: the suppliers in credit."""
    return (
        tables.load(spark, folder, "supplier").filter(F.col("s_acctbal") > 0)
        .select(F.concat(F.lit("S"), "s_suppkey").alias("symbol"))
    )


def bars_symbol_subset(spark: SparkSession, folder: str) -> DataFrame:
    return bs.select_symbols(supplier_week_bars(spark, folder), _suppliers(spark, folder))


def _enriched_range(lookback: str | None) -> Query:
    """Two years of enriched weekly bars, with the history from before."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        trades = tables.lineitem_trades(spark, folder)
        start, end = (F.lit(day).cast("timestamp") for day in ("1996-01-01", "1998-01-01"))

        def bars_between(first: Column | None, last: Column) -> DataFrame:
            return bs.build_bars_between(trades, "week", tables.supplier_order("week"), first, last)

        return en.enrich_range(
            bars_between, start, end, chunk=bs.chunk_of("week"), lookback=lookback
        ).select(*ENRICHED)

    return run


def _event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One message per event, sent at the event's time; the bar is the single price."""
    events = tables.event_trades(spark, folder)
    price = F.col("price")
    one_price = events.select(
        "symbol", F.col("ts").alias("timestamp"), price.alias("open"), price.alias("high"),
        price.alias("low"), price.alias("close"), F.col("quantity").alias("volume"),
    )
    return messages.encode(one_price, F.col("timestamp"), sent_at=F.col("timestamp"))


def parse_messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages.parse(_event_messages(spark, folder)).select(
        *BAR_COLUMNS, "fetch_time", "kafka_timestamp"
    )


def json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return messages.bars_of(messages.parse(messages.encode(supplier_week_bars(spark, folder))))


def topic_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars as keyed messages; every seventh user's symbol is empty, the next one's missing.

    A bar keeps its own time, and was fetched later and sent later still.
    """
    bars = user_day_bars(spark, folder)
    user, time = F.substring("symbol", 2, 20).cast("bigint"), F.col("timestamp")
    symbol = F.when(user % 7 == 0, "").when(user % 7 != 1, F.col("symbol"))
    sent = messages.encode(
        bars.withColumn("symbol", symbol), time + F.expr("INTERVAL 90 SECONDS"),
        sent_at=time + F.expr("INTERVAL 2 MINUTES"))
    return sent.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp")


def signal_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """How many signals each symbol has, how many carry both stamps, and how many were decided at or
    after the time at which their message was processed; one decision time for a run."""
    sent = messages.encode(user_day_bars(spark, folder), F.col("timestamp"))
    signals = signals_of_messages(sent, bs.chunk_of("day"))
    processed, decided = F.col("processing_time"), F.col("signal_timestamp")
    return signals.groupBy("symbol").agg(
        F.count("*").alias("signals"), F.count_if(processed.isNotNull() & decided.isNotNull()).alias("stamped"),
        F.count_if(decided >= processed).alias("in_order"), F.countDistinct("signal_timestamp").alias("decision_times"))


def signal_monitor(spark: SparkSession, folder: str) -> DataFrame:
    trades = tables.event_trades(spark, folder)
    return sg.monitor(signals_of_trades(trades, "day", bs.time_then_id("ts", "event_id")))


def signal_monitor_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The signal monitor on a table of messages in which every bar was sent twice."""
    sent = messages.encode(user_day_bars(spark, folder), F.col("timestamp"))
    return sg.monitor(signals_of_messages(sent.unionByName(sent), bs.chunk_of("day")))


def damaged_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Event messages where the event type decides what is wrong with the body."""
    events = tables.load(spark, folder, "events")
    kind, sent = F.col("event_type"), F.col("ts").cast("timestamp")
    quantity = F.get_json_object("props", "$.k").try_cast("bigint")
    body = F.to_json(F.struct(
        F.when(kind != "signup", F.concat(F.lit("U"), "user_id")).alias("symbol"),
        F.when(kind == "view", "not a time").otherwise(messages.iso(sent)).alias("timestamp"),
        *[F.col("value").alias(c) for c in PRICES],
        F.when(kind != "click", quantity).alias("volume"),
    ))
    kept = F.when(kind == "error", 20).otherwise(F.length(body))
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.substring(body, F.lit(1), kept).cast("binary").alias("value"),
        sent.alias("timestamp"),
    )


def dirty_day_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars of which some have no volume and some a symbol too long for the tables."""
    bars = user_day_bars(spark, folder)
    user = F.substring("symbol", 2, 20).cast("bigint")
    return bars.select(
        F.when(user % 7 == 0, F.concat(F.lit("USER-NUMBER-"), user)).otherwise(F.col("symbol")).alias("symbol"),
        "timestamp", *PRICES, F.when(F.dayofmonth("timestamp") % 5 != 0, F.col("volume")).alias("volume"),
    )


def signal_monitor_dirty_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Signals of messages that the tables could not hold: the analysis takes every bar."""
    sent = messages.encode(dirty_day_bars(spark, folder), F.col("timestamp"))
    return sg.monitor(signals_of_messages(sent, bs.chunk_of("day")))


def last_copies_of_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Bars sent twice with other values at the same broker time: the later offset counts."""
    bars = user_day_bars(spark, folder)
    sent = [
        messages.encode(some, F.col("timestamp"), sent_at=F.lit("2024-06-01").cast("timestamp"))
        .withColumns({"partition": F.lit(1), "offset": F.lit(offset).cast("bigint")})
        for offset, some in (
            (20, bars.withColumn("close", F.col("close") + 1)), (10, bars),
            (15, bars.withColumn("volume", F.lit(None).cast("bigint"))),
        )
    ]
    everything = sent[0].unionByName(sent[1]).unionByName(sent[2])
    accepted, _ = bars_of_messages(everything)
    return messages.last_copies(accepted).select(*BAR_COLUMNS)


def bars_coerced(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly bars that arrive as text, the volume with a fraction of zero."""
    bars = supplier_week_bars(spark, folder)
    as_text = {c: F.col(c).cast("string") for c in PRICES}
    raw = bars.withColumns({**as_text, "volume": F.concat(F.col("volume").cast("string"), F.lit(".0"))})
    return bs.coerce_bars(raw)


def bar_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = bars_of_messages(damaged_messages(spark, folder))
    return rejected.select(
        "kafka_timestamp", "symbol", "close", F.col("message_value").cast("string").alias("body"),
        quality.REASON)


def bars_accepted(spark: SparkSession, folder: str) -> DataFrame:
    accepted, _ = bars_of_messages(damaged_messages(spark, folder))
    return accepted.select(*BAR_COLUMNS)


def _checked_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Dirty daily bars, every third symbol's without a fetch time, checked for the bar table."""
    bars = dirty_day_bars(spark, folder)
    fetched = F.when(F.length("symbol") % 3 != 0, F.col("timestamp"))
    accepted, _ = bars_of_messages(messages.encode(bars, fetched))
    return quality.with_stock_reason(messages.last_copies(accepted, ["message_value"]))


def stock_data_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rejects(_checked_bars(spark, folder)).select(
        "symbol", "timestamp", quality.REASON, F.col("message_value").cast("string").alias("body"))


def wrong_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Event messages where the event type decides which field is not of its type."""
    events = tables.load(spark, folder, "events")
    kind, sent = F.col("event_type"), F.col("ts").cast("timestamp")
    price, quantity = F.col("value").cast("string"), F.get_json_object("props", "$.k")
    quoted = F.concat(F.lit('"U'), "user_id", F.lit('"'))
    fields = [
        ("symbol", quoted), ("timestamp", F.when(kind == "view", F.lit('"not a time"')).otherwise(
            F.concat(F.lit('"'), messages.iso(sent), F.lit('"')))),
        ("open", price), ("high", F.when(kind == "purchase", F.lit("true")).otherwise(price)),
        ("low", price), ("close", F.when(kind == "click", quoted).otherwise(price)),
        ("volume", F.when(kind == "signup", F.concat(quantity, F.lit(".5"))).otherwise(quantity)),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), text) for name, text in fields]), F.lit("}"))
    kept = F.when(kind == "error", 20).otherwise(F.length(body))
    return events.select(F.substring(body, F.lit(1), kept).cast("binary").alias("value"), sent.alias("timestamp"))


def bar_field_errors(spark: SparkSession, folder: str) -> DataFrame:
    return messages.field_errors(wrong_fields(spark, folder)).select(
        "kafka_timestamp", F.col("message_value").cast("string").alias("body"), "field", "raw")


def _checked_signals(spark: SparkSession, folder: str) -> DataFrame:
    return quality.with_signal_reason(calendar_signals(user_day_bars(spark, folder)))


def trading_signals_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.trading_signals_rows(quality.valid(_checked_signals(spark, folder)))
    return rows.drop("signal_timestamp")


def signal_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rejects(_checked_signals(spark, folder)).select(
        "symbol", "timestamp", "signal", quality.REASON
    )


def stock_data_rows(spark: SparkSession, folder: str) -> DataFrame:
    bars = supplier_week_bars(spark, folder)
    accepted, _ = bars_of_messages(messages.encode(bars, F.col("timestamp")))
    checked = quality.with_stock_reason(messages.last_copies(accepted))
    return quality.stock_data_rows(quality.valid(checked)).drop("processing_time")


def stored_signals(spark: SparkSession, folder: str) -> str:
    """Folder with the weekly signals, written anew."""
    path = work_dir(spark, "signals")
    sinks.write_signals(calendar_signals(supplier_week_bars(spark, folder)), path, period=PERIOD)
    return path


def signals_by_type(spark: SparkSession, folder: str) -> DataFrame:
    path = stored_signals(spark, folder)
    return sinks.read_signals(spark, path, kind="SELL").select(*MONITOR_COLUMNS)


def signals_symbol_range(spark: SparkSession, folder: str) -> DataFrame:
    """One year of signals of the symbols on the watch list."""
    path = stored_signals(spark, folder)
    start, end = (F.lit(day).cast("timestamp") for day in ("1997-01-01", "1998-01-01"))
    year = sinks.read_signals(spark, path, start=start, end=end, period=PERIOD)
    return bs.select_symbols(year, _suppliers(spark, folder)).select(*MONITOR_COLUMNS)


def signals_since(spark: SparkSession, folder: str) -> DataFrame:
    """Signals of the last 90 days on record."""
    stored = sinks.read_signals(spark, stored_signals(spark, folder))
    return sinks.signals_since(stored, 90, PERIOD).select(*MONITOR_COLUMNS)


#: Rounds of weekly signals in the store with a manifest: the year before which a round ends. A round is
#: created at the start of that year. A file of the clustered copy has so many rows.
ROUNDS = (1995, 1997, 2100)
CLUSTER_ROWS = 256


def _signal_rounds(spark: SparkSession, folder: str) -> list[tuple[DataFrame, Column]]:
    """(signals, time of creation) of each round."""
    path = work_dir(spark, "weekly-signals")
    calendar_signals(supplier_week_bars(spark, folder)).write.parquet(path)
    signals, year = spark.read.parquet(path), F.year("timestamp")
    return [
        (signals.filter((year >= first) & (year < last)), F.lit(f"{last}-01-01").cast("timestamp"))
        for first, last in zip((0, *ROUNDS), ROUNDS)
    ]


def manifest_store(spark: SparkSession, folder: str) -> str:
    """Folder of a store with the weekly signals in rounds."""
    path = work_dir(spark, "signal-store")
    for number, (rows, created) in enumerate(_signal_rounds(spark, folder)):
        store.append(rows, path, number, created)
    return path


def signals_of_symbol_all_time(spark: SparkSession, folder: str) -> DataFrame:
    """All signals of one symbol, from the few files of the clustered copy, made in two steps, that may hold it."""
    path, target = manifest_store(spark, folder), work_dir(spark, "clustered")
    for upto in (1, len(ROUNDS)):
        store.cluster(spark, path, target, upto, CLUSTER_ROWS)
    return store.read(spark, path, symbol="S7", clustered=(target, len(ROUNDS))).select(*MONITOR_COLUMNS)


def signals_created_since(spark: SparkSession, folder: str) -> DataFrame:
    """The signals of the rounds created in 1997 or later, whatever their event times."""
    since = F.lit("1997-01-01").cast("timestamp")
    rows = store.read(spark, manifest_store(spark, folder), created_since=since)
    return rows.select(*MONITOR_COLUMNS, store.CREATED)


def signals_appended_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The store after two replays and a crash between staging and commit."""
    path, rounds = work_dir(spark, "replayed"), _signal_rounds(spark, folder)
    store.append(*_round(rounds, 0, path))
    store.stage(*_round(rounds, 1, path))  # never committed
    for number in (0, 1, 0, 1, 2):
        store.append(*_round(rounds, number, path))
    return store.read(spark, path).select(*MONITOR_COLUMNS)


def _round(rounds: list[tuple[DataFrame, Column]], number: int, path: str) -> tuple[DataFrame, str, int, Column]:
    rows, created = rounds[number]
    return rows, path, number, created


def signals_numbered(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of the stored signals, which a replay leaves as they are."""
    path, rounds = work_dir(spark, "numbered"), _signal_rounds(spark, folder)
    for number in (0, 1, 1, 2, 0):
        store.append(*_round(rounds, number, path))
    return store.read(spark, path).select(store.ID, *sinks.SIGNAL_KEY)


def _closing_message(spark: SparkSession) -> DataFrame:
    """A bar far behind all others, which lets the watermark pass them and stays open itself."""
    bar = spark.range(1).select(
        F.lit("END").alias("symbol"), F.lit(FAR).cast("timestamp").alias("timestamp"),
        *[F.lit(1.0).alias(c) for c in PRICES], F.lit(0).cast("bigint").alias("volume"))
    return messages.encode(bar, F.col("timestamp"), sent_at=F.col("timestamp"))


def stream_bars_user_day(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars built on a stream of events."""
    base = work_dir(spark, "stream-bars")
    events = tables.load(spark, folder, "events")
    far = spark.createDataFrame([{}], events.schema).withColumn("ts", F.lit(FAR).cast(events.schema["ts"].dataType))
    far.filter("false").write.parquet(f"{base}/closing")

    def bars() -> DataFrame:
        closing = spark.readStream.schema(events.schema).parquet(f"{base}/closing")
        trades = tables.as_event_trades(tables.load_stream(spark, folder, "events").unionByName(closing))
        return bs.build_bars_stream(trades, "1 day", bs.time_then_id("ts", "event_id"), STREAM_DELAY)

    return drain_to_end(bars, lambda: far.write.mode("append").parquet(f"{base}/closing"), f"{base}/out")


def _message_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(ENVELOPE).parquet(folder)


def stream_signal_monitor(spark: SparkSession, folder: str) -> DataFrame:
    """The live form of ``signal_monitor``: messages through parsing, rounds, rules and risk."""
    base = work_dir(spark, "stream-signals")
    sent = messages.encode(user_day_bars(spark, folder), F.col("timestamp"))
    for part in (sent, _closing_message(spark)):
        part.write.mode("append").parquet(f"{base}/messages")
        run_once(signal_stream(
            _message_stream(spark, f"{base}/messages"), f"{base}/bars", STREAM_DELAY,
            [sinks.batch_folder_writer(f"{base}/signals")], f"{base}/checkpoint", "stream_signals",
            sinks.DATABASE_EVERY, chunk=bs.chunk_of("day"),
        ))
    return sg.monitor(spark.read.parquet(f"{base}/signals"))


def live_signal_store(spark: SparkSession, folder: str) -> DataFrame:
    """The stored signals of the live job: it runs on its trigger, is stopped, starts anew on the messages
    that came meanwhile, and at last works off the rest as a bounded job, all on one checkpoint."""
    base = work_dir(spark, "live-signals")
    user_day_bars(spark, folder).write.parquet(f"{base}/table")
    bars = spark.read.parquet(f"{base}/table")
    ends = bars.agg(F.unix_micros(F.min("timestamp")), F.unix_micros(F.max("timestamp"))).first()
    early = F.col("timestamp") < F.timestamp_micros(F.lit(sum(end or 0 for end in ends) // 2))
    parts = [messages.encode(bars.filter(part), F.col("timestamp")) for part in (early, ~early)]
    for part, once in ((parts[0], False), (parts[1], False), (_closing_message(spark), True)):
        part.write.mode("append").parquet(f"{base}/messages")
        query = live.start_signals(
            _message_stream(spark, f"{base}/messages"), f"{base}/bars",
            [sinks.signal_store_writer(f"{base}/signals")], f"{base}/checkpoints", STREAM_DELAY, "1 second",
            "live_signals", once, bs.chunk_of("day"))
        try:
            if once:
                query.awaitTermination()
            else:
                query.processAllAvailable()
        finally:
            query.stop()
    return sg.monitor(sinks.read_signals(spark, f"{base}/signals"))


def stream_enriched_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly bars whose messages arrive in three parts, each enriched by rounds of the batch operator.

    The query is started anew for each part and resumes from its checkpoint.
    """
    base = work_dir(spark, "rounds")
    run = history_rounds(
        f"{base}/bars", [sinks.batch_folder_writer(f"{base}/rows")], chunk=WEEKLY_CHUNK)
    bars, year = supplier_week_bars(spark, folder), F.year("timestamp")  # a part is built from its own trades
    parts = [messages.encode(bars.filter(part), F.col("timestamp"))
             for part in (year < 1997, (year >= 1997) & (year < 1999), year >= 1999)]
    for part in (*parts, _closing_message(spark)):
        part.write.mode("append").parquet(f"{base}/messages", compression=DENSE)
        arrived, _ = bars_of_messages(_message_stream(spark, f"{base}/messages"))
        run_once(sinks.each_batch(
            settled(arrived, STREAM_DELAY), run, f"{base}/checkpoint", "enriched_rounds"))
    return spark.read.parquet(f"{base}/rows").select(*ENRICHED)


def stream_late_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars of a stream, settled or too late: those of every fifth user arrive behind all others."""
    base = work_dir(spark, "late-bars")
    sent = messages.encode(user_day_bars(spark, folder), F.col("timestamp"), sent_at=F.col("timestamp"))
    behind = F.substring(F.col("key").cast("string"), 2, 20).cast("bigint") % 5 == 0
    gate = late.gate(f"{base}/gate", STREAM_DELAY)
    for part in (sent.filter(~behind), sent.filter(behind), _closing_message(spark)):
        part.write.mode("append").parquet(f"{base}/messages")
        arrived, _ = bars_of_messages(_message_stream(spark, f"{base}/messages"))
        run_once(sinks.each_batch(arrived, gate, f"{base}/gate-checkpoint", "gate"))
    in_time = late.passed(spark, f"{base}/gate", arrived.schema)
    run_once(sinks.each_batch(
        settled(in_time, STREAM_DELAY), sinks.batch_folder_writer(f"{base}/settled"), f"{base}/checkpoint", "settled"))
    found = spark.read.parquet(f"{base}/settled").select(*BAR_COLUMNS, F.lit(None).cast("timestamp").alias(late.MISSED))
    return found.unionByName(late.late(spark, f"{base}/gate", arrived.schema).select(*BAR_COLUMNS, late.MISSED))


def stream_bars_upserted(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars that show from their first trade on, while events arrive up to two days late."""
    base = work_dir(spark, "provisional")
    events = tables.load(spark, folder, "events")
    first, last = events.agg(F.unix_micros(F.min("ts").cast("timestamp")), F.unix_micros(F.max("ts").cast("timestamp"))).first()
    delayed = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 3 * F.lit(86_400_000_000)
    part = F.floor((delayed - F.lit(first)) / F.lit(max(1, last - first)) * 3)
    for of in (part <= 0, part == 1, part >= 2):
        events.filter(of).write.mode("append").parquet(f"{base}/events")
        trades = tables.as_event_trades(spark.readStream.schema(events.schema).parquet(f"{base}/events"))
        run_once(provisional.start_bars(
            trades, "1 day", bs.time_then_id("ts", "event_id"), STREAM_DELAY, f"{base}/bars", f"{base}/checkpoint"))
    return provisional.current_bars(spark, f"{base}/bars")


def _named() -> dict[str, Query]:
    return {
        "bars_user_day": user_day_bars,
        "bars_supplier_week": supplier_week_bars,
        "latest_bar_per_symbol": _weekly(bs.latest_bar_per_symbol, *BAR_COLUMNS),
        "bars_symbol_subset": bars_symbol_subset,
        "json_round_trip": json_round_trip,
        "parse_messages": parse_messages,
        "topic_messages": topic_messages,
        "bar_rejects": bar_rejects,
        "bars_accepted": bars_accepted,
        "bars_coerced": bars_coerced,
        "last_copies_of_ties": last_copies_of_ties,
        "prev_bar": _weekly(
            en.add_history, "symbol", "timestamp",
            "prev_close", "prev_high", "prev_low", "prev_volume",
        ),
        "trailing_avg_volume": _weekly(
            en.add_history, "symbol", "timestamp", "volume", "avg_volume_20"
        ),
        "candle_shape": _weekly(en.add_candle_shape, "symbol", "timestamp", *SHAPE),
        "price_change": _weekly(enriched_calendar_bars, "symbol", "timestamp", "close", "prev_close", *CHANGE),
        "volume_metrics": _weekly(enriched_calendar_bars, "symbol", "timestamp", "volume", *FLAGS),
        "enriched_bars": _weekly(enriched_calendar_bars, *ENRICHED),
        "enriched_bars_user_day": lambda spark, folder: enriched_calendar_bars(
            user_day_bars(spark, folder)).select(*ENRICHED),
        "enriched_bars_chunked": _weekly(
            lambda bars: en.enrich(bars, chunk=WEEKLY_CHUNK), *ENRICHED
        ),
        "enriched_range": _enriched_range(None),
        "enriched_range_lookback": _enriched_range("200 days"),
        "signal_breakout": _decided_by("breakout"),
        "signal_breakdown": _decided_by("breakdown"),
        "signal_engulf_bull": _decided_by("engulf_bull"),
        "signal_engulf_bear": _decided_by("engulf_bear"),
        "signal_accumulation": _decided_by("accumulation"),
        "signal_distribution": _decided_by("distribution"),
        "signal_all": _weekly(_classified, "symbol", "timestamp", "signal"),
        "signal_strength": _weekly(
            _classified, "symbol", "timestamp", "volume_ratio", "signal_strength"
        ),
        "signal_context_flat": _weekly(_classified, "symbol", "timestamp", "signal_context.*"),
        "signal_actionable": _weekly(
            lambda bars: sg.actionable(_classified(bars)),
            "symbol", "timestamp", "close", "signal", "signal_strength",
        ),
        "risk_levels": _weekly(
            lambda bars: calendar_signals(bars).withColumn(
                "risk_reward_ratio", F.round("risk_reward_ratio", 9)),
            "symbol", "timestamp", "signal", "close", "stop_loss_price", "take_profit_price",
            "risk_reward_ratio",
        ),
        "signal_monitor": signal_monitor,
        "signal_monitor_week": _weekly(calendar_signals, *MONITOR_COLUMNS),
        "signal_monitor_messages": signal_monitor_messages,
        "signal_monitor_dirty_messages": signal_monitor_dirty_messages,
        "signal_stamps": signal_stamps,
        "signal_monitor_chunked": _weekly(
            lambda bars: signals_of_bars(bars, chunk=WEEKLY_CHUNK), *MONITOR_COLUMNS
        ),
        "trading_signals_rows": trading_signals_rows,
        "signal_rejects": signal_rejects,
        "stock_data_rows": stock_data_rows,
        "stock_data_rejects": stock_data_rejects,
        "signals_by_type": signals_by_type,
        "signals_symbol_range": signals_symbol_range,
        "signals_since": signals_since,
        "signals_of_symbol_all_time": signals_of_symbol_all_time,
        "signals_created_since": signals_created_since,
        "signals_appended_twice": signals_appended_twice,
        "signals_numbered": signals_numbered,
        "bar_field_errors": bar_field_errors,
        "stream_late_bars": stream_late_bars,
        "stream_bars_upserted": stream_bars_upserted,
        "stream_bars_user_day": stream_bars_user_day,
        "stream_signal_monitor": stream_signal_monitor,
        "stream_enriched_rounds": stream_enriched_rounds,
        "live_signal_store": live_signal_store,
    }


def queries() -> dict[str, Query]:
    """Every query reads naive event times as UTC, in a session of its own if need be."""
    def in_utc(query: Query) -> Query:
        return lambda spark, folder: query(utc_session(spark), folder)

    return {name: in_utc(query) for name, query in _named().items()}
