"""Bar messages: encode to and decode from the topic envelope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.schema import BAR_COLUMNS, ENVELOPE, MESSAGE_BODY, MESSAGE_COLUMNS
from barflow.sources.bars import packed


def iso(time: Column) -> Column:
    """ISO-8601 text without zone, microseconds kept."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def encode(
    bars: DataFrame, fetch_time: Column | None = None, sent_at: Column | None = None
) -> DataFrame:
    """Bars as messages: the symbol as key, a JSON object as value, the time of sending.

    Both times default to now. An empty or missing symbol gives a NULL key.
    """
    fetched = F.current_timestamp() if fetch_time is None else fetch_time
    sent = F.current_timestamp() if sent_at is None else sent_at
    body = F.to_json(F.struct(
        "symbol", iso(F.col("timestamp")).alias("timestamp"), *BAR_COLUMNS[2:],
        iso(fetched).alias("fetch_time"),
    ))
    key = F.when(F.col("symbol") != "", F.col("symbol").cast("binary"))
    return bars.select(
        key.alias("key"), body.cast("binary").alias("value"), sent.alias("timestamp")
    )


def parse(messages: DataFrame) -> DataFrame:
    """Flatten message bodies and read their times; the message itself stays beside them.

    A body that is no JSON object, or a field of another type, gives NULL; so does unreadable
    time text, with ANSI mode on or off. ``operators.quality`` sorts such rows out.

    The body is unpacked as a one-element array: a later filter on its fields then stays above
    the JSON parser, where it would otherwise be pushed down with a copy of it per field.
    """
    body = F.from_json(F.col("value").cast("string"), MESSAGE_BODY)
    message = [
        (F.col(c) if c in messages.columns else F.lit(None)).cast(ENVELOPE[c].dataType).alias(name)
        for c, name in zip(("key", "value", "partition", "offset"), MESSAGE_COLUMNS)
    ]
    return (
        messages.select(
            F.col("timestamp").alias("kafka_timestamp"), *message, F.inline(F.array(body)))
        .select(
            "symbol", F.try_to_timestamp("timestamp").alias("timestamp"),
            *BAR_COLUMNS[2:], "fetch_time", "kafka_timestamp",
            F.current_timestamp().alias("processing_time"), *MESSAGE_COLUMNS,
        )
    )


ACCEPTED, ABSENT, WRONG = "accepted", "absent", "wrong"
#: The fields of a body as the text that they arrived as.
RAW_BODY = T.StructType([T.StructField(f.name, T.StringType()) for f in MESSAGE_BODY])
TIMES = ["timestamp", "fetch_time"]


def field_states(messages: DataFrame) -> DataFrame:
    """Every field of every message: was it accepted, absent, or wrong, and the text that it arrived as.

    A field is wrong if it has a text that is not of its type: a price or volume that is no number of
    that kind, a time that cannot be read. A body that is no JSON object has no fields: all are absent.
    Works on tables and on streams; the body is read twice, once by type and once as text.
    """
    text = F.col("value").cast("string")
    read = messages.select(
        F.col("timestamp").alias("kafka_timestamp"),
        *[(F.col(c) if c in messages.columns else F.lit(None)).cast(ENVELOPE[c].dataType).alias(name)
          for c, name in zip(("key", "value", "partition", "offset"), MESSAGE_COLUMNS)],
        F.from_json(text, MESSAGE_BODY).alias("typed"), F.from_json(text, RAW_BODY).alias("raw"))

    def state(field: str) -> Column:
        value = F.col(f"typed.{field}")
        value = F.try_to_timestamp(value) if field in TIMES else value
        raw = F.col(f"raw.{field}")
        return F.struct(
            F.lit(field).alias("field"), raw.alias("raw"),
            F.when(raw.isNull(), ABSENT).when(value.isNull(), WRONG).otherwise(ACCEPTED).alias("state"))

    states = F.array(*[state(f.name) for f in MESSAGE_BODY])
    return read.select("kafka_timestamp", *MESSAGE_COLUMNS, F.inline(states))


def field_errors(messages: DataFrame) -> DataFrame:
    """The wrong fields alone, with the message that they came in."""
    return field_states(messages).filter(F.col("state") == WRONG).drop("state")


def bars_of(parsed: DataFrame) -> DataFrame:
    return parsed.select(*BAR_COLUMNS)


def sent_order() -> Column:
    """Order of sending as one number: broker time, then partition and offset.

    Messages without an offset are told apart by a hash of their body instead, so that the order
    in which they are read never matters.
    """
    place = F.col("message_partition") * F.lit(10**15) + F.col("message_offset")
    body = F.pmod(F.xxhash64("message_value"), F.lit(10**18))
    return packed([
        (F.coalesce(F.unix_micros("kafka_timestamp"), F.lit(0)), 17),
        (F.when(F.col("message_offset").isNull(), body)
         .when(F.col("message_offset") < 10**15, place), 18),
    ])


def last_copies(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One bar per symbol and time: of a bar that was sent repeatedly, the copy sent last.

    The messages themselves are left behind but for the columns in ``keep``, which cost a sort if they
    are not of fixed width. Copies are combined before the exchange, so a bar with very many of them is
    no hot spot; all other buffers are of fixed width (``fetch_time`` becomes a timestamp for that). On a
    stream, set the watermark first; a bar then leaves once the watermark has passed it.
    """
    sent = sent_order()
    values = [F.max_by(c, sent).alias(c) for c in BAR_COLUMNS[2:]]
    fetched = F.max_by(F.col("fetch_time").try_cast("timestamp"), sent).alias("fetch_time")
    times = [F.max(c).alias(c) for c in ("kafka_timestamp", "processing_time")]
    kept = [F.max_by(c, sent).alias(c) for c in keep]
    return parsed.groupBy("symbol", "timestamp").agg(*values, fetched, *times, *kept)
