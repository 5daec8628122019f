"""Provisional bars: a bar shows in the round of its first trade and is replaced as trades arrive.

The aggregation runs in update mode: every round returns the bars that its trades have changed, whole.
They are written under the round's number, which is the bar's version; the newest version of a bar
counts. Rounds are merged by levels: every 16 rounds become one folder, every 16 of these one of the next
level, and so on. So a bar is written anew once a level, however old the stream is, and a reader opens at
most 15 folders of each level. Once the watermark has passed a bar's end it no longer changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from barflow.schema import BAR, BAR_COLUMNS
from barflow.session import children, exists, remove
from barflow.sinks import DATABASE_EVERY, BatchWriter, each_batch
from barflow.sources.bars import build_bars_stream

VERSION = "version"
VERSIONED = T.StructType([*BAR, T.StructField(VERSION, T.LongType())])
#: Folders of a level that become one of the next.
EVERY = 16


def newest_versions(bars: DataFrame) -> DataFrame:
    """One row for each bar, its newest version; combined before the exchange, in buffers of fixed width."""
    version = F.col(VERSION)
    return bars.groupBy("symbol", "timestamp").agg(
        *[F.max_by(c, version).alias(c) for c in BAR_COLUMNS[2:]], F.max(version).alias(VERSION)).select(VERSIONED.names)


def _pieces(spark: SparkSession, path: str) -> dict[int, dict[int, str]]:
    """The folders that are written to their end: by the round after them, then by their first round."""
    found = [(int(n.split("=")[1]), int(n.split("=")[1]) + 1, f"{path}/rounds/{n}") for n in children(spark, f"{path}/rounds")]
    found += [(*map(int, n.split("-")), f"{path}/merged/{n}") for n in children(spark, f"{path}/merged")]
    pieces: dict[int, dict[int, str]] = {}
    for first, after, folder in found:
        if exists(spark, f"{folder}/_SUCCESS"):
            pieces.setdefault(after, {})[first] = folder
    return pieces


def _cover(pieces: dict[int, dict[int, str]], first: int, after: int) -> list[str]:
    """The fewest folders with the rounds from ``first`` up to before ``after``, but for one that is just that."""
    whole, found = (first, after), []
    while after > first:
        starts = [n for n in pieces.get(after, ()) if n >= first and (n, after) != whole]
        if starts:
            found.append(pieces[after][min(starts)])
        after = min(starts, default=after - 1)
    return found


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(VERSIONED).parquet(*folders) if folders else spark.createDataFrame([], VERSIONED)


def current_folders(spark: SparkSession, path: str) -> list[str]:
    """What a reader opens: of each level the merged rounds that no higher one has, and the rounds since."""
    pieces = _pieces(spark, path)
    return _cover(pieces, -1, max(pieces, default=0))


def current_bars(spark: SparkSession, path: str) -> DataFrame:
    """The bars as they are now. A filter on symbol or time reaches the files."""
    return newest_versions(_read(spark, current_folders(spark, path))).select(*BAR_COLUMNS)


def merge_rounds(spark: SparkSession, path: str, number: int, every: int = EVERY) -> None:
    """Merge what is due once all rounds before ``number`` are written: level by level, the last ``every``
    folders of a level become one of the next.

    What is merged already is left alone. Folders whose rounds are in a larger one since the merge before are
    removed, so a reader that has listed them can still open them.
    """
    if not number or number % every:
        return
    size = every
    while number % size == 0:
        pieces, first = _pieces(spark, path), number - size
        if first not in pieces.get(number, ()):
            merged = newest_versions(_read(spark, _cover(pieces, first, number)))
            merged.write.mode("overwrite").parquet(f"{path}/merged/{first}-{number}")
        size *= every
    known = [(first, after, folder) for after, found in _pieces(spark, path).items() for first, folder in found.items()]
    settled = [(first, after) for first, after, _ in known if after <= number - every]
    for first, after, folder in known:
        if any(x <= first and after <= y and (x, y) != (first, after) for x, y in settled):
            remove(spark, folder)


def versions_writer(path: str, every: int = EVERY) -> BatchWriter:
    """Write a round's changed bars as their newest version and merge older ones; a replay replaces its folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.select(*BAR_COLUMNS, F.lit(number).cast("long").alias(VERSION)).write.mode("overwrite").parquet(
            f"{path}/rounds/{VERSION}={number}")
        merge_rounds(batch.sparkSession, path, number, every)

    return write


def start_bars(
    trades: DataFrame, length: str, order: Column, delay: str, path: str, checkpoint: str, name: str = "provisional_bars",
    every: str = DATABASE_EVERY, offset: str = "0 seconds",
) -> DataStreamWriter:
    """Bars of a trade stream, kept up to date below ``path``. The caller starts and stops the query."""
    bars = build_bars_stream(trades, length, order, delay, offset)
    return each_batch(bars, versions_writer(path), checkpoint, name, every).outputMode("update")
