"""A store of signals in immutable files, with a manifest that says which of them count.

A round stages its files in a folder of its own and becomes visible by one manifest, written last: a
crash before that leaves files that no reader opens, and a round that is in the manifest already is not
written again. So each row is there once, however often rounds are replayed, and no round looks into
the rows of others.

The manifest has a row for each file: its rows, the round, when that was created, and the range of
symbol hashes, event times and creation times in it. Readers filter these ranges first and then open the
files that are left. ``cluster`` writes rounds anew as files along a space-filling curve over symbol
hash and event time, so that one symbol over all time, or all symbols over a short time, are in about
the square root of the number of files.

Rows are numbered without gaps when they are staged: rounds count on from the rows of those before,
which the manifest knows, and within a round by ranges of the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.numbering import numbered
from barflow.session import children, exists, remove
from barflow.sinks import SIGNAL_KEY, BatchWriter

ID, CREATED = "id", "created_at"
#: Cells of the curve along each side, and rows of a clustered file.
CELL_BITS, FILE_ROWS = 16, 1_000_000
CELLS = 1 << CELL_BITS
#: Rows that one task of ``cluster`` sorts at least; it cuts them into files.
TASK_ROWS = 50_000
#: Rounds whose manifests are merged into one, so that a reader lists no more folders than about that.
MERGE_ROUNDS = 64

MANIFEST = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("round", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("low_cell", T.IntegerType()), T.StructField("high_cell", T.IntegerType()),
    T.StructField("first_time", T.TimestampType()), T.StructField("last_time", T.TimestampType()),
    T.StructField("first_created", T.TimestampType()), T.StructField("last_created", T.TimestampType()),
])


def symbol_cell(symbol: Column) -> Column:
    """Which of the curve's cells a symbol falls into."""
    return F.pmod(F.xxhash64(symbol), F.lit(CELLS)).cast("int")


def interleaved(left: Column, right: Column) -> Column:
    """The bits of two cells in turn, those of ``left`` first: the place on a Z curve."""

    def spread(cell: Column) -> Column:
        # Masks that move every bit of a 16-bit number to an even place.
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return cell

    return F.shiftleft(spread(left.cast("long")), 1).bitwiseOR(spread(right.cast("long")))


def _describe(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """Manifest rows of the files in a staged folder, from the three columns that they need."""
    cell, time, created = symbol_cell(F.col("symbol")), F.col("timestamp").cast("timestamp"), F.col(CREATED)
    return spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.lit(number).cast("long").alias("round"), F.count("*").alias("rows"), F.min(cell).alias("low_cell"),
        F.max(cell).alias("high_cell"), F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        F.min(created).alias("first_created"), F.max(created).alias("last_created"))


def _merged(spark: SparkSession, path: str) -> int:
    """All rounds before this one are in one merged manifest."""
    return max((int(name.split("=")[1]) for name in children(spark, f"{path}/manifest")
                if name.startswith("upto=") and exists(spark, f"{path}/manifest/{name}/_SUCCESS")), default=0)


def _committed(spark: SparkSession, path: str) -> dict[int, str]:
    """The manifests that count, by the first round after them: the merged one and those since."""
    merged = _merged(spark, path)
    rounds = [int(name.split("=")[1]) for name in children(spark, f"{path}/manifest") if name.startswith("round=")]
    found = {n + 1: f"{path}/manifest/round={n}" for n in rounds
             if n >= merged and exists(spark, f"{path}/manifest/round={n}/_SUCCESS")}
    return {**found, merged: f"{path}/manifest/upto={merged}"} if merged else found


def files(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: a row for each file that counts."""
    found = sorted(_committed(spark, path).items())
    if not found:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*[folder for _, folder in found])


def is_committed(spark: SparkSession, path: str, number: int) -> bool:
    return exists(spark, f"{path}/manifest/round={number}/_SUCCESS") or _merged(spark, path) > number


def stage(rows: DataFrame, path: str, number: int, created: Column | None = None, key: Sequence[str] = SIGNAL_KEY) -> str:
    """Write a round's rows, with their numbers and time of creation, where no reader looks yet.

    ``created`` is the round's time, by default now; ``key`` tells the rows of a round apart. Rounds are
    staged in turn, each after the one before it is committed.
    """
    spark = rows.sparkSession
    before = files(spark, path).filter(F.col("round") < number).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    now = F.current_timestamp() if created is None else created.cast("timestamp")
    at = F.timestamp_micros(F.lit(spark.range(1).select(F.unix_micros(now)).first()[0]))
    folder = f"{path}/data/round={number}/{uuid.uuid4().hex[:12]}"
    stamped = rows.withColumn(CREATED, at)
    numbered(stamped, key, ID, before + 1).write.parquet(folder)
    return folder


def commit(spark: SparkSession, path: str, number: int, folder: str) -> None:
    """Make a staged round visible, and remove what other attempts at it have left."""
    _describe(spark, folder, number).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/round={number}")
    for other in children(spark, f"{path}/data/round={number}"):
        if other != folder.rsplit("/", 1)[1]:
            remove(spark, f"{path}/data/round={number}/{other}")
    if (number + 1) % MERGE_ROUNDS == 0:
        merge_manifests(spark, path, number + 1)


def merge_manifests(spark: SparkSession, path: str, upto: int) -> None:
    """One manifest for all rounds before ``upto``. The ones that it replaces go with the next merge but one."""
    before = {n: folder for n, folder in _committed(spark, path).items() if n <= upto}
    merged = spark.read.schema(MANIFEST).parquet(*before.values())
    merged.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/upto={upto}")
    for name in children(spark, f"{path}/manifest"):
        kind, n = name.split("=") if "=" in name else ("", "0")
        if kind and int(n) < upto - MERGE_ROUNDS:
            remove(spark, f"{path}/manifest/{name}")


def append(
    rows: DataFrame, path: str, number: int, created: Column | None = None, key: Sequence[str] = SIGNAL_KEY
) -> None:
    """Add a round to the store; a round that is there already is left as it is."""
    spark = rows.sparkSession
    if not is_committed(spark, path, number):
        commit(spark, path, number, stage(rows, path, number, created, key))


def writer(path: str, key: Sequence[str] = SIGNAL_KEY) -> BatchWriter:
    """``append`` for micro-batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, path, batch_id, key=key)

    return write


def cluster(spark: SparkSession, path: str, target: str, upto: int, file_rows: int = FILE_ROWS) -> None:
    """Copy all rounds before ``upto`` that another store lacks into files along the curve: one round of that
    store, under the number of the last one that it holds.

    So a copy that goes on now and then reads and writes new rounds alone; what it has already stays as it
    is, and each step is a curve of its own over its times. Read both with
    ``read(..., clustered=(target, upto))``. Rows keep their numbers and times.

    A file has at most ``file_rows`` rows. A task writes many files if these are small, so tasks, and what they
    exchange, grow with the rows and not with the files.
    """
    done = files(spark, target).agg(F.coalesce(F.max("round") + 1, F.lit(0))).first()[0]
    rounds = files(spark, path).filter(F.col("round").between(done, upto - 1))
    time = F.unix_micros(F.col("timestamp").cast("timestamp"))
    total, first, last, newest = rounds.agg(
        F.sum("rows"), F.unix_micros(F.min("first_time")), F.unix_micros(F.max("last_time")), F.max("round")).first()
    if not total:
        return
    rows = _open(spark, rounds)
    length = max(1, last - first + 1)
    cell = F.floor((time - F.lit(first)) / F.lit(length) * CELLS).cast("int")
    place = interleaved(symbol_cell(F.col("symbol")), F.least(cell, F.lit(CELLS - 1)))
    folder = f"{target}/data/round={newest}/{uuid.uuid4().hex[:12]}"
    (
        rows.withColumn("_place", place)
        .repartitionByRange(max(1, -(-total // max(file_rows, TASK_ROWS))), "_place", "timestamp", "symbol")
        .sortWithinPartitions("_place", "symbol", "timestamp").drop("_place")
        .write.option("maxRecordsPerFile", file_rows).parquet(folder)
    )
    commit(spark, target, newest, folder)


def _open(spark: SparkSession, chosen: DataFrame) -> DataFrame | None:
    """The rows of the files in a manifest; only the names of the chosen files come to the driver."""
    names = [r["file"] for r in chosen.select("file").collect()]
    return spark.read.parquet(*names) if names else None


def read(
    spark: SparkSession, path: str, symbol: str | None = None, start: Column | None = None, end: Column | None = None,
    created_since: Column | None = None, clustered: tuple[str, int] | None = None,
) -> DataFrame:
    """Stored signals of one symbol, of a time range (start inclusive, end exclusive), or created since a time.

    ``clustered`` names a clustered store and the first round that is not taken from it. A store without rows has no
    columns to read and raises an error.
    """
    chosen = files(spark, path)
    if clustered is not None:
        store, upto = clustered
        chosen = chosen.filter(F.col("round") >= upto).unionByName(files(spark, store).filter(F.col("round") < upto))
    on_files, on_rows = F.lit(True), F.lit(True)
    if symbol is not None:
        on_files &= symbol_cell(F.lit(symbol)).between(F.col("low_cell"), F.col("high_cell"))
        on_rows &= F.col("symbol") == symbol
    if start is not None:
        on_files &= F.col("last_time") >= start
        on_rows &= F.col("timestamp") >= start
    if end is not None:
        on_files &= F.col("first_time") < end
        on_rows &= F.col("timestamp") < end
    if created_since is not None:
        on_files &= F.col("last_created") >= created_since
        on_rows &= F.col(CREATED) >= created_since
    rows = _open(spark, chosen.filter(on_files))
    if rows is not None:
        return rows.filter(on_rows)
    other = _open(spark, chosen.limit(1))  # no file has such rows: the columns of any other one
    if other is None:
        raise ValueError(f"no round with rows in {path}")
    return other.filter(F.lit(False))
