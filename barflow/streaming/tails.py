"""The last bars of every symbol before a round, from one snapshot and the rounds since.

Each round's bars lie in a folder of their own. Every ``every`` rounds a snapshot is written first: the
last 19 bars of each symbol before that round, merged from the snapshot before and the rounds since
then. A round reads the newest snapshot and the fewer than ``every`` rounds after it, so what it reads is
bounded by symbols and rounds, however old the store is. A snapshot depends on nothing but rounds before
it: a replayed round writes the same one again. Snapshots that no replay can need any more are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barflow.operators.enrich import last_rows
from barflow.schema import LOOKBACK_ROWS
from barflow.session import DENSE, children, exists, remove

ROUND = "batch_id"
#: Rounds between two snapshots.
EVERY = 16


def round_folder(store: str, number: int) -> str:
    return f"{store}/{ROUND}={number}"


def snapshot_folder(store: str, number: int) -> str:
    """Where the snapshot before round ``number`` lies; Spark's readers pass by names with an underscore."""
    return f"{store}/_tails/before={number}"


def folders_before(spark: SparkSession, store: str, number: int, every: int = EVERY) -> list[str]:
    """The snapshot and the rounds that hold the last bars before round ``number``."""
    newest = number - number % every
    while newest > 0 and not exists(spark, f"{snapshot_folder(store, newest)}/_SUCCESS"):
        newest -= every
    rounds = [round_folder(store, n) for n in range(max(0, newest), number)]
    found = [folder for folder in rounds if exists(spark, folder)]
    return found if newest <= 0 else [snapshot_folder(store, newest), *found]


def _read(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def bars_before(
    spark: SparkSession, store: str, schema: T.StructType, number: int, every: int = EVERY
) -> DataFrame:
    """Bars of rounds before ``number``, among them the last 19 of every symbol."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    return _read(spark, folders_before(spark, store, number, every), schema)


def write_snapshot(spark: SparkSession, store: str, schema: T.StructType, number: int, every: int = EVERY) -> None:
    """Write the snapshot before round ``number`` if one is due."""
    if number == 0 or number % every:
        return
    before = _read(spark, _folders_without(spark, store, number, every), T.StructType(
        [T.StructField(f.name, f.dataType) for f in schema]))
    last_rows(before, LOOKBACK_ROWS, (), ["symbol"]).write.mode("overwrite").parquet(
        snapshot_folder(store, number), compression=DENSE)
    for name in children(spark, f"{store}/_tails"):
        if int(name.split("=")[1]) < number - every:
            remove(spark, f"{store}/_tails/{name}")


def _folders_without(spark: SparkSession, store: str, number: int, every: int) -> list[str]:
    """What the snapshot before ``number`` is made of: not itself, if an earlier attempt has left it."""
    before = folders_before(spark, store, number - 1, every)
    last = round_folder(store, number - 1)
    return [*before, last] if exists(spark, last) else before
