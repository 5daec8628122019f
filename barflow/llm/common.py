"""Helpers that the operators share: tables, intermediate tables, and work in bounded pieces."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.session import remove, work_dir

#: A-Z and what they become. Other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that a task turns into arrays at once; a longer document is a piece of its own.
PIECE_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: With these Python workers give freed arrays back to the system, for about a fifth more CPU time.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "2"}


def prepare(spark: SparkSession, lean: bool = False) -> SparkSession:
    """Let Python workers import this package where only the driver has it on its path.

    ``lean`` is for jobs of many steps, whose workers live long: they then free memory between steps.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if lean:
        for name, value in WORKER_MEMORY.items():
            known.setdefault(name, value)
    if root in sys.path and root not in known.get("PYTHONPATH", ""):
        known["PYTHONPATH"] = ":".join(x for x in (root, known.get("PYTHONPATH")) if x)
    return spark


def stored(rows: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write rows to the shared work folder and read them back: cuts lineage, survives a lost executor.

    ``group_bytes`` bounds what a writer holds of wide rows before it writes them.
    """
    path = work_dir(rows.sparkSession, name)
    write = rows.write.option("compression", "zstd")
    if group_bytes is not None:
        write = write.option("parquet.block.size", group_bytes)
    write.parquet(path)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    table.stored_at = path
    if _open:
        _open[-1].append(table)
    return table


#: Tables of the ``scratch`` blocks that the program is in.
_open: list[list[DataFrame]] = []


def discard(*tables: DataFrame) -> None:
    """Remove the folders of stored tables that nothing reads any more; other DataFrames are left alone."""
    for table in tables:
        if path := vars(table).get("stored_at"):  # not a column of that name
            remove(table.sparkSession, path)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored in the block are removed at its end, but for those given to the function it yields.

    What leaves the block may read kept tables only; those belong to the next outer block, if there is one.
    """
    made: list[DataFrame] = []
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    _open.append(made)
    try:
        yield keep
    finally:
        _open.pop()
        discard(*[t for t in made if not any(t is k for k in kept)])
        if _open:
            _open[-1].extend(kept)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``size`` bytes of text, or one row.

    A NULL text becomes the empty text.
    """
    for batch in batches:
        column = pc.fill_null(batch[text], "")
        batch = batch.set_column(batch.schema.get_field_index(text), text, column)
        ends = pc.cumulative_sum(pc.cast(pc.binary_length(column), pa.int64())).to_numpy(zero_copy_only=False)
        begin = before = 0
        while begin < len(ends):
            end = max(begin + 1, int(ends.searchsorted(before + size, side="right")))
            yield batch.slice(begin, end - begin)
            begin, before = end, int(ends[end - 1])
