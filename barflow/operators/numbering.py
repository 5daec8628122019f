"""Gapless numbers and running sums over a whole table, without a window over one partition.

Rows are dealt by ranges of their order, sorted, and written down with their place in their range.
The rows (or the sums) of the ranges before a range, of which there are as many as tasks, are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.session import work_dir

PLACE = "_place"
#: Fixed value: a place is the number of the range times 2**33 plus the row's number within it.
RANGE_BITS = 33


def in_order(rows: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The rows with their place as a number that grows with ``order`` (NULL first).

    They are written to the shared work folder, as a place must not change between reads.
    """
    spark = rows.sparkSession
    path = work_dir(spark, "in-order")
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), *[F.col(c) for c in order])
    ranged.sortWithinPartitions(*order).withColumn(
        PLACE, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def _range() -> Column:
    return F.shiftright(PLACE, RANGE_BITS)


def _before(placed: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """For each range the sums over all ranges before it.

    Its window has no partition; it sees one row for each range, so no more than there are tasks.
    """
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(_range().alias("_range")).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    return totals.select("_range", *[
        F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(f"_before_{name}") for name in sums])


def numbered(
    rows: DataFrame, order: Sequence[str], name: str = "id", first: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number the rows ``first``, ``first + 1``, ... in ``order``, without gaps: one exchange.

    ``order`` should tell all rows apart; equal ones take any order among themselves.
    """
    placed = in_order(rows, order, partitions)
    within = F.col(PLACE).bitwiseAND(F.lit((1 << RANGE_BITS) - 1))
    return (
        placed.withColumn("_range", _range())
        .join(F.broadcast(_before(placed, {"n": F.lit(1)})), "_range")
        .withColumn(name, F.col("_before_n") + within + F.lit(first)).drop("_range", "_before_n", PLACE)
    )


def running(
    rows: DataFrame, order: Sequence[str], sums: dict[str, str], partitions: int | None = None
) -> DataFrame:
    """Add running sums, the row itself included: ``sums`` has the summed column of each new one."""
    placed = in_order(rows, order, partitions).withColumn("_range", _range())
    within = Window.partitionBy("_range").orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(_before(placed, {name: F.col(c) for name, c in sums.items()})), "_range")
        .withColumns({name: F.col(f"_before_{name}") + F.coalesce(F.sum(c).over(within), F.lit(0))
                      for name, c in sums.items()})
        .drop("_range", PLACE, *[f"_before_{name}" for name in sums])
    )
