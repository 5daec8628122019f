"""Trades of the bundled tables, in one shape: symbol, ts, price, quantity and tie-break ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.sources.bars import packed

SUPPLIER_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def supplier_order(unit: str) -> Column:
    """The order of line items within a bucket, as one number: time, order, line and part.

    Two digits of a hash of price and quantity tell copies of one line item apart.
    """
    ts = F.col("ts")
    return packed([
        (F.unix_micros(ts) - F.unix_micros(F.date_trunc(unit, ts)), 12), (F.col("l_orderkey"), 12),
        (F.col("l_linenumber"), 1), (F.col("l_partkey"), 11),
        (F.pmod(F.xxhash64("l_extendedprice", "l_quantity"), F.lit(100)), 2),
    ])


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def load_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The table as a stream. The pattern lets it be one file or a folder of files."""
    schema = load(spark, folder, table).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{table}.parquet*")


def event_trades(spark: SparkSession, folder: str) -> DataFrame:
    return as_event_trades(load(spark, folder, "events"))


def as_event_trades(events: DataFrame) -> DataFrame:
    """One trade per event; the symbol is the user and the quantity sits in ``props``."""
    return events.select(
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("quantity"),
        "event_id",
    )


def lineitem_trades(spark: SparkSession, folder: str) -> DataFrame:
    """One trade per line item; the symbol is the supplier and the price is per unit."""
    return load(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("quantity"),
        *SUPPLIER_TIES,
    )
