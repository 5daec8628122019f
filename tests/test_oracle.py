"""Every query against its SQL on an independent engine, value by value."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from barflow.plans.queries import queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, Decimal):
        return f"{value:.4f}"
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(queries()) <= set(contract.queries())
    assert set(queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_equals_sql(spark, duck, name):
    ours = contract.queries()[name](spark, FOLDER)
    theirs = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    expected = _rows(names, theirs.fetchall())
    assert expected
    assert _rows(ours.columns, [tuple(r) for r in ours.collect()]) == expected


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 79


def test_known_counts(spark):
    signals = contract.queries()["signal_monitor"](spark, FOLDER).groupBy("signal").count()
    assert {r["signal"]: r["count"] for r in signals.collect()} == {"BUY": 402, "SELL": 433}
