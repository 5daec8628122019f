"""Random small series: both layouts against plain loops."""

from datetime import timedelta

from helpers import START, bar_frame, brute_force, same_rows, whole
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some

from barflow.operators.enrich import enrich
from barflow.schema import HISTORY_COLUMNS

BARS = some.lists(
    some.tuples(
        some.sampled_from("AAAB"), some.integers(0, 400),
        some.sampled_from([1.0, 2.0, 2.5, None]), some.one_of(some.none(), some.integers(0, 9)),
    ),
    max_size=120, unique_by=lambda bar: bar[:2],
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(bars=BARS, minutes=some.sampled_from([1, 7, 60, 10_000]))
def test_layouts_equal_loops(spark, bars, minutes):
    rows = [
        (symbol, START + timedelta(minutes=at), 1.0, close, close, close, volume)
        for symbol, at, close, volume in bars
    ]
    frame = bar_frame(spark, rows)
    found = enrich(frame, chunk=f"{minutes} minutes")
    same_rows(found, whole(frame))
    expected = brute_force(rows)
    for row in found.collect():
        assert tuple(row[c] for c in HISTORY_COLUMNS.names) == expected[row["symbol"], row["timestamp"]]
