"""Times the headline queries and prints one JSON line.

Every query is run to its last row through the no-op sink after one warm-up; the value is the sum
over queries of the median of three runs, of one run for streams and for queries on stored signals,
which write their store first. ``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the number of local
cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from barflow.plans.queries import queries
from barflow.session import local_session

HEADLINE = [
    "bars_supplier_week", "enriched_bars", "enriched_bars_chunked", "signal_monitor_week",
    "signal_monitor_chunked", "signal_monitor", "latest_bar_per_symbol", "json_round_trip",
    "parse_messages", "bar_rejects", "trading_signals_rows", "enriched_range", "bar_field_errors",
]
ONCE = [
    "signals_by_type", "signals_of_symbol_all_time", "signals_numbered", "stream_bars_user_day", "stream_signal_monitor",
    "stream_enriched_rounds", "stream_late_bars", "stream_bars_upserted",
]
RUNS = 3


def timed(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE + ONCE
    spark = local_session(cores, app="barflow-bench", shared=tempfile.mkdtemp(prefix="run-"))
    spark.sparkContext.setLogLevel("ERROR")
    known, seconds = queries(), {}
    for name in names:
        runs = RUNS if name not in ONCE else 1
        timed(known[name], spark, folder)
        seconds[name] = round(statistics.median(
            timed(known[name], spark, folder) for _ in range(runs)), 3)

    weekly = known["bars_supplier_week"](spark, folder).count()
    daily = known["bars_user_day"](spark, folder).count()
    bars = {
        "enriched_bars": weekly, "signal_monitor_week": weekly, "signal_monitor_chunked": weekly,
        "stream_enriched_rounds": weekly, "stream_signal_monitor": daily,
    }
    rates = {name: round(n / seconds[name]) for name, n in bars.items() if name in seconds}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cores),
        "weekly_bars": weekly, "daily_bars": daily, "bars_per_second": rates,
    }))


if __name__ == "__main__":
    main()
