"""URL filters: prefix rules as intervals of reversed-host keys, judged by one sorted sweep.

A rule (host, path) fits its host and all subdomains where the URL's path starts with the rule's.
The key of a rule is its host's labels in reverse order, a NUL, and its path; a URL has one such
key for each label depth that some rule has. A rule then fits exactly the keys that start with
its own, so it is the interval from its key to its key with a byte 0xFF, which no UTF-8 text has.
Such intervals are nested or disjoint. Rules and URLs are sorted together; opening a rule makes it
the top of the stack of active rules, closing it brings back the rule around it, and every URL
takes the top. The rule around each rule is found beforehand among the rules alone, so the stack
needs no memory besides "the last event seen", a window function.

URLs are dealt into slices by row number, not by host, so a hot host is no hot task; each slice
has all rules. A slice holds ``SLICE_ROWS`` rows or four times the number of rules, whichever is
more, so the copies of the rules stay a part of the data. The only shuffle is the one by slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import lower_ascii, shuffle_partitions

SLICE_ROWS = 1_000_000
#: Fixed value: the host and the path of a URL, after the first "://".
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
OWN = ["host", "path", "rule", "verdict"]


def host_of(url: Column) -> Column:
    """The part between the first "://" and "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    """Sort key as bytes. ``labels`` stand in reverse order."""
    return F.encode(F.concat(F.array_join(labels, "."), F.lit("\0"), path), "UTF-8")


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_events(rules: DataFrame) -> DataFrame:
    """(key, active) for the opening and the closing of every rule: what is on top from there on."""
    known = (
        rules.filter("host IS NOT NULL AND verdict IS NOT NULL")
        .groupBy(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max("verdict").alias("verdict"))  # two verdicts for one rule: "block" counts
        .withColumn("top", F.struct(
            F.length(F.concat("host", "path")).alias("length"),
            F.concat("host", "path").alias("rule"), "verdict"))
    )
    shorter = known.select(
        "host", "path", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("n"),
    ).where("n >= 0 AND n < length(path)").select(
        "host", "path", F.expr("left(path, n)").alias("outer_path"))
    around = shorter.join(
        known.select("host", F.col("path").alias("outer_path"), F.col("top").alias("outer")),
        ["host", "outer_path"],
    ).groupBy("host", "path").agg(F.max("outer").alias("outer"))
    nothing = F.struct(
        F.lit(-1).alias("length"), F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"))
    key = _key(_labels(F.col("host")), F.col("path"))
    return known.join(around, ["host", "path"], "left").select(F.inline(F.array(
        F.struct(key.alias("key"), F.col("top").alias("active")),
        F.struct(F.concat(key, F.lit(b"\xff")).alias("key"), F.coalesce("outer", nothing).alias("active")),
    )))


def slice_count(n_pages: int, n_rules: int, parallel: int, slice_rows: int) -> int:
    """How many slices: enough for all tasks, none with fewer pages than four times the rules, at least one."""
    return max(1, min(max(parallel, -(-n_pages // slice_rows)), n_pages // max(1, 4 * n_rules)))


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Every row with the host and path of its URL, the longest rule that fits, and the verdict.

    ``rules`` has host, path and verdict. The longest rule wins (host and path counted together;
    of two as long, the greater text). Without a rule: rule NULL, verdict ``default``. A NULL URL
    or one without "://": host and path empty, ``default``. Repeated rows stay repeated. Columns
    of ``pages`` named like the four results are replaced. Rules without host or verdict are
    left out; a NULL path is empty; A-Z in a rule's host is lower-cased. No rules: all ``default``.
    """
    spark = pages.sparkSession
    depths = [r[0] for r in rules.filter("host IS NOT NULL AND verdict IS NOT NULL").select(
        F.size(F.split("host", r"\.")).alias("n")).distinct().collect()]  # at most a name's labels
    slices = slice_count(pages.count(), rules.count(), 4 * shuffle_partitions(spark), slice_rows)
    kept = [c for c in pages.columns if c not in OWN]
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in kept], host_of(F.col(f"`{url}`")).alias("host"),
                 path_of(F.col(f"`{url}`")).alias("path")).alias("row"),
        F.monotonically_increasing_id().alias("number"),
    )
    labels = _labels(F.col("row.host"))
    fitting = F.filter(F.array(*[F.lit(n) for n in depths]).cast("array<int>"), lambda n: n <= F.size(labels))
    levels = rows.select(
        F.pmod(F.xxhash64("number"), F.lit(slices)).cast("int").alias("slice"), "row", "number",
        F.explode_outer(fitting).alias("depth"),
    ).select(
        "slice", "row", "number",
        _key(F.slice(labels, F.lit(1), F.col("depth")), F.col("row.path")).alias("key"))
    events = rule_events(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "key", "active")
    seen = Window.partitionBy("slice").orderBy("key", F.col("number").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    judged = levels.unionByName(events, allowMissingColumns=True).withColumn(
        "top", F.last("active", ignorenulls=True).over(seen)
    ).filter("number IS NOT NULL").groupBy("slice", "number").agg(
        F.first("row").alias("row"), F.max("top").alias("top"))
    return judged.select(
        *[F.col(f"row.`{c}`") for c in kept], "row.host", "row.path", F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"))
