"""Packing by non-negative least squares over shallow combinations of lengths.

Documents are cut at multiples of the window; what counts then is how many pieces there are of
each length, a histogram of at most ``window`` numbers. Combinations of one, two or three lengths
that fill the window exactly are enumerated (of three, one is a multiple of ``GRID``), and
non-negative least squares finds how often to repeat each so that the histogram is used up.
Rounded repeats are taken as long as pieces last; the rest is packed greedily, the longest piece
first, each time with the longest that still fits. Where nothing fits and ``LEAST_GAP`` places or
more would stay empty, a longer piece is cut to fill them and its rest goes back to the others;
that happens when few lengths make up most of the pieces, as with many copies of one document.
All of this is arithmetic on the histogram.

Pieces then take their places by rank among those of their length. Ranks come from counts: pieces
are dealt into buckets, numbered within (length, bucket), and a running sum over a length's
buckets gives the bucket's first rank, so a length that a third of all pieces have is spread over
all buckets. The plan sent to the tasks has a bounded number of rows, whatever the data.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm import tokens
from barflow.llm.common import shuffle_partitions, stored

WINDOW = 2048
#: In combinations of three, one length is a multiple of this.
GRID = 64
ROUNDS = 200
#: So many places at the end of a sequence are not worth a cut.
LEAST_GAP = 16
#: Pieces of a length in one bucket, at most about this many.
BUCKET_ROWS = 100_000

PIECE = "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, skip long, sequence_id long, offset long"
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def cut(documents: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """The pieces of all documents: whole windows and a rest, with their ids and the ids' checksum.

    ``documents`` has doc_id and text; a NULL text is empty and has the end id alone. ``piece``
    is a number of its own for each; ``ids`` are little-endian 32-bit numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for rows, ids, ends in tokens.encoded(batches, vocabulary):
            n = np.diff(ends)
            count = -(-n // window)
            of = np.repeat(np.arange(len(n)), count)
            start = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * window
            length = np.minimum(window, n[of] - start)
            begin = ends[of] + start
            held = [np.ascontiguousarray(ids[b:e], "<u4").tobytes() for b, e in zip(begin, begin + length)]
            yield pa.RecordBatch.from_arrays([
                pa.array(number + np.arange(len(of))), rows["doc_id"].cast("int64").take(pa.array(of)),
                pa.array(start), pa.array(length), pa.array(map(zlib.crc32, held), pa.int64()),
                pa.array(n[of]), pa.array(held, pa.binary())], _names(PIECE))
            number += len(of)

    return documents.select("doc_id", "text").mapInArrow(run, PIECE)


def combinations(lengths: np.ndarray, window: int = WINDOW, grid: int = GRID) -> list[tuple[int, ...]]:
    """Lengths that fill the window: alone, two, or three of which one is a multiple of ``grid``."""
    present = set(map(int, lengths))
    found = {(window,)} if window in present else set()
    for a in present:
        if a <= window - a and window - a in present:
            found.add((window - a, a))
        for c in range(grid, window, grid):
            b = window - c - a
            if c in present and 0 < b <= a and b in present:
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found, reverse=True)


def solve(columns: list[tuple[int, ...]], histogram: dict[int, int], rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 that bring the lengths used near the histogram (multiplicative updates)."""
    flat = np.array([a for c in columns for a in c], dtype=np.int64)
    of = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    size = int(flat.max()) + 1
    wanted = np.zeros(size)
    for length, n in histogram.items():
        if length < size:
            wanted[length] = n
    pull = np.bincount(of, wanted[flat], len(columns))
    x = np.full(len(columns), max(1.0, wanted.sum() / max(1, len(flat))))
    for _ in range(rounds):
        used = np.bincount(flat, x[of], size)
        x *= pull / np.maximum(np.bincount(of, used[flat], len(columns)), 1e-12)
    return x


class Plan(NamedTuple):
    """Of pieces of ``length`` with ranks from ``low`` on, the ``size`` ids after ``skip`` go to
    ``sequence`` + rank - low, at ``offset``. In order of length, skip and low."""

    length: np.ndarray
    skip: np.ndarray
    low: np.ndarray
    size: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def plan(histogram: dict[int, int], window: int = WINDOW, least_gap: int = LEAST_GAP) -> Plan:
    left = {int(a): int(n) for a, n in histogram.items() if n}
    # Lots of equal (rests of) pieces by size: how many, their whole length, first rank, ids before.
    lots = defaultdict(list) | {a: [(n, a, 0, 0)] for a, n in left.items()}
    rows: list[tuple[int, ...]] = []
    sequences = 0

    def take(combination: list[tuple[int, int]], repeats: int) -> None:
        """Place ``repeats`` of each (size, how much of it); what is cut off goes back."""
        nonlocal sequences
        offset = 0
        for size, used in combination:
            at = sequences
            while at < sequences + repeats:
                n, length, low, skip = lots[size].pop()
                some = min(n, sequences + repeats - at)
                if some < n:
                    lots[size].append((n - some, length, low + some, skip))
                rows.append((length, skip, low, used, at, offset))
                if used < size:
                    lots[size - used].append((some, length, low, skip + used))
                at += some
            left[size] -= repeats
            if used < size:
                left[size - used] = left.get(size - used, 0) + repeats
            offset += used
        sequences += repeats

    columns = combinations(np.array(list(left), dtype=np.int64), window)
    if columns:
        x = solve(columns, left)
        for i in np.argsort(-x, kind="stable"):
            column = columns[i]
            repeats = min(round(x[i]), *(left[a] // column.count(a) for a in column))
            if repeats > 0:
                take([(a, a) for a in column], repeats)
    lengths = sorted(a for a in left if left[a])
    while lengths:
        combination, used, room = [], defaultdict(int), window
        at = len(lengths) - 1
        while at >= 0:
            a = lengths[at]
            if left[a] > used[a]:
                combination.append((a, a))
                used[a] += 1
                room -= a
                at = min(at, bisect_right(lengths, room) - 1)
            else:
                at -= 1
        if room >= least_gap:
            longer = next((a for a in reversed(lengths) if a > room and left[a] > used[a]), 0)
            if longer:
                combination.append((longer, room))
                used[longer] += 1
        take(combination, min(left[a] // n for a, n in used.items() if n))
        lengths = sorted(a for a in left if left[a])
    return Plan(*(np.array(column, dtype=np.int64) for column in zip(*sorted(rows))) if rows
                else (np.zeros(0, np.int64) for _ in Plan._fields))


def place(known: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """(which piece, ids before, size, sequence, offset) of all parts of the pieces."""
    key = known.length * 4096 + known.skip << 38 | known.low if len(known.low) else known.low
    which, skip, parts = np.arange(len(length)), np.zeros(len(length), np.int64), []
    while len(which):
        at = np.searchsorted(key, length[which] * 4096 + skip << 38 | rank[which], side="right") - 1
        size = known.size[at]
        parts.append((which, skip, size, known.sequence[at] + rank[which] - known.low[at], known.offset[at]))
        more = skip + size < length[which]
        which, skip = which[more], (skip + size)[more]
    return tuple(map(np.concatenate, zip(*parts))) if parts else (np.zeros(0, np.int64),) * 5


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Pieces with their ``rank`` among those of their length, from 0."""
    spark = pieces.sparkSession
    buckets = max(4 * shuffle_partitions(spark), total // BUCKET_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    each = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    return dealt.withColumn("own", F.row_number().over(each)).join(before, ["length", "bucket"]).select(
        *pieces.columns, (F.col("before") + F.col("own") - 1).alias("rank"))


def pack(
    documents: DataFrame, vocabulary: str | None = None, window: int = WINDOW, keep_ids: bool = False
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    A document's ids and the end id lie in its pieces, each in one; pieces of a sequence follow
    each other without gaps, and no sequence is longer than the window. NULL and empty texts are
    a piece of one id. Rows with a repeated or a NULL doc_id are packed like all others. An empty
    table gives an empty result. Other columns of ``documents`` play no part. ``keep_ids`` adds
    the ids of each piece, as bytes.
    """
    spark = documents.sparkSession
    pieces = stored(cut(documents, vocabulary or tokens.default_vocabulary(), window), "pieces")
    small = pieces.drop("ids")
    histogram = {r["length"]: r["count"] for r in small.groupBy("length").count().collect()}  # at most `window` rows
    planned = plan(histogram, window)
    sent = spark.sparkContext.broadcast(tuple(planned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Plan(*sent.value)
        for batch in batches:
            length = batch["length"].to_numpy()
            which, skip, size, sequence, offset = place(known, length, batch["rank"].to_numpy())
            at = pa.array(which)
            whole = pa.array(size == length[which])
            yield pa.RecordBatch.from_arrays([
                batch["piece"].take(at), batch["doc_id"].take(at), pa.array(batch["start"].to_numpy()[which] + skip),
                pa.array(size), pc.if_else(whole, batch["ids_crc32"].take(at), None),
                batch["doc_tokens"].take(at), pa.array(skip), pa.array(sequence), pa.array(offset)], _names(PLACED))

    placed = ranked(small, sum(histogram.values())).mapInArrow(run, PLACED)
    if not keep_ids and not (planned.skip > 0).any():
        return placed.select(*RESULT)
    placed = stored(placed, "places")
    held = placed if keep_ids else placed.filter("ids_crc32 IS NULL")
    part = F.substring("ids", F.col("skip") * 4 + 1, F.col("length") * 4)
    parts = held.join(pieces.select("piece", "ids"), "piece").withColumn("ids", part).withColumn(
        "ids_crc32", F.crc32("ids"))
    if keep_ids:
        return parts.select(*RESULT, "ids")
    return parts.select(*RESULT).unionByName(placed.filter("ids_crc32 IS NOT NULL").select(*RESULT))
