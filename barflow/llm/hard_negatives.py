"""Hard negatives from blocks in Hilbert order, chosen by zone maps and interval arithmetic.

Vectors become whole numbers and are sorted along a Hilbert curve, so that a block of them spans
little of each dimension. Every block keeps the least and the greatest component of each dimension
(its zone map) beside its vectors, in columns of their own that are read without them. The score of
an anchor with any vector of a block lies between the sums of the smaller and of the greater of the
two products of each dimension. A block is read for an anchor only if that interval meets one of the
anchor's windows of scores, and if its labels can be what the window asks for.

A search takes two rounds. In the first every anchor reads the one block with the highest bound that
may hold rows for it; the k-th best score there is the window's floor. In the second it reads every
block whose interval reaches from the floor to the window's upper end, which holds all k best rows.
Positives are a search with one open window and the anchor's own label; negatives are one with a
window for each positive and any other label. Anchors travel in blocks, too, and a block of them
meets a block of vectors as one group of two rows, if at least one of them needs it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import stored
from barflow.llm.topk import EXACT, usable, whole
from barflow.operators.numbering import numbered

#: Vectors of a block, anchors of a block, and blocks of vectors whose zone maps are looked at together.
BLOCK, ANCHORS, PART = 2048, 1024, 16
#: Bits of each dimension on the curve, and how many dimensions (those of the widest range) it runs through.
BITS, CURVE_DIMENSIONS = 4, 64
#: A score that no pair has, for the ends of open windows and for pairs that do not count.
NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

BLOCK_ROW = (
    "part int, block long, ids binary, labels binary, vectors binary, low binary, high binary, "
    "label_low long, label_high long, width int"
)
ASK_ROW = "batch long, ids binary, labels binary, vectors binary, low binary, high binary, floor binary, width int"
FOUND = "batch long, at int, window int, vec_id long, score long"
ZONE = ["part", "block", "low", "high", "label_low", "label_high", "width"]


def curve(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve, as rows of bytes in the order of the curve.

    ``cells`` holds a whole number below ``2**bits`` for each dimension. Seen from the top bit down,
    each dimension either turns the first one around or changes places with it; the Gray code of what
    is left, its bits dealt dimension by dimension, is the place.
    """
    x = cells.astype(np.uint32).T.copy()
    for shift in range(bits - 1, 0, -1):
        below = np.uint32((1 << shift) - 1)
        for axis in x:
            turned = (axis >> np.uint32(shift)) & np.uint32(1) == 1
            swapped = np.where(turned, np.uint32(0), (x[0] ^ axis) & below)
            x[0] ^= np.where(turned, below, swapped)
            axis ^= swapped  # nothing for the first one itself
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for shift in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(shift)) & np.uint32(1) == 1, np.uint32((1 << shift) - 1), np.uint32(0))
    x ^= turn
    dealt = [(axis >> np.uint32(shift)) & np.uint32(1) for shift in range(bits - 1, -1, -1) for axis in x]
    return np.packbits(np.array(dealt, np.uint8), axis=0).T


def _narrow(matrix: np.ndarray) -> bytes:
    """The matrix in the shortest of three kinds of whole numbers; ``_matrix`` tells it by the length."""
    most = int(np.abs(matrix).max(initial=0))
    return matrix.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64).tobytes()


def _matrix(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // max(1, rows * width) or 8]
    return np.frombuffer(data, kind).reshape(rows, width).astype(np.int64)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _padded(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of one width, filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def placed(vectors: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """The vectors with their place on the curve through the dimensions of the widest range."""
    used = np.sort(np.argsort(low - high, kind="stable")[:CURVE_DIMENSIONS])
    start, span = low[used].astype(float), np.maximum(1, high[used] - low[used]).astype(float)
    width = len(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                share = (_padded(batch["vector"], width)[:, used] - start) / span
                cells = np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                places = [row.tobytes() for row in curve(cells, BITS)] if len(used) else [b""] * len(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.binary())],
                                                 [*batch.schema.names, "place"])

    return vectors.mapInArrow(run, "vec_id long, label long, vector array<long>, place binary")


def _numbered(vectors: DataFrame) -> DataFrame:
    """The vectors with their rank ``n`` along the curve."""
    return numbered(vectors, ["place", "vec_id"], "n", first=0)


def blocks(ranked: DataFrame, size: int) -> DataFrame:
    """Blocks of ``size`` vectors along the curve with their zone maps, one row each."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("n").combine_chunks()
        block, width = rows["block"][0].as_py(), rows["width"][0].as_py()
        matrix = _padded(rows["vector"].combine_chunks(), width)
        labels = rows["label"].to_numpy()
        return pa.Table.from_pylist([{
            "part": block // PART, "block": block, "ids": rows["vec_id"].to_numpy().tobytes(),
            "labels": labels.tobytes(), "vectors": _narrow(matrix),
            "low": matrix.min(axis=0).tobytes(), "high": matrix.max(axis=0).tobytes(),
            "label_low": int(labels.min()), "label_high": int(labels.max()), "width": width,
        }], BLOCK_SCHEMA)

    return ranked.withColumn("block", F.floor(F.col("n") / size)).groupBy("block").applyInArrow(run, BLOCK_ROW)


BLOCK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()),
    ("vectors", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("label_low", pa.int64()),
    ("label_high", pa.int64()), ("width", pa.int32()),
])
ASK_SCHEMA = pa.schema([("batch", pa.int64()), *[(c, pa.binary()) for c in (
    "ids", "labels", "vectors", "low", "high", "floor")], ("width", pa.int32())])
PLAN = "batch long, block long, wanted array<int>"
PLAN_SCHEMA = pa.schema([("batch", pa.int64()), ("block", pa.int64()), ("wanted", pa.list_(pa.int32()))])
BOUND = "batch long, at int, block long, bound long"
BOUND_SCHEMA = pa.schema([
    ("batch", pa.int64()), ("at", pa.int32()), ("block", pa.int64()), ("bound", pa.int64())])
FOUND_SCHEMA = pa.schema([
    ("batch", pa.int64()), ("at", pa.int32()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _ask(batch: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
         floor: np.ndarray) -> dict[str, object]:
    return {"batch": batch, "ids": ids.tobytes(), "labels": labels.tobytes(), "vectors": _narrow(vectors),
            "low": low.tobytes(), "high": high.tobytes(), "floor": floor.tobytes(), "width": vectors.shape[1]}


def asks(ranked: DataFrame, size: int) -> DataFrame:
    """Blocks of ``size`` anchors along the curve, each anchor with one open window."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("n").combine_chunks()
        open_ = np.full((len(rows), 1), NONE + 1)
        return pa.Table.from_pylist([_ask(
            rows["batch"][0].as_py(), rows["vec_id"].to_numpy(), rows["label"].to_numpy(),
            _padded(rows["vector"].combine_chunks(), rows["width"][0].as_py()), open_,
            np.full((len(rows), 1), MOST), open_)], ASK_SCHEMA)

    return ranked.withColumn("batch", F.floor(F.col("n") / size)).groupBy("batch").applyInArrow(run, ASK_ROW)


class Asked:
    """A block of anchors as arrays; ``low``, ``high`` and ``floor`` have a column for each window."""

    def __init__(self, row: dict[str, object]) -> None:
        self.batch, self.ids, self.labels = row["batch"], _longs(row["ids"]), _longs(row["labels"])
        self.vectors = _matrix(row["vectors"], len(self.ids), row["width"])
        self.low, self.high, self.floor = (
            _longs(row[c]).reshape(len(self.ids), -1) for c in ("low", "high", "floor"))


def intervals(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that any vector between ``low`` and ``high`` can have with each vector.

    Rows of ``low`` and ``high`` are zone maps. Where a sum is too large to be exact as a double
    the interval is everything.
    """
    width = max(1, vectors.shape[1])
    largest = float(np.abs(vectors).max(initial=0)) * float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)))
    if largest * width >= EXACT:
        shape = (len(vectors), len(low))
        return np.full(shape, -np.inf), np.full(shape, np.inf)
    up, down = np.maximum(vectors, 0).astype(float), np.minimum(vectors, 0).astype(float)
    low, high = low.T.astype(float), high.T.astype(float)
    return up @ low + down @ high, up @ high + down @ low


def _scores(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(others).max(initial=0)) * max(1, vectors.shape[1])
    if largest < EXACT:
        return (vectors.astype(float) @ others.T.astype(float)).astype(np.int64)
    return vectors @ others.T


def _needs(anchors: Asked, zone: pa.Table, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(which anchor must read which block, greatest score that it can have there)."""
    ends = [np.stack([_longs(x) for x in zone[c].to_pylist()]) for c in ("low", "high")]
    least, most = intervals(anchors.vectors, *ends)
    label_low, label_high = (zone[c].to_numpy() for c in ("label_low", "label_high"))
    label = anchors.labels[:, None]
    may = (label_low <= label) & (label <= label_high) if same else (label_low != label) | (label_high != label)
    wide = np.zeros(may.shape, bool)
    for low, high in zip(np.maximum(anchors.low, anchors.floor).T, anchors.high.T):
        wide |= (low <= high)[:, None] & (most >= low[:, None]) & (least <= high[:, None])
    return may & wide, most


def _chooser(same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Which anchors of a block need which of a part's blocks."""

    def run(asked: pa.Table, zones: pa.Table) -> pa.Table:
        if not len(asked) or not len(zones):
            return PLAN_SCHEMA.empty_table()
        anchors = Asked(asked.to_pylist()[0])
        need, _ = _needs(anchors, zones, same)
        return pa.Table.from_pylist([
            {"batch": anchors.batch, "block": block, "wanted": np.flatnonzero(column)}
            for block, column in zip(zones["block"].to_pylist(), need.T) if column.any()], PLAN_SCHEMA)

    return run


def _first_chooser(same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For each anchor of a block the one of a part's blocks with the highest bound."""

    def run(asked: pa.Table, zones: pa.Table) -> pa.Table:
        if not len(asked) or not len(zones):
            return BOUND_SCHEMA.empty_table()
        anchors = Asked(asked.to_pylist()[0])
        need, most = _needs(anchors, zones, same)
        bound = np.where(need, np.clip(most, -2.0**62, 2.0**62), -np.inf)
        at = np.flatnonzero(need.any(axis=1))
        best = bound[at].argmax(axis=1)
        return pa.Table.from_arrays([
            pa.array(np.full(len(at), anchors.batch)), pa.array(at.astype(np.int32)),
            pa.array(zones["block"].to_numpy()[best]), pa.array(bound[at, best].astype(np.int64))], schema=BOUND_SCHEMA)

    return run


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores of each row, smaller ids first; NONE does not count."""
    if scores.shape[1] > k:
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, column = np.nonzero((scores >= kth[:, None]) & (scores != NONE))
    else:
        row, column = np.nonzero(scores != NONE)
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


def _reader(same: bool, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k best rows of a block for each window of the anchors that need it."""

    def run(asked: pa.Table, block: pa.Table) -> pa.Table:
        if not len(asked) or not len(block):
            return FOUND_SCHEMA.empty_table()
        row, held = asked.to_pylist()[0], block.to_pylist()[0]
        anchors, wanted = Asked(row), np.array(row["wanted"], np.int64)
        ids, labels = _longs(held["ids"]), _longs(held["labels"])
        scores = _scores(anchors.vectors[wanted], _matrix(held["vectors"], len(ids), held["width"]))
        own = anchors.labels[wanted][:, None]
        allowed = (labels == own if same else labels != own) & (ids != anchors.ids[wanted][:, None])
        out = []
        for window in range(anchors.low.shape[1]):
            low = np.maximum(anchors.low, anchors.floor)[wanted, window][:, None]
            high = anchors.high[wanted, window][:, None]
            counted = np.where(allowed & (scores >= low) & (scores <= high), scores, NONE)
            at, column = best_rows(counted, ids, k)
            out.append((wanted[at], np.full(len(at), window), ids[column], scores[at, column]))
        at, window, names, found = (np.concatenate(x) for x in zip(*out))
        return pa.Table.from_arrays([
            pa.array(np.full(len(at), anchors.batch)), pa.array(at.astype(np.int32)),
            pa.array(window.astype(np.int32)), pa.array(names), pa.array(found)], schema=FOUND_SCHEMA)

    return run


def _with_floors(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Raise the floor of each window to the k-th best score found so far."""

    def run(asked: pa.Table, found: pa.Table) -> pa.Table:
        if not len(asked):
            return ASK_SCHEMA.empty_table()
        a = Asked(asked.to_pylist()[0])
        floor = a.floor.copy()
        at, window, score = (found[c].to_numpy() for c in ("at", "window", "score"))
        order = np.lexsort((-score, window, at))
        slot = (at.astype(np.int64) * floor.shape[1] + window)[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kth = order[rank == k - 1]
        floor[at[kth], window[kth]] = np.maximum(floor[at[kth], window[kth]], score[kth])
        return pa.Table.from_pylist([_ask(a.batch, a.ids, a.labels, a.vectors, a.low, a.high, floor)], ASK_SCHEMA)

    return run


def _meet(held: DataFrame, asked: DataFrame, plan: DataFrame, same: bool, k: int) -> DataFrame:
    """Read the planned blocks: one group of two rows for each block of anchors and block of vectors."""
    keys = ["batch", "block"]
    left = asked.join(plan, "batch")
    right = held.join(plan.select(*keys), "block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_reader(same, k), FOUND)


def _plan(held: DataFrame, asked: DataFrame, sizes: tuple[int, int], same: bool, first: bool) -> DataFrame:
    """Every block of anchors looks at every part's zone maps; the rows say who reads what.

    ``sizes`` are the numbers of parts and of blocks of anchors; both count from 0.
    """
    parts, batches = (F.explode(F.sequence(F.lit(0).cast(kind), F.lit(max(0, n - 1)).cast(kind)))
                      for n, kind in zip(sizes, ("int", "long")))
    left = asked.withColumn("part", parts).groupBy("part", "batch")
    right = held.select(*ZONE).withColumn("batch", batches).groupBy("part", "batch")
    if not first:
        return left.cogroup(right).applyInArrow(_chooser(same), PLAN)
    bounds = left.cogroup(right).applyInArrow(_first_chooser(same), BOUND)
    highest = bounds.groupBy("batch", "at").agg(F.max(F.struct("bound", "block")).alias("top"))
    return highest.groupBy("batch", F.col("top.block").alias("block")).agg(
        F.sort_array(F.collect_list("at")).alias("wanted"))


def best_in_windows(held: DataFrame, asked: DataFrame, sizes: tuple[int, int], same: bool, k: int) -> DataFrame:
    """(batch, at, window, vec_id, score, rank): the k best rows of each anchor's windows.

    ``held`` are blocks and ``asked`` blocks of anchors, both stored tables. ``same`` asks for the
    anchor's label, else for any other one. The anchor itself never counts.
    """
    tried = _meet(held, asked, stored(_plan(held, asked, sizes, same, True), "plan"), same, k)
    raised = stored(
        asked.groupBy("batch").cogroup(tried.groupBy("batch")).applyInArrow(_with_floors(k), ASK_ROW), "asked")
    found = _meet(held, raised, stored(_plan(held, raised, sizes, same, False), "plan"), same, k)
    order = Window.partitionBy("batch", "at", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _hundredths(n: int, scores: np.ndarray) -> np.ndarray:
    """floor(n * score / 100) without a product that is too large."""
    return n * (scores // 100) + n * (scores % 100) // 100


def _with_windows(low: int, high: int, positives: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A window of ``low`` to ``high`` hundredths of its score for each positive of each anchor."""

    def run(asked: pa.Table, found: pa.Table) -> pa.Table:
        if not len(asked):
            return ASK_SCHEMA.empty_table()
        a = Asked(asked.to_pylist()[0])
        ends = np.full((2, len(a.ids), positives), 0)
        ends[0] = 1  # empty where there is no such positive
        at, rank, score = (found[c].to_numpy() for c in ("at", "rank", "score"))
        ends[0, at, rank - 1], ends[1, at, rank - 1] = -_hundredths(low, -score), _hundredths(high, score)
        return pa.Table.from_pylist(
            [_ask(a.batch, a.ids, a.labels, a.vectors, ends[0], ends[1], ends[0])], ASK_SCHEMA)

    return run


def mine(
    embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: float = 256.0, block: int = BLOCK, anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings`` has vec_id, embedding and label; ``is_anchor`` picks anchors by vec_id. Scores are
    inner products of floor(scale * x); higher ones come first, ties by smaller vec_id. An
    anchor's positives are its first rows of the same label. For each of them the first rows of any
    other label come back whose score is ``low`` to ``high`` hundredths of the positive's; a negative
    score leaves an empty window. Rows without a vec_id, a label or a vector, or with a component that
    is NULL or not finite, take no part. Of rows with one vec_id the smallest (label, vector) counts.
    Shorter vectors are filled up with zeros. Fewer rows than asked for: all of them; an empty
    table, or one without anchors: no rows. Other columns play no part. Scores are exact while they
    fit a long.
    """
    vectors = stored(
        embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(
            F.col("label").cast("long").alias("label"), whole(F.col("embedding"), scale).alias("vector")).alias("row"))
        .groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*"), "vectors")
    total, asked_for = vectors.select(F.count("*"), F.count_if(is_anchor)).first()
    ends = np.array(
        vectors.select(F.posexplode("vector").alias("i", "x")).groupBy("i").agg(F.min("x"), F.max("x"))
        .orderBy("i").collect(), np.int64).reshape(-1, 3)  # a row for each dimension
    width = len(ends)
    ranked = _numbered(placed(vectors, ends[:, 1], ends[:, 2])).withColumn("width", F.lit(width))
    held = stored(blocks(ranked, block), "blocks")
    asked = stored(asks(_numbered(ranked.filter(is_anchor).drop("n")), anchors), "asked")
    sizes = -(-total // (block * PART)), -(-asked_for // anchors)
    near = stored(best_in_windows(held, asked, sizes, True, positives), "positives")
    windows = stored(asked.groupBy("batch").cogroup(near.groupBy("batch")).applyInArrow(
        _with_windows(low, high, positives), ASK_ROW), "windows")
    far = best_in_windows(held, windows, sizes, False, negatives)
    names = stored(asked.select("batch", "ids").mapInArrow(_anchor_names, "batch long, at int, anchor_id long"), "names")
    known = near.select("batch", "at", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return far.join(known, ["batch", "at", "window"]).join(names, ["batch", "at"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def _anchor_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, ids in zip(batch["batch"].to_pylist(), batch["ids"].to_pylist()):
            names = _longs(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(names), number)), pa.array(np.arange(len(names), dtype=np.int32)),
                pa.array(names)], ["batch", "at", "anchor_id"])
