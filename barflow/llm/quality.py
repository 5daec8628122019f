"""Quality classifier by positive-unlabelled learning with a non-negative risk.

A text becomes shares of trigrams over classes of characters and some measures of its words and
lines (length, repetition, capitals). A linear model is trained on trusted positives (training rows with
label 1) against all documents as unlabelled. The risk is

    prior * loss(positives as 1) + max(0, loss(unlabelled as 0) - prior * loss(positives as 0))

whose second term estimates the loss on negatives without having any and is kept from going below
zero, where it would reward overfitting. The prior, the share of positives among unlabelled
documents, is estimated first: a plain positive-against-unlabelled model ranks both, and the smallest
ratio of their upper shares, with a margin for chance, is the prior. Last, the scores are calibrated on
labelled training rows of both classes: negatives with a trusted label have a part in the scale of the
scores and so in ``predicted``, none in the ranking.

The only sample is that of labelled rows (``SAMPLE`` of each class at most, picked by a hash of doc_id).
The unlabelled side is the whole corpus, in three passes: means and spreads of all features; the corpus
as weighted cells (``BINS`` steps of a first score times signs of ``SIGNS_OF`` fixed projections, each cell the
mean of all its documents); and the shares of documents above each threshold of the plain model. What
comes to the driver of each is bounded by the numbers of features, cells and thresholds. Every second row
is left out of the plain model's cells, and those rows alone give the prior.
Every document is scored from its whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import pieces
from barflow.llm.words import ALPHANUMERIC, runs, text_bytes, words

#: At most so many labelled rows of each class.
SAMPLE = 4000
#: Cells of the corpus: steps of a first score, and projections whose signs divide each step.
BINS, SIGNS_OF = 32, 4
CELLS = BINS << SIGNS_OF
#: The part of rows whose labels are never learnt from, and the score of a 1.
PARTS, HELD_OUT = 4, 2
ACCEPT = 0.7

STEPS, RATE, DECAY = 400, 0.05, 1e-3

# Classes of bytes: lower case, capital, digit, line end, space, usual marks, other signs, beyond ASCII.
_KIND = np.full(256, 6, np.int64)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (
        7 if _b >= 0x80 else 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit()
        else 3 if _c in "\n\r" else 4 if _c.isspace() else 5 if _c in ".,;:?!'\"()-" else 6)
_NOT_LINE_END = np.array([b not in b"\n\r" for b in range(256)])
_NOT_SPACE = np.array([_KIND[b] not in (3, 4) for b in range(256)])
_SIGNS = np.isin(_KIND, (5, 6))
MEASURES = 12
WIDTH = 512 + MEASURES


def _repeats(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(share of items not met before in their document, share of the most frequent item)."""
    n = np.diff(first)
    documents = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    keys = np.sort(documents << np.uint64(40) | hashes >> np.uint64(24))
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    times = np.diff(np.append(new, len(keys)))
    of = (keys[new] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(len(n))
    np.maximum.at(most, of, times)
    whole = np.maximum(n, 1)
    return np.bincount(of, minlength=len(n)) / whole, most / whole


def features(column: pa.Array) -> np.ndarray:
    """One row for each text; an empty text has zeros."""
    data, offsets = text_bytes(column)
    n, size = len(column), np.diff(offsets)
    kind = _KIND[data]
    documents = np.repeat(np.arange(n), size)
    out = np.zeros((n, WIDTH), np.float32)
    if not len(data):
        return out
    code = kind[:-2] * 64 + kind[1:-1] * 8 + kind[2:]
    within = documents[:-2] == documents[2:]
    counts = np.bincount((documents[:-2] * 512 + code)[within], minlength=n * 512).reshape(n, 512)
    out[:, :512] = np.sqrt(counts / np.maximum(size - 2, 1)[:, None])

    text = words(column, ALPHANUMERIC)
    count = np.maximum(np.diff(text.first), 1)
    lengths = text.end - text.begin
    of = np.repeat(np.arange(n), np.diff(text.first))
    mean = np.bincount(of, lengths, n) / count
    spread = np.sqrt(np.maximum(0, np.bincount(of, lengths.astype(float) ** 2, n) / count - mean**2))
    fresh, most = _repeats(text.hash, text.first)
    twice = np.zeros(n)
    if len(of) > 1:
        same = (text.hash[1:] == text.hash[:-1]) & (of[1:] == of[:-1])
        twice = np.bincount(of[1:][same], minlength=n) / count
    lines = words(column, _NOT_LINE_END)
    line_fresh, line_most = _repeats(lines.hash, lines.first)
    n_lines = np.maximum(np.diff(lines.first), 1)
    begin, end = runs(data, offsets, _SIGNS)
    sign_runs = np.bincount(np.searchsorted(offsets, begin[end - begin > 1], side="right") - 1, minlength=n)
    chunk_begin, _ = runs(data, offsets, _NOT_SPACE)
    chunks = np.maximum(np.bincount(np.searchsorted(offsets, chunk_begin, side="right") - 1, minlength=n), 1)
    out[:, 512:] = np.stack([
        np.log1p(size), np.log1p(n_lines), mean, spread, fresh, np.log1p(count) * fresh, most, twice,
        line_fresh, line_most, sign_runs / chunks, chunks / count], axis=1)
    out[size == 0] = 0
    return out


class Model(NamedTuple):
    """``score`` is the logistic function of (features - mean) / spread times weights, plus bias."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.spread, -8, 8) @ self.weights + self.bias


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, width: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam; ``gradient`` maps them to their gradient."""
    at, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        g = gradient(at[:-1], at[-1])
        g[:-1] += DECAY * at[:-1]
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        rate = RATE * (1 - t / (steps + 1))
        at -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return at[:-1], float(at[-1])


def least_ratio(above_p: np.ndarray, above_u: np.ndarray, n_p: int, n_u: int, chance: float = 0.1) -> float:
    """The least ratio of shares above a threshold, unlabelled to positive, margins for chance added."""
    margin = np.sqrt(np.log(4 / chance) / 2) * (n_p ** -0.5 + n_u ** -0.5)
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def _thresholds(positive: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(positive, np.linspace(0, 0.99, 100)))


def _above(values: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """How many values reach each threshold."""
    return len(values) - np.searchsorted(np.sort(values), thresholds, side="left")


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, chance: float = 0.1) -> float:
    """The prior from the scores of both."""
    at = _thresholds(positive)
    shares = _above(positive, at) / len(positive), _above(unlabelled, at) / len(unlabelled)
    return least_ratio(*shares, len(positive), len(unlabelled), chance)


def _scaled(rows: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((rows - mean) / spread, -8, 8).astype(np.float32)


def _logits(x: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    return x @ w.astype(np.float32) + np.float32(b)


def _spread_of(n: float, sums: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = sums / n
    spread = np.sqrt(np.maximum(0, squares / n - mean**2))
    return mean.astype(np.float32), np.where(spread > 1e-6, spread, 1.0).astype(np.float32)


class Rows:
    """The unlabelled side as an array of features, for small ones: every row is a cell."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows.astype(np.float64)

    def scale(self) -> tuple[np.ndarray, np.ndarray]:
        return _spread_of(len(self.rows), self.rows.sum(0), (self.rows**2).sum(0))

    def cells(self, mean: np.ndarray, spread: np.ndarray, *first: object) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mean scaled features, documents, half) of each cell."""
        n = len(self.rows)
        return _scaled(self.rows, mean, spread), np.ones(n), np.arange(n) % 2

    def above(self, mean: np.ndarray, spread: np.ndarray, w: np.ndarray, b: float, at: np.ndarray) -> tuple[np.ndarray, int]:
        """(documents of the second half that reach each threshold, all of them)."""
        z = _logits(_scaled(self.rows[1::2], mean, spread), w, b)
        return _above(z, at), len(z)


def _projections(width: int) -> np.ndarray:
    return np.random.default_rng(20).normal(size=(width, SIGNS_OF)).astype(np.float32)


class Corpus:
    """The unlabelled side as all documents of a table with ``text`` and ``half`` (0 or 1)."""

    def __init__(self, documents: DataFrame) -> None:
        self.documents = documents

    def _sums(self, of: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """Sums over all documents of a function of a piece's features and halves: a row for each number."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in pieces(batches):
                total += of(features(batch["text"]), batch["half"].to_numpy())
            yield pa.RecordBatch.from_pylist([{"sums": total.tolist()}])

        rows = self.documents.mapInArrow(run, "sums array<double>").select(F.posexplode("sums")).groupBy("pos").agg(
            F.sum("col").alias("total")).orderBy("pos").toArrow()
        return rows["total"].to_numpy() if len(rows) else np.zeros(width)

    def scale(self) -> tuple[np.ndarray, np.ndarray] | None:
        def moments(rows: np.ndarray, half: np.ndarray) -> np.ndarray:
            rows = rows.astype(np.float64)
            return np.concatenate([[len(rows)], rows.sum(0), (rows**2).sum(0)])

        total = self._sums(moments, 1 + 2 * WIDTH)
        return _spread_of(total[0], total[1:1 + WIDTH], total[1 + WIDTH:]) if total[0] else None

    def cells(
        self, mean: np.ndarray, spread: np.ndarray, w: np.ndarray, edges: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mean scaled features, documents, half) of each cell; ``w`` and ``edges`` are the steps' score."""
        projections, powers = _projections(len(mean)), 1 << np.arange(SIGNS_OF)
        schema = pa.schema([("cell", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2 * CELLS, 1 + len(mean)))
            for batch in pieces(batches):
                rows = _scaled(features(batch["text"]), mean, spread)
                cell = np.searchsorted(edges, _logits(rows, w, 0.0)) << SIGNS_OF
                cell += ((rows @ projections > 0) * powers).sum(axis=1)
                cell += batch["half"].to_numpy() * CELLS
                order = np.argsort(cell, kind="stable")
                at = np.flatnonzero(np.append(True, cell[order][1:] != cell[order][:-1])) if len(cell) else []
                if len(at):
                    sums[cell[order][at], 1:] += np.add.reduceat(rows[order].astype(np.float64), at, axis=0)
                    sums[:, 0] += np.bincount(cell, minlength=2 * CELLS)
            part = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_pylist(
                [{"cell": i, "part": part, "sums": sums[i].tobytes()} for i in np.flatnonzero(sums[:, 0]).tolist()], schema)

        def added(rows: pa.Table) -> pa.Table:
            total = np.sum([np.frombuffer(x) for x in rows["sums"].to_pylist()], axis=0)
            return pa.Table.from_pylist(
                [{"cell": rows["cell"][0].as_py(), "part": rows["part"][0].as_py(), "sums": total.tobytes()}], schema)

        kind = "cell int, part int, sums binary"
        parts = self.documents.mapInArrow(run, kind).groupBy("cell", "part").applyInArrow(added, kind)
        got = parts.groupBy("cell").applyInArrow(added, kind).toArrow().sort_by("cell")  # a row for each cell
        sums = np.array([np.frombuffer(x) for x in got["sums"].to_pylist()])
        return (sums[:, 1:] / sums[:, :1]).astype(np.float32), sums[:, 0], got["cell"].to_numpy() // CELLS

    def above(self, mean: np.ndarray, spread: np.ndarray, w: np.ndarray, b: float, at: np.ndarray) -> tuple[np.ndarray, int]:
        """(documents of the second half that reach each threshold, all of them)."""

        def counts(rows: np.ndarray, half: np.ndarray) -> np.ndarray:
            z = _logits(_scaled(rows[half == 1], mean, spread), w, b)
            return np.append(_above(z, at), len(z))

        total = self._sums(counts, len(at) + 1)
        return total[:-1], int(total[-1])


def plain_gradient(rows: np.ndarray, of_p: np.ndarray, of_u: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    """Of the mean of both sides' losses; ``of_p`` and ``of_u`` weigh rows so that sums are means of a side."""
    s = _logistic(_logits(rows, w, b))
    error = (of_p * (s - 1) + of_u * s) / 2
    return np.append(error @ rows, error.sum())


def risk(
    rows: np.ndarray, of_p: np.ndarray, of_u: np.ndarray, prior: float, w: np.ndarray, b: float
) -> tuple[float, float, np.ndarray]:
    """(loss of positives as 1 times prior, estimated loss on negatives, gradient to follow)."""
    z = _logits(rows, w, b)
    s, as_zero = _logistic(z), of_u - np.float32(prior) * of_p
    of_positives, of_negatives = prior * float(of_p @ np.logaddexp(0, -z)), float(as_zero @ np.logaddexp(0, z))
    # Below zero: undo the overfitting of the second term instead of following it.
    error = np.float32(prior) * of_p * (s - 1) + as_zero * s if of_negatives >= 0 else -as_zero * s
    return of_positives, of_negatives, np.append(error @ rows, error.sum())


def _side(n_positive: int, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of positives and of cells, one after the other, that make sums the mean of either."""
    of_p, of_u = np.zeros((2, n_positive + len(documents)), np.float32)
    of_p[:n_positive], of_u[n_positive:] = 1 / n_positive, documents / documents.sum()
    return of_p, of_u


def _first_score(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Weights that roughly rank documents: positives against negatives, or against the corpus' mean (0)."""
    if not len(negative):
        return positive.mean(axis=0)
    rows = np.concatenate([positive, negative])
    of_p, of_n = _side(len(positive), np.ones(len(negative)))
    return _descend(lambda w, b: plain_gradient(rows, of_p, of_n, w, b), rows.shape[1], STEPS // 4)[0]


def train(positive: np.ndarray, unlabelled: np.ndarray | Corpus, negative: np.ndarray) -> Model | None:
    """``negative`` calibrates, and helps to divide a corpus into cells; the risk does without.

    None for a corpus without documents.
    """
    corpus = Rows(unlabelled) if isinstance(unlabelled, np.ndarray) else unlabelled
    scale = corpus.scale()
    if scale is None:
        return None
    mean, spread = scale
    good, bad = _scaled(positive, mean, spread), _scaled(negative, mean, spread)
    n = len(good)
    first = _first_score(good, bad)
    edges = np.quantile(_logits(np.concatenate([good, bad]), first, 0.0), np.arange(1, BINS) / BINS)
    cells, documents, half = corpus.cells(mean, spread, first, edges)

    # Plain model on every second row; the other half, not trained on, gives the prior.
    prior = 0.5
    if n > 1 and (half == 0).any() and (half == 1).any():
        rows, (of_p, of_u) = np.concatenate([good[::2], cells[half == 0]]), _side(-(-n // 2), documents[half == 0])
        w, b = _descend(lambda w, b: plain_gradient(rows, of_p, of_u, w, b), rows.shape[1], STEPS // 2)
        other = _logits(good[1::2], w, b)
        at = _thresholds(other)
        reached, whole = corpus.above(mean, spread, w, b, at)
        prior = least_ratio(_above(other, at) / len(other), reached / whole, len(other), whole)

    every, (of_p, of_u) = np.concatenate([good, cells]), _side(n, documents)
    w, b = _descend(lambda w, b: risk(every, of_p, of_u, prior, w, b)[2], every.shape[1])
    if len(bad):
        z = np.concatenate([_logits(good, w, b), _logits(bad, w, b)])[:, None]
        label = np.repeat([1.0, 0.0], [n, len(bad)])
        weight = np.where(label == 1, 0.5 / n, 0.5 / len(bad))  # both classes alike
        middle, unit = z.mean(), z.std() or 1.0
        z = (z - middle) / unit

        def calibrated(a: np.ndarray, c: float) -> np.ndarray:
            error = weight * (_logistic(z @ a + c) - label)
            return np.append(error @ z, error.sum())

        a, c = _descend(calibrated, 1)
        slope = max(1e-3, float(a[0])) / unit
        w, b = w * slope, (b - middle) * slope + c
    return Model(mean, spread, w, float(b), prior)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """None without a positive label or a document to learn from.

    Of a doc_id with several labels the lowest counts; rows without doc_id or quality do not. All
    documents that are not held out are the unlabelled side, repeated rows as often as they are there.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id")
    some = known.filter("label = 1").orderBy(order).limit(sample).unionByName(
        known.filter("label = 0").orderBy(order).limit(sample))  # at most 2 * sample rows
    free = documents.filter(~is_held_out(F.col("doc_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    labelled = free.join(F.broadcast(some), "doc_id").groupBy(F.xxhash64("doc_id").alias("key"), "label").agg(
        F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = features(batch["text"])
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["label"], pa.array([r.tobytes() for r in rows], pa.binary())], ["key", "label", "row"])

    got = labelled.mapInArrow(run, "key long, label int, row binary").toArrow().sort_by("key")
    rows = np.frombuffer(b"".join(got["row"].to_pylist()), np.float32).reshape(-1, WIDTH)
    label = got["label"].to_numpy()
    if not (label == 1).any():
        return None
    halves = free.select("text", (F.monotonically_increasing_id() % 2).alias("half"))
    return train(rows[label == 1], Corpus(halves), rows[label == 0])


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def scores(column: pa.Array, model: Model | None) -> np.ndarray:
    return np.full(len(column), 0.5) if model is None else _logistic(model.logits(features(column)))


def score(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, whether its label is held out, score and prediction of every document.

    NULL and empty texts get the score of a text without anything. Without a positive label every
    score is 0.5. Repeated rows stay repeated; a NULL doc_id is not held out; other columns
    (lang, source) play no part; an empty table gives an empty result.
    """
    model = fit(documents, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = scores(batch["text"], model)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast("int64"), batch["held_out"], pa.array(found, pa.float64()),
                 pa.array(found >= ACCEPT).cast("int32")], ["doc_id", "held_out", "score", "predicted"])

    return documents.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, SCORED)


def keep_good(documents: DataFrame, labels: DataFrame, least: float = ACCEPT, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``documents``, unchanged, whose score is ``least`` or more; all without a positive label."""
    model = fit(documents, labels, sample)
    if model is None:
        return documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [pa.array(scores(piece["text"], model) >= least) for piece in pieces(iter([batch]))]
            if kept:
                yield batch.filter(pa.concat_arrays(kept))

    return documents.mapInArrow(run, documents.schema)
