"""The classifier: held-out accuracy, the rule for held-out rows, and rows of every kind."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barflow.llm import quality
from barflow.llm.queries import queries

BIG = "/root/testdata/sf0.01"


def area(scores, labels):
    """Share of pairs of a positive and a negative that are in order."""
    p, n = scores[labels == 1], scores[labels == 0]
    return ((p[:, None] > n).mean() + (p[:, None] == n).mean() / 2)


@pytest.fixture(scope="module")
def scored(spark):
    rows = queries()["op7_quality_scores"](spark, BIG).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    return rows, labels


def test_held_out_accuracy(scored):
    rows, labels = scored
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    truth = np.array([labels[r["doc_id"]] for r in held])
    assert area(np.array([r["score"] for r in held]), truth) > 0.98
    assert np.mean([r["predicted"] == t for r, t in zip(held, truth)]) > 0.95
    assert np.mean([r["predicted"] for r, t in zip(held, truth) if t]) > 0.97


def test_columns_follow_their_rules(scored):
    for r in scored[0]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


def test_held_out_labels_are_never_seen(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(
        quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit(docs, labels), quality.fit(docs, turned)
    np.testing.assert_allclose(one.weights, two.weights, rtol=1e-3, atol=1e-4)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, 20_000)
    mixed = np.concatenate([rng.normal(2, 1, 14_000), rng.normal(-2, 1, 6_000)])
    assert abs(quality.estimate_prior(positive, mixed) - 0.7) < 0.04


def test_training_without_negatives_separates():
    rng = np.random.default_rng(1)
    positive = rng.normal(1, 1, (1500, 6)).astype(np.float32)
    negative = rng.normal(-1, 1, (1500, 6)).astype(np.float32)
    mixed = np.concatenate([rng.normal(1, 1, (1800, 6)), rng.normal(-1, 1, (1200, 6))]).astype(np.float32)
    model = quality.train(positive, mixed, negative[:0])
    right = [(model.logits(positive) > 0).mean(), (model.logits(negative) < 0).mean()]
    assert min(right) > 0.95 and abs(model.prior - 0.6) < 0.1


def test_features_of_each_text_alone():
    texts = ["", "One two two.\nOne two two.", "ÀÉ 123 !!", "x", "  \n", "a b c d " * 500]
    together = quality.features(pa.array(texts))
    assert not together[0].any() and np.isfinite(together).all()
    for text, row in zip(texts, together):
        np.testing.assert_allclose(quality.features(pa.array([text]))[0], row, rtol=1e-5, atol=1e-6)


def slow_features(text):
    """The measures by loops over characters, words and lines."""
    if not text:
        return [0.0] * quality.WIDTH
    kind = [quality._KIND[b] for b in text.encode()]
    grams = Counter(a * 64 + b * 8 + c for a, b, c in zip(kind, kind[1:], kind[2:]))
    out = [math.sqrt(grams[i] / max(len(kind) - 2, 1)) for i in range(512)]

    def lower(s):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)

    found = [lower(w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    lines = [lower(x) for x in re.findall(r"[^\n\r]+", text)]
    chunks = re.findall(r"[^ \t\n\r\v\f\x1c-\x1f]+", text)
    signs = re.findall(r"[^A-Za-z0-9\s\x1c-\x1f\x80-\U0010FFFF]{2,}", text)
    sizes = [len(w.encode()) for w in found]
    n = max(1, len(found))
    mean = sum(sizes) / n
    spread = math.sqrt(max(0, sum(x * x for x in sizes) / n - mean**2))
    most = max(Counter(found).values(), default=0) / n
    twice = sum(a == b for a, b in zip(found, found[1:])) / n
    fresh, n_lines = len(set(found)) / n, max(1, len(lines))
    return out + [
        math.log1p(len(kind)), math.log1p(n_lines), mean, spread, fresh, math.log1p(n) * fresh, most, twice,
        len(set(lines)) / n_lines, max(Counter(lines).values(), default=0) / n_lines,
        len(signs) / max(1, len(chunks)), max(1, len(chunks)) / n]


def test_features_against_loops(docs):
    texts = ["", "One two two.\nOne two two.", "ÀÉ 123 !! ??", "x", "  \n", "a b c d " * 500, "日本語 \t--==", "\r\n\r\n"]
    texts += [r["text"] for r in docs.select("text").limit(60).collect()]
    found = quality.features(pa.array(texts))
    for text, row in zip(texts, found):
        np.testing.assert_allclose(row, slow_features(text), rtol=2e-4, atol=2e-5)


@pytest.mark.parametrize("prior", [0.3, 0.95])
def test_gradients_against_differences(prior):
    """With a high prior the estimated loss on negatives is below zero, and its gradient is turned."""
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(40, 5)).astype(np.float32)
    rows[:15] += 1
    of_p, of_u = quality._side(15, rng.integers(1, 9, 25).astype(float))
    w, b, step = rng.normal(size=5) + 0.5, 0.2, 1e-3
    above, below, gradient = quality.risk(rows, of_p, of_u, prior, w, b)
    assert (below < 0) == (prior > 0.9)

    def value(w, b):
        first, second, _ = quality.risk(rows, of_p, of_u, prior, w, b)
        return first + second if below >= 0 else -second

    for i in range(6):
        there = np.zeros(6)
        there[i] = step
        slope = (value(w + there[:5], b + there[5]) - value(w - there[:5], b - there[5])) / (2 * step)
        assert abs(slope - gradient[i]) < 2e-3


def test_the_corpus_side_is_every_document(spark):
    """Sums over cells are those over all rows, and the shares above thresholds count each second one."""
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("ab c,.X9\n"), 60)) for _ in range(300)] + ["same text"] * 100
    frame = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, half int").repartition(7)
    corpus, rows = quality.Corpus(frame), quality.features(pa.array(texts))
    mean, spread = corpus.scale()
    np.testing.assert_allclose(mean, rows.mean(axis=0), rtol=1e-4, atol=1e-6)
    scaled = quality._scaled(rows, mean, spread)
    w = rng.normal(size=quality.WIDTH).astype(np.float32)
    z = quality._logits(scaled, w, 0.0)
    cells, n, half = corpus.cells(mean, spread, w, np.quantile(z, np.arange(1, quality.BINS) / quality.BINS))
    assert n.sum() == 400 and n[half == 0].sum() == 200 and len(cells) > 30
    np.testing.assert_allclose((cells * n[:, None]).sum(0), scaled.sum(0), rtol=1e-3, atol=2e-2)
    at = np.quantile(z, [0.1, 0.5, 0.9])
    reached, whole = corpus.above(mean, spread, w, 0.0, at)
    assert whole == 200 and np.abs(reached - [(z[1::2] >= t).sum() for t in at]).max() <= 1


def test_messy_rows(spark, messy, nothing, docs):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (4, 1), (None, 1), (8, None), (9, 0), (9, 0), (77, 1)], "doc_id long, quality int")
    rows = quality.score(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3)}
    assert len(empty) == 1
    for frame, known in ((messy, labels.limit(0)), (nothing, labels)):
        found = quality.score(frame, known)
        assert found.count() == frame.count() and found.filter("score <> 0.5").count() == 0
    kept = quality.keep_good(messy, labels.limit(0))
    assert kept.columns == messy.columns and kept.count() == messy.count()
