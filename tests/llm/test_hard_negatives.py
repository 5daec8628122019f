"""Hard negatives against scoring all pairs, the curve against its neighbours, and what is read."""

import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.llm import hard_negatives as hn
from barflow.llm.oracle import oracle_sql
from barflow.llm.queries import queries

SCHEMA = "vec_id long, embedding array<float>, label int, n int, score string, part string, batch string"


def all_pairs(rows, every=10, positives=5, negatives=10):
    """The result over (vec_id, embedding, label) rows, scored one by one."""
    known = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        known[vec_id] = min(known.get(vec_id, whole), whole)
    out = []
    for a, (label, x) in known.items():
        if a % every:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y)), b, other) for b, (other, y) in known.items() if b != a)
        for best, positive, _ in [s for s in scores if s[2] == label][:positives]:
            fit = [(s, b) for s, b, other in scores if other != label and -30 * best <= -100 * s <= -90 * best]
            out += [(a, positive, i, b, -best, -s) for i, (s, b) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def found(frame, every=10, **sizes):
    return sorted(tuple(r) for r in hn.mine(frame, F.col("vec_id") % every == 0, **sizes).collect())


@pytest.mark.parametrize("bits, dimensions", [(1, 5), (2, 3), (3, 2), (4, 2), (4, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(bits, dimensions):
    cells = np.array(list(product(range(1 << bits), repeat=dimensions)))
    places = [row.tobytes() for row in hn.curve(cells, bits)]
    assert len(set(places)) == len(cells)
    path = cells[sorted(range(len(cells)), key=places.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold_every_score():
    rng = np.random.default_rng(5)
    vectors, others = rng.integers(-200, 200, (20, 9)), rng.integers(-200, 200, (50, 9))
    least, most = hn.intervals(vectors, others.min(axis=0)[None], others.max(axis=0)[None])
    scores = vectors @ others.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    assert np.isinf(hn.intervals(vectors << 40, others[:1] << 20, others[:1] << 20)[1]).all()


@pytest.mark.parametrize("block, anchors", [(2048, 1024), (16, 8), (5, 3)])
def test_equals_all_pairs(spark, block, anchors):
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 0.2) + 0.3 * (j == i % 4) for j in range(8)], rng.randrange(4)) for i in range(240)]
    rows += [(i, rows[0][1], 1) for i in range(300, 340)]  # ties
    frame = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA).repartition(4)
    expected = all_pairs(rows)
    assert len({r[0] for r in expected}) > 20
    assert found(frame, block=block, anchors=anchors) == expected


def test_messy_rows(spark):
    """NULLs in every column, components that are no numbers, lengths that differ, repeated ids, one label."""
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3 + i % 2)], i % 3) for i in range(60)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (60, None, 1), (70, [1.0, None, 1.0], 1), (80, [1.0, float("nan"), 1.0], 2),
             (90, [float("inf")] * 3, 2), (100, [0.5] * 3, None), (10, [0.1] * 3, 0), (20, rows[20][1], rows[20][2]), (110, [], 1)]
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    assert found(frame, block=7, anchors=2) == all_pairs(rows)
    assert found(frame.filter("false")) == [] == found(frame.filter("vec_id % 10 <> 0"))
    assert found(frame.withColumn("label", F.lit(4))) == []
    assert found(frame.withColumn("embedding", F.array().cast("array<float>"))) == all_pairs(
        [(a, [], c) for a, _, c in rows])


def test_large_numbers_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(1e5, 1e6) for _ in range(4)], i % 2) for i in range(40)]
    assert found(spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA), block=8) == all_pairs(rows)


def test_a_search_reads_few_blocks_of_clustered_vectors(spark, monkeypatch):
    rng = random.Random(7)
    centres = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(40)]
    rows = [(i, [c + rng.gauss(0, 0.01) for c in centres[i % 40]], i % 40) for i in range(4000)]
    frame = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)
    plans = []
    plan = hn._plan

    def watched(held, asked, sizes, same, first):
        out = plan(held, asked, sizes, same, first).cache()
        plans.append((same, first, out.select(F.sum(F.size("wanted"))).first()[0]))
        return out

    monkeypatch.setattr(hn, "_plan", watched)
    assert found(frame, every=100, block=50, anchors=10) == all_pairs(rows, 100)
    read = {(same, first): n for same, first, n in plans}
    all_ = 40 * 80  # anchors and blocks
    assert read[True, False] < 0.1 * all_ and read[False, False] < 0.5 * all_


def test_equals_sql(spark, duck):
    ours = sorted(tuple(r) for r in queries()["op11_hard_negatives"](spark, "/root/testdata/sf0.01").collect())
    theirs = duck.execute(oracle_sql()["op11_hard_negatives"])
    assert [d[0] for d in theirs.description] == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert ours == sorted(theirs.fetchall()) and len(ours) == 250
