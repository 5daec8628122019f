"""Near duplicates against comparing all pairs."""

import random
import re
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from barflow.llm import near_dup
from barflow.llm.common import discard, scratch, stored
from barflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def smallest(links, nodes):
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def all_pairs(texts, k=4, least=80):
    sets = {i: shingles(t, k) for i, t in texts}
    links = [
        (a, b) for a, b in combinations(sorted(sets), 2)
        if min(map(len, (sets[a], sets[b]))) * 100 >= least * max(map(len, (sets[a], sets[b])))
        and sets[a] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])
    ]
    component = smallest(links, sets)
    return {i: (len(s), component[i], component[i] == i) for i, s in sets.items()}


def check(frame, k=4):
    rows = near_dup.groups(frame, k).collect()
    expected = all_pairs([(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()], k)
    assert {r[0]: tuple(r[1:]) for r in rows} == expected
    return expected


def varied(rng, base, share):
    return " ".join(rng.choice(["alpha", "beta", "gamma"]) + str(rng.randrange(99)) if rng.random() < share else w
                    for w in base)


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies around the threshold, a chain, a common passage, short and empty texts."""
    rng = random.Random(8)

    def fresh(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    out, base, common = [], fresh(120), fresh(60)
    out += [" ".join(base)] * 15
    out += [varied(rng, base, share) for share in (0.01, 0.02, 0.03, 0.04, 0.06) for _ in range(14)]
    step = fresh(100)
    for i in range(12):  # each is near the next only
        step = [*step[4:], *fresh(4)]
        out.append(" ".join(step))
    out += [" ".join(fresh(30) + common + fresh(30)) for _ in range(25)]
    out += [" ".join(fresh(n)) for n in (1, 2, 3, 4, 5, 6) for _ in range(3)] + ["same", "Same", "a b", "a  b\n"]
    out += ["", " \n", None]
    rng.shuffle(out)
    return list(enumerate(out, start=100))


def test_groups_equal_all_pairs(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    for k in (4, 5):
        expected = check(frame, k)
        sizes = [c for _, c, _ in expected.values()]
        assert max(sizes.count(c) for c in set(sizes)) > 20


def test_groups_of_documents(docs, nothing):
    check(docs)
    assert near_dup.groups(nothing).count() == 0


def test_second_phase_alone_joins_what_the_first_misses(spark, texts, monkeypatch):
    """Blocks of a few nodes, and a first phase that finds nothing but the links of the leaders."""
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    monkeypatch.setattr(near_dup, "verify", lambda pairs, *rest: pairs.limit(1))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    expected = all_pairs(texts)
    rows = {r[0]: r[2] for r in near_dup.groups(frame).collect()}
    known = [i for i, (n, c, _) in expected.items() if n]
    pairs = [(a, b) for a, b in combinations(known, 2) if expected[a][1] == expected[b][1]]
    together = sum(rows[a] == rows[b] for a, b in pairs)
    assert together > 0.5 * len(pairs)


def test_messy_rows(messy):
    rows = near_dup.groups(messy).collect()
    assert len(rows) == messy.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[7]["component_id"] == 1 and not by_id[7]["kept"] and by_id[1]["kept"]
    for i in (2, 3, 5):
        assert (by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2
    assert by_id[4]["n_shingles"] == 60_000 - 3 and by_id[9]["n_shingles"] == 1
    kept = near_dup.keep_one(messy)
    assert kept.columns == messy.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 8, 9]


A, B, U_, V = "a b c d e f g", "one two three four five six", "words that no other row has at all", "yet another text of its own here"


def test_different_texts_of_one_id_stay(spark):
    """Texts decide which rows go, not the doc_id that they share."""
    frame = spark.createDataFrame([(1, A), (7, A), (7, U_), (9, V)], "doc_id long, text string")
    assert sorted(map(tuple, near_dup.keep_one(frame).collect())) == [(1, A), (7, U_), (9, V)]
    frame = spark.createDataFrame([(1, A), (1, B), (2, A.upper()), (1, A), (None, A), (None, A)], "doc_id long, text string")
    assert sorted(map(str, near_dup.keep_one(frame).collect())) == sorted(map(str, [
        Row(doc_id=1, text=A), Row(doc_id=1, text=B), Row(doc_id=None, text=A), Row(doc_id=None, text=A)]))


def test_texts_of_one_id_are_one_document(spark):
    frame = spark.createDataFrame([(7, A), (7, B), (9, A), (3, B), (5, U_), (None, A), (7, None)], "doc_id long, text string")
    rows = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.groups(frame).collect()}
    assert rows == {(7, 4, 3, False), (7, 3, 3, False), (9, 4, 3, False), (3, 3, 3, True), (5, 5, 5, True),
                    (None, 4, None, True), (7, 0, 3, False)}


def test_repeated_ids_against_all_pairs(spark, texts):
    """Every third text under the doc_id of another one."""
    rows = [(i if i % 3 else i - 1, t) for i, t in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    numbers = sorted(set(rows), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    sets = {n: shingles(t, 5) for n, (_, t) in enumerate(numbers)}
    links = [(a, b) for a, b in combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    by_text = smallest(links, sets)
    left = near_dup.keep_one(frame).collect()
    component = {(d, t): by_text[n] for n, (d, t) in enumerate(numbers)}
    found = [component[tuple(r)] for r in left]
    assert sorted(found) == sorted(set(by_text.values()))  # one row of each group, the unique ones included
    first = {c: min(d for (d, _), of in component.items() if of == c) for c in set(found)}
    assert all(r["doc_id"] == first[component[tuple(r)]] for r in left)
    same_id = [(a, b) for a, b in combinations(sets, 2) if numbers[a][0] == numbers[b][0]]
    by_id = smallest(links + same_id, sets)
    for r in near_dup.groups(frame, 5).collect():
        of = by_id[next(n for n, (d, _) in enumerate(numbers) if d == r["doc_id"])]
        assert r["component_id"] == min(numbers[n][0] for n in sets if by_id[n] == of)


def test_joins_without_broadcast_split_a_bucket(spark, texts, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 4096)
    check(spark.createDataFrame(texts, "doc_id long, text string"))


def test_keep_one_without_broadcast(spark, texts, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 0)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    expected = {i for i, (_, _, kept) in all_pairs(texts, 5).items() if kept}
    assert {r[0] for r in near_dup.keep_one(frame).collect()} == expected


def test_posterior_keeps_what_may_be_alike():
    table = near_dup.least_matches(160, 32, 80, 1e-6)
    assert [n for n, _ in table] == [32, 64, 96, 128, 160]
    rng = np.random.default_rng(2)
    for similarity, low, high in ((0.8, 0.999, 1), (0.85, 1, 1), (0.5, 0, 0.05), (0.3, 0, 0)):
        right = rng.integers(0, 256, (4000, 160), dtype=np.uint8)
        left = np.where(rng.random((4000, 160)) < similarity, right, rng.integers(0, 256, (4000, 160), dtype=np.uint8))
        assert low <= len(near_dup.likely(left, right, 80)) / 4000 <= high


def test_minima_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(3)
    shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    sets = [np.sort(np.concatenate([shared, x])) for x in (a, b)]
    left, right = near_dup.signatures(np.concatenate(sets), np.array([0, 900]), 2000)
    assert abs((left == right).mean() - 0.8) < 0.04


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(50, i) for i in range(50)],
    [(3, 3), (9, 7), (7, 9), (8, 9), (1, 2)], [],
])
@pytest.mark.parametrize("few", [0, 10_000])
def test_components(spark, links, few, monkeypatch):
    monkeypatch.setattr("barflow.llm.components.FEW", few)
    random.Random(1).shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r[0]: r[1] for r in components(frame).collect()} == smallest([x for x in links if x[0] != x[1]], nodes)


def test_random_components(spark, monkeypatch):
    monkeypatch.setattr("barflow.llm.components.FEW", 0)
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(4)
    found = {r[0]: r[1] for r in components(frame.select("a", F.col("b"))).collect()}
    assert found == smallest([x for x in links if x[0] != x[1]], {n for a, b in links if a != b for n in (a, b)})


def folders(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


@pytest.mark.parametrize("few", [0, 10_000])
def test_tables_on_the_way_do_not_stay(spark, texts, few, monkeypatch):
    """Also with a column that is named like what a table remembers of its folder."""
    monkeypatch.setattr("barflow.llm.components.FEW", few)
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, stored_at string")
    expected = {i for i, (_, _, kept) in all_pairs(texts, 5).items() if kept}
    before = folders(spark)
    left = near_dup.keep_one(frame)
    made = {name.rsplit("-", 1)[0] for name in folders(spark) - before}
    assert made == {"gone", "again"}
    assert {r["doc_id"] for r in left.collect()} == expected
    before = folders(spark)
    found = near_dup.groups(frame.select("doc_id", "text"), 5)
    assert {name.rsplit("-", 1)[0] for name in folders(spark) - before} == {"signed", "nodes", "components"}
    assert {r["doc_id"] for r in found.filter("kept").collect()} == expected


def test_scratch_within_scratch(spark):
    some = spark.range(3)
    with scratch() as keep:
        with scratch() as keep_within:
            outer, lost = keep_within(stored(some, "outer")), stored(some, "lost")
        last = keep(stored(outer, "last"))
        assert outer.count() == 3 and not Path(lost.stored_at).exists()
    assert last.count() == 3 and not Path(outer.stored_at).exists()
    with pytest.raises(ValueError), scratch():
        lost = stored(some, "lost")
        raise ValueError
    assert not Path(lost.stored_at).exists()
    discard(last, some)
    assert not Path(last.stored_at).exists()
