"""Leaks that must be found whatever else is in the table."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from barflow.llm import decontaminate
from barflow.llm.words import ALPHANUMERIC, words


def test_the_same_pair_is_found_in_a_table_of_any_size(monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    for n in (1_000, 100_000, 10_000_000):
        # every word of the item in one of a hundred documents, those beside it in no other
        monkeypatch.setattr(decontaminate, "_frequencies", lambda _, known, n=n: (np.full(len(known), n // 100), n))
        monkeypatch.setattr(decontaminate, "_range_sum", lambda _, known, w, space: (np.zeros(space.shape), 0.0))
        query = decontaminate.fit(None, [1], [item])
        found = decontaminate.leaks(query, words(pa.array([f"one two three {item} four five six"]), ALPHANUMERIC))
        assert [(key, part) for key, (_, part, _) in found.items()] == [((0, 0), 1.0)], n


@pytest.fixture(scope="module")
def reworded(spark):
    """Items with two of five words before the answer exchanged, between words that are not the benchmark's."""
    rng = random.Random(5)
    own, other = [f"b{i}" for i in range(900)], [f"w{i}" for i in range(30_000)]
    items = []
    for i in range(30):
        text = rng.sample(own, rng.randrange(10, 50))
        text[-5] += "."
        items.append((i, " ".join(text)))
    texts = []
    for i in range(240):
        text = rng.sample(other, rng.randrange(20, 200)) + rng.sample(own, 20)
        rng.shuffle(text)
        parts = items[i % 30][1].split()
        cut = len(parts) - 4
        changed = set(rng.sample(range(cut), int(0.4 * cut)))
        text[9:9] = [rng.choice(other) if k in changed else w for k, w in enumerate(parts)]
        texts.append((i, " ".join(text)))
    return (spark.createDataFrame(texts, "doc_id long, text string").repartition(4),
            spark.createDataFrame(items, "item_id long, text string"))


def scanned(query, text):
    """Pairs that the order and answer checks accept at any window, without a look at the cosine."""
    numbers = query.vocabulary.numbers(text.hash)
    sizes = decontaminate._window_of(np.array([len(w) for w in query.item_words]))
    found = set()
    for item, size in enumerate(sizes):
        wanted, answer, common = decontaminate._checked(query, item)
        pad = decontaminate.STEP + max(0, len(query.item_words[item]) - size)
        for document, (a, b) in enumerate(zip(text.first, text.first[1:])):
            for begin in range(a, max(a, b - size) + decontaminate.STEP, decontaminate.STEP):
                begin = min(begin, max(a, b - size))
                around = numbers[max(a, begin - pad):min(b, begin + size + pad)]
                around = around[(around >= 0) & (common | (query.weights[around] >= 0.7))].tolist()
                part = decontaminate.common_length(around, wanted) / len(wanted)
                if part >= 0.7 or part >= 0.5 and decontaminate.common_length(around, answer) >= 0.8 * len(answer):
                    found.add((document, item))
    return found


def test_recall_against_a_scan_without_gate(reworded):
    docs, benchmark = reworded
    rows = docs.orderBy("doc_id").collect()
    (query,) = decontaminate.queries_of(docs, benchmark)
    text = words(pa.array([r["text"] for r in rows]), ALPHANUMERIC)
    expected = scanned(query, text)
    found = set(decontaminate.leaks(query, text))
    print(f"{len(expected)} pairs by scan, {len(found & expected)} of them found")
    assert len(expected) >= 200 and found <= expected
    assert len(found) >= 0.99 * len(expected)


def test_a_table_of_one_document_that_is_the_item(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta."
    benchmark = spark.createDataFrame([(3, item), (4, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame([(1, item)], "doc_id long, text string")
    assert [(r["doc_id"], r["item_id"], r["part"]) for r in decontaminate.find(docs, benchmark).collect()] == [(1, 3, 1.0)]
    assert decontaminate.drop_leaks(docs, benchmark).count() == 0


@pytest.mark.parametrize("share", [0.3, 0.45, 0.6, 0.9])
def test_an_item_in_any_share_of_the_rows(spark, share):
    """Beside it stand words of other items, which weigh more."""
    rng = random.Random(3)
    own, other = [f"b{i}" for i in range(2000)], [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(own[40 * i:40 * i + 40])) for i in range(1, 50)] + [(0, " ".join(own[:22]))]
    texts = []
    for i in range(200):
        text = [rng.choice(own[40:] if rng.random() < 0.5 else other) for _ in range(60)]
        if i < 200 * share:
            text[21:21] = own[:22]
        texts.append((i, " ".join(text)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"] for r in decontaminate.find(docs, benchmark).filter("item_id = 0").collect()}
    assert found == set(range(int(200 * share)))


@pytest.mark.parametrize("width, length", [(4, 10), (40, 300), (9000, 5)])
def test_counts_of_words_near_windows(width, length):
    """Against sums block by block, also where the running sums wrap around."""
    rng = np.random.default_rng(width)
    counted = (rng.random((21, 6)) < 0.6).astype(np.uint8)
    counted[20] = 0
    blocks = rng.integers(-1, 20, (10_000, decontaminate.STEP))
    low = np.sort(rng.integers(0, 10_000 - width, 300))
    need = np.array([0.0, 2.5, length / 2, length, 0.5 * width * 8, 0.6 * width * 8])
    row, column, held = decontaminate._near(counted, blocks, low, low + width, need)
    each = counted[blocks].sum(axis=1).astype(np.int64)
    told = np.stack([each[a:a + width].sum(axis=0) for a in low])
    assert [*zip(row, column)] == [*zip(*np.nonzero(told >= need))] and (held == told[row, column]).all()


def test_words_of_scripts_without_spaces():
    texts = ["", "日本語", "ab日x本", "a。b é𠀀ü", "ไทย", "한국어 ok", "x"]
    text = words(pa.array(texts), ALPHANUMERIC, cut=True)
    data = "".join(texts).encode()
    found = [[data[a:b].decode() for a, b in zip(text.begin[i:j], text.end[i:j])] for i, j in zip(text.first, text.first[1:])]
    assert found == [[], ["日", "本", "語"], ["ab", "日", "x", "本"], ["a", "。", "b", "é", "𠀀", "ü"], ["ไ", "ท", "ย"],
                     ["한국어", "ok"], ["x"]]


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "水的沸点在海平面上是多少度。答案是一百摄氏度。"
    items = [(1, "Who wrote Hamlet?"), (2, chinese), (3, "何ですか"), (4, "Zanzibar"), (5, "who wrote hamlet"), (6, "?!")]
    texts = [
        (1, "He asked: WHO wrote Hamlet, and why"), (2, f"前面的文字{chinese}后面的文字也在这里"), (3, "これは何ですか、と"),
        (4, "who wrote of Hamlet"), (5, "Hamlet"), (6, "who wrote"), (7, "in Zanzibar."), (8, "水的沸点"), (9, None),
        (10, "前面" + chinese.replace("海平面", "这个山") + "后面"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(docs, benchmark).collect()
    expected = [(1, 1), (1, 5), (2, 2), (3, 3), (7, 4), (10, 2)]
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == expected
    assert {r["doc_id"] for r in decontaminate.drop_leaks(docs, benchmark).collect()} == {4, 5, 6, 8, 9}
    only_short = benchmark.filter("item_id <> 2")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, only_short).collect()) == [
        pair for pair in expected if pair[1] != 2]


def searched(monkeypatch, docs, items):
    """(query, text) with frequencies of these documents and any latent space."""
    text = words(pa.array(docs), ALPHANUMERIC, cut=True)

    def frequencies(_, known):
        of = np.repeat(np.arange(len(docs)), np.diff(text.first))
        numbers = known.numbers(text.hash)
        pairs = {(d, w) for d, w in zip(of.tolist(), numbers.tolist()) if w >= 0}
        return np.bincount([w for _, w in pairs], minlength=len(known)), len(docs)

    monkeypatch.setattr(decontaminate, "_frequencies", frequencies)
    monkeypatch.setattr(
        decontaminate, "_range_sum", lambda _, known, w, space: (np.random.default_rng(1).standard_normal(space.shape), 9.0))
    return decontaminate.fit(None, list(range(len(items))), items), text


@pytest.mark.parametrize("skew", [0.0, 0.7, 1.1])
def test_places_of_rare_words_and_counts_of_all_find_the_same(monkeypatch, skew):
    """Items of five to 700 words, some with repeated words, in texts of none to thousands of words."""
    rng = random.Random(skew)
    known = [f"w{i}" for i in range(3000)]
    share = [1 / (i + 1) ** skew for i in range(3000)]
    items = [" ".join(rng.choices(known, share, k=rng.choice([5, 9, 20, 33, 70, 150, 700]))) for _ in range(300)]
    items[7] = "again " * 9 + "and again"
    docs = ["", "w1", "again and " * 30]
    for _ in range(80):
        text = rng.choices(known, share, k=rng.choice([3, 40, 400, 3000]))
        own = [w if rng.random() < 0.75 else "other" for w in rng.choice(items).split()]
        at = rng.randrange(len(text))
        docs.append(" ".join(text[:at] + own + text[at:]))
    query, text = searched(monkeypatch, docs, items)
    found = []
    for places, held in ((10**9, 1), (0, 1 << 20), (0, 50), (decontaminate.PLACES, 1 << 20)):
        monkeypatch.setattr(decontaminate, "PLACES", places)  # 0: by places only; many: by counts, where there are any
        monkeypatch.setattr(decontaminate, "HELD", held)
        found.append(decontaminate.leaks(query, text))
    assert len(found[0]) >= 60 and all(f == found[0] for f in found)


def test_twenty_times_the_items_cost_less_than_twice(monkeypatch):
    """Search of 1.6 MB, words and all; counts in every block took ten times as long."""
    rng = random.Random(4)
    known = [f"w{i}" for i in range(30_000)]
    docs = [" ".join(rng.choices(known, k=rng.randrange(5, 800))) for _ in range(600)]
    items = [" ".join(rng.choices(known, k=rng.choice([8, 20, 40, 60, 120]))) for _ in range(4000)]
    for i in range(100):
        docs[i] += " " + items[2 * i]
    seconds = {}
    for n in (200, 4000):
        query, text = searched(monkeypatch, docs, items[:n])
        took = []
        for _ in range(7):
            start = time.perf_counter()
            found = decontaminate.leaks(query, words(pa.array(docs), ALPHANUMERIC, cut=True))
            took.append(time.perf_counter() - start)
        seconds[n] = min(took)
        assert {(i, 2 * i) for i in range(100)} >= set(found) and len(found) == min(100, n // 2)
    print(seconds)
    assert seconds[4000] < 2 * seconds[200]
