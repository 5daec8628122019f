"""URL rules, sharding, top-k and decontamination against plain loops and SQL."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barflow.llm import decontaminate, sharding, topk, url_rules
from barflow.llm.oracle import oracle_sql
from barflow.llm.queries import queries
from barflow.llm.words import ALPHANUMERIC, Vocabulary, words

BIG = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_equal_sql(spark, duck, name):
    ours = queries()[name](spark, BIG)
    theirs = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    assert sorted(str(tuple(r)) for r in ours.select(columns).collect()) == sorted(map(str, theirs.fetchall()))


def fits(host, path, rule):
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return host.translate({a: a + 32 for a in range(65, 91)}), path


def judged(url, rules, default):
    host, path = split(url)
    own = sorted({(len(h + p), h + p) for h, p, _ in rules if fits(host, path, (h, p))})
    if not own:
        return host, path, None, default
    best = own[-1][1]
    return host, path, best, max(v for h, p, v in rules if h + p == best and fits(host, path, (h, p)))


@pytest.mark.parametrize("slice_rows", [1, 1_000_000])
def test_rules_against_loops(spark, slice_rows):
    rng = random.Random(7)

    def name():
        return ".".join(rng.choice(["a", "b", "net", "é", ""]) for _ in range(rng.randrange(1, 5)))

    def path():
        return "".join(rng.choice(["/", "a", "b/", "é", "/\U0010ffff", "\x01"]) for _ in range(rng.randrange(0, 6)))

    rules = [(name(), path(), rng.choice(["allow", "block"])) for _ in range(60)]
    urls = [f"http://{name()}/{path()}{rng.choice(['', '?x=/a', '#://b'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "x://", "://A.NET/", "a://b://net/a", "http://net", "http://NET?x", "\n://net/a"] * 2
    frame = spark.createDataFrame([(i, u, "rule") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_rules.judge(frame.repartition(3), table, default="neither", slice_rows=slice_rows)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = {r["page_id"]: tuple(r[2:]) for r in found.collect()}
    for i, url in enumerate(urls):
        host, path_, rule, verdict = judged(url, rules, "neither")
        assert rows[i][:3] == (host, path_, rule), url
        # one text may be two rules ("a" + "b/" and "a.b"...): hosts and paths never mix here
        assert rows[i][3] == verdict or len({v for h, p, v in rules if h + p == rule}) > 1


def test_rules_with_gaps_and_repeated_pages(spark):
    schema = "host string, path string, verdict string"
    pages = spark.createDataFrame([(1, "http://x.net/a")] * 3 + [(None, None)], "page_id long, url string")
    rules = spark.createDataFrame(
        [(None, "/", "block"), ("net", None, "block"), ("x.net", "/a", None), ("X.Net", "/", "allow"), ("x.net", "/", "block")],
        schema)
    rows = url_rules.judge(pages, rules).collect()
    assert sorted((r["rule"] or "", r["verdict"]) for r in rows) == [("", "allow")] + [("x.net/", "block")] * 3
    assert {r["verdict"] for r in url_rules.judge(pages, spark.createDataFrame([], schema)).collect()} == {"allow"}
    assert url_rules.judge(pages.limit(0), rules).count() == 0


def test_rules_run_without_python(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    pages = spark.read.parquet(f"{BIG}/pages.parquet").select("page_id", "url")
    plan = url_rules.judge(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "html" not in plan
    assert plan.count("hashpartitioning(slice") == 1


def turns(shards, slots):
    """Claims in turns, by the orders written out."""
    orders = {}
    for s in shards:
        at, stride = sharding._hash(f"offset {s}") % slots, sharding._hash(f"stride {s}") % (slots - 1) + 1
        orders[s] = [(at + i * stride) % slots for i in range(slots)]
    table = {}
    while len(table) < slots:
        for s in sorted(shards):
            if len(table) < slots:
                table[next(x for x in orders[s] if x not in table)] = s
    return [table[i] for i in range(slots)]


def test_table_is_filled_in_turns():
    shards = [f"s{i}" for i in range(7)]
    table = sharding.fill(shards, 211)
    assert table == turns(shards, 211)
    counts = [table.count(s) for s in shards]
    assert max(counts) - min(counts) <= 1
    fewer = sharding.fill(shards[:-1], 211)
    assert sum(a != b for a, b in zip(table, fewer) if a != "s6") < 0.35 * 211
    weighted = sharding.fill({"a": 3, "b": 1, "c": 0}, 211)
    assert abs(weighted.count("a") - 3 * weighted.count("b")) <= 4 and "c" not in weighted
    for bad in (([], 211), (shards, 210), (shards, 5), ({"a": 0}, 211), (shards, 2_000_003)):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


def test_placement(spark, messy, nothing):
    import hashlib

    table = sharding.fill(sharding.SHARDS, sharding.SLOTS)
    placed = sharding.place(messy.withColumn("slot", F.lit("old")), "doc_id")
    assert placed.count() == messy.count() and placed.columns.count("slot") == 1
    for r in placed.collect():
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, table[slot])
    assert sharding.place(nothing, "doc_id").count() == 0
    many = sharding.place(spark.range(64_000).withColumnRenamed("id", "doc_id"), "doc_id")
    assert "BroadcastHashJoin" in many._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in many.groupBy("shard").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 1.25 * 1000


def best(rows, query, k):
    own = dict(rows)[query]
    scores = []
    for i, v in rows:
        if i != query:
            width = max(len(v), len(own))
            a, b = (np.pad(np.array(x, np.int64), (0, width - len(x))) for x in (v, own))
            scores.append((-int(a @ b), i))
    return [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]


@pytest.mark.parametrize("n, width, block", [(3, 4, 8), (400, 6, 64), (250, 1, 1000)])
def test_top_k_with_ties(spark, n, width, block):
    rng = random.Random(n)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.251, 1.0]) for _ in range(width)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]  # one very common vector
    bad = [(None, [1.0] * width), (9001, None), (9002, [None] + [1.0] * (width - 1)), (9003, [float("nan")] * width),
           (9004, [float("inf")] * width)]
    short = [(9005, [1.0]), (9006, [])]
    frame = spark.createDataFrame(rows + bad + short + rows[:5], "vec_id long, embedding array<double>").repartition(4)
    found = topk.search(frame, F.col("vec_id") % 7 == 0, 5, 256.0, block, 16).collect()
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows + short]
    expected = [r for i, _ in whole if i % 7 == 0 for r in best(whole, i, 5)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_top_k_of_large_numbers(spark):
    frame = spark.createDataFrame([(i, [2.0**20 + i, 1.0 / 256]) for i in range(20)], "vec_id long, embedding array<double>")
    found = topk.search(frame, F.col("vec_id") == 0, 3).collect()
    base = int(2**28) ** 2
    assert [tuple(r) for r in found] == [(0, k + 1, 19 - k, base + 2**28 * 256 * (19 - k) + 1) for k in range(3)]
    assert topk.search(frame.limit(0), F.lit(True)).count() == 0


def test_the_walk_stops_early():
    rng = np.random.default_rng(0)
    vectors = rng.integers(0, 5, (5000, 2))
    vectors[17] = (900, 900)
    vectors[18:22] = 800
    ((names, scores),) = topk.threshold_search(
        np.arange(5000), vectors, np.array([[1, 2]]), np.array([-1]), 5)
    assert names.tolist() == [17, 18, 19, 20, 21] and scores[0] == 2700


@pytest.fixture(scope="module")
def leaky(spark):
    """Items stated whole, with words changed, and in part, between documents of other words."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]

    def prose(n):
        return [rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]

    items = []
    for i in range(40):
        text = prose(rng.randrange(14, 60))
        text[-6] += "."
        items.append((i, " ".join(text)))
    texts, whole, changed = [], set(), set()
    for i in range(300):
        words_ = prose(rng.randrange(20, 400))
        if i % 5 == 0:
            item, text = items[i % 40]
            words_[7:7] = text.upper().split()
            whole.add((i, item))
        elif i % 5 == 1:
            item, text = items[(i * 3) % 40]
            parts = text.split()
            cut = len(parts) - 6
            words_[9:9] = [w if rng.random() < 0.75 else rng.choice(vocabulary) for w in parts[:cut]] + parts[cut:]
            changed.add((i, item))
        texts.append((i, " ".join(words_)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    return docs, spark.createDataFrame(items, "item_id long, text string"), whole, changed


def test_leaks_are_found_and_nothing_else(leaky):
    docs, benchmark, whole, changed = leaky
    rows = decontaminate.find(docs, benchmark).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert whole <= found and found <= whole | changed
    assert len(found & changed) >= 0.9 * len(changed)
    assert all(r["part"] == 1 for r in rows if (r["doc_id"], r["item_id"]) in whole)
    clean = decontaminate.drop_leaks(docs, benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in found}


def test_an_item_in_a_third_of_all_documents(spark, leaky):
    docs, benchmark, whole, _ = leaky
    (item, text) = benchmark.orderBy("item_id").first()
    hot = spark.range(5000, 5150).select(F.col("id").alias("doc_id"), F.concat(F.lit("q r s t u v w "), F.lit(text)).alias("text"))
    found = {r["doc_id"] for r in decontaminate.find(docs.unionByName(hot), benchmark).filter(f"item_id = {item}").collect()}
    assert set(range(5000, 5150)) <= found


def test_every_verbatim_leak_of_the_tables(spark):
    benchmark = spark.read.parquet(f"{BIG}/benchmark.parquet")
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def plain(text):
        return f" {' '.join(pattern.findall(text.translate({a: a + 32 for a in range(65, 91)})))} "

    items = [(r["item_id"], plain(r["text"])) for r in benchmark.collect()]
    texts = [(r["doc_id"], plain(r["text"])) for r in docs.collect()]
    expected = {(d, i) for d, t in texts for i, x in items if x in t}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, benchmark).collect()} == expected


def test_messy_documents_and_items(spark, messy, nothing):
    items = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (4, "two words"),
             (None, "one two three four five six")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(messy, benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in rows) == [(0, 1), (1, 1), (7, 1), (7, 1)]
    assert decontaminate.drop_leaks(messy, benchmark).count() == messy.count() - 4
    assert decontaminate.find(nothing, benchmark).count() == 0
    assert decontaminate.find(messy, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_leaks(messy, benchmark.limit(0)).count() == messy.count()


def test_range_sum_is_the_product(leaky):
    docs, benchmark, _, _ = leaky
    texts = [r["text"] for r in docs.collect()]
    text = words(pa.array(texts), ALPHANUMERIC)
    vocabulary = Vocabulary(words(pa.array([r["text"] for r in benchmark.collect()]), ALPHANUMERIC).hash)
    weights = np.linspace(0, 2, len(vocabulary))
    space = np.random.default_rng(0).standard_normal((len(vocabulary), 8)).astype(np.float32)
    total, count = decontaminate._range_sum(docs, vocabulary, weights, space)
    numbers = vocabulary.numbers(text.hash)
    rows = []
    for a, b in zip(text.first, text.first[1:]):
        for at in range(a, b, decontaminate.PASSAGE):
            some = numbers[at:min(b, at + decontaminate.PASSAGE)]
            some = some[some >= 0]
            rows.append(np.bincount(some[weights[some] > 0], minlength=len(vocabulary)))
    matrix = np.array(rows, float)
    assert count == matrix.sum()
    np.testing.assert_allclose(total, matrix.T @ (matrix @ space), rtol=1e-3, atol=1e-2)


def test_common_length():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(0, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_length(a, b) == table[-1][-1]
