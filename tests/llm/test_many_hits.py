"""Very long texts with many hits, tables of equal rows, many rules: work stays in proportion."""

import hashlib
import time

import pyarrow as pa
from pyspark.sql import functions as F

from barflow.llm import bitplane, licenses, secret_scan, url_rules


def hexes(n):
    return [hashlib.md5(str(i).encode()).hexdigest() for i in range(n)]


def test_a_hundred_thousand_secrets_in_one_text(spark):
    """Equal to the spans by the fixed pattern, and in seconds."""
    keys = hexes(100_000)
    text = "".join(f"é {k}\n" for k in keys)
    batch = pa.RecordBatch.from_pydict({"text": [text, "x " + keys[0]]})
    judge = secret_scan.Judge([1.0] * 256)
    start = time.process_time()
    first, second = secret_scan._spans(batch, judge, 1 << 30)
    assert time.process_time() - start < 30
    assert sorted(first) == [(2 + 35 * i, 2, 34 + 35 * i) for i in range(100_000)] and second == [(2, 2, 34)]


def test_random_tokens_within_fixed_spans_add_none():
    """Against holding each token against every fixed span."""
    keys = hexes(300)
    text = " ".join(f'token="{k}ZZ" {k} q{k}' if i % 3 else f"é {k[:20]}xyzXYZ+/9 " for i, k in enumerate(keys))
    batch = pa.RecordBatch.from_pydict({"text": [text]})
    (found,) = secret_scan._spans(batch, secret_scan.Judge([1.0] * 256), 0)
    fixed = [s for s in found if s[1] < 3]
    random = [s for s in found if s[1] == 3]
    assert fixed and random
    assert not any(a <= s and e <= z for s, _, e in random for a, _, z in fixed)
    for start, _, end in random:
        assert text[start:end].strip("=").isascii() and " " not in text[start:end]


def test_a_hundred_thousand_notices_in_one_text():
    """Kept spans of a label do not overlap, and are those of comparing with all kept ones."""
    import random

    rng = random.Random(1)
    chains = [(rng.choice([0.5, 0.9, 1.0]), rng.choice("ab"), a, a + rng.randrange(1, 40)) for a in rng.choices(range(900), k=500)]

    def slow(chains):
        kept = []
        for c in sorted(chains, key=lambda c: (-c[0], c[2], c[3])):
            if all(c[1] != k[1] or c[3] <= k[2] or k[3] <= c[2] for k in kept):
                kept.append(c)
        return sorted(kept, key=lambda c: (c[2], c[1]))

    assert licenses._best_spans(chains) == slow(chains)
    many = [(1.0 - i % 7 / 100, "mit", 20 * i, 20 * i + 15) for i in range(100_000)]
    start = time.process_time()
    assert len(licenses._best_spans(many)) == 100_000
    assert time.process_time() - start < 20


def test_equal_rows_go_to_several_files(spark, tmp_path):
    frame = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one and the same text").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = bitplane.write_ids(frame, str(tmp_path / "ids"), bitplane.tokens.default_vocabulary(), "byte")
        largest = files.agg(F.max("n_documents"), F.sum("n_documents")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert largest[1] == 4000 and largest[0] < 4000


def test_many_rules_and_few_pages(spark):
    """The copies of rules stay a part of the pages, or one copy."""
    rules = spark.range(20_000).select(
        F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.lit("/").alias("path"), F.lit("block").alias("verdict"))
    pages = spark.range(1000).select(F.concat(F.lit("http://www.h"), F.col("id") * 40, F.lit(".org/x")).alias("url"))
    judged = url_rules.judge(pages, rules)
    assert judged.groupBy("verdict").count().orderBy("verdict").collect() == [("allow", 500), ("block", 500)]
    for n_pages, n_rules, slices in ((1000, 20_000, 1), (0, 0, 1), (1000, 4, 62), (10**9, 4, 1000), (10**9, 10**6, 250)):
        assert url_rules.slice_count(n_pages, n_rules, 800, 1_000_000) == slices
