"""The pipeline and the register of queries."""

import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from barflow.llm import decontaminate, near_dup, quality, secret_scan
from barflow.llm.tokens import END

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and "pipeline" not in contract.oracle_sql()


@pytest.fixture(scope="module")
def stages(spark, docs):
    """What each stage returns."""
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SMALL).cache())
    return out


def test_stages_keep_the_columns(stages, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "secrets", "packing"]
    for frame in stages[:-1]:
        assert frame.columns == docs.columns


def test_each_stage_decides_on_what_the_one_before_kept(spark, stages):
    raw, good, single, clean, hidden, packed = stages
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    ids = [{r["doc_id"] for r in frame.select("doc_id").collect()} for frame in stages]
    assert ids[1] == {r["doc_id"] for r in quality.score(raw, labels).filter("predicted = 1").collect()} < ids[0]
    assert ids[2] == {r["doc_id"] for r in near_dup.groups(good, 5).filter("kept").collect()} <= ids[1]
    leaks = {r["doc_id"] for r in decontaminate.find(single, benchmark).collect()}
    assert ids[3] == ids[2] - leaks and ids[4] == ids[3] == ids[5]
    secret = {r["doc_id"] for r in secret_scan.find(clean).filter("spans <> ''").collect()}
    changed = {r["doc_id"] for r in hidden.exceptAll(clean).collect()}
    assert changed == secret


def test_the_end_holds_the_ids_of_what_is_left(spark, stages, library):
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    whole: dict[int, int] = {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [END]
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert set(whole) == set(texts)


def test_stages_take_messy_and_empty_tables(spark, messy, nothing):
    columns = ["doc_id", "text", "lang", "source", "n_chars", "label"]
    for frame in (messy, nothing):
        now = frame.select(columns)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SMALL)
            assert now.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, SMALL).count() >= now.count()
