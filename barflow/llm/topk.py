"""Exact top-k inner products by the threshold algorithm over sorted lists, one for each dimension.

Vectors become whole numbers, floor(scale * x). Candidates are dealt evenly into blocks, queries
into blocks of their own, and every block of queries meets every block of candidates once, as one
group of two rows. There each dimension has its list of candidates in order of their component.
For a query the lists are walked from the end that its sign favours, some depth at a time; each
candidate met for the first time gets its full score. No candidate still unseen can score more
than the sum over dimensions of the query's component times the last component seen there, and
once the k-th best score is above that bound the walk stops. A tie with the bound goes on, so
equal scores are decided by vec_id. What remains is k rows for each query and block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import stored

BLOCK = 8192
QUERIES = 1024
#: Depth of the first step down the lists; each step is as deep as all before it together.
STEP = 32
#: Whole numbers up to this are exact as doubles.
EXACT = float(1 << 53)

BLOCK_ROW = "part int, ids binary, vectors binary, width int"
FOUND = "query_id long, vec_id long, score long"


def whole(embedding: Column, scale: float) -> Column:
    """floor(scale * x) for each component."""
    return F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(embedding: Column) -> Column:
    """Neither NULL nor with a component that is NULL or not finite."""
    return embedding.isNotNull() & F.coalesce(
        F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                 & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))


def blocks(vectors: DataFrame, total: int, size: int) -> tuple[DataFrame, int]:
    """One row for each block of about ``size`` vectors, and the number of blocks."""
    count = max(1, -(-total // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists = [], []
        for batch in batches:
            ids += batch["vec_id"].to_pylist()
            lists += batch["vector"].to_pylist()
        if ids:
            width = max(map(len, lists))
            matrix = np.zeros((len(ids), width), np.int64)
            for row, values in zip(matrix, lists):
                row[:len(values)] = values
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()),
                 pa.array([np.array(ids, np.int64).tobytes()]), pa.array([matrix.tobytes()]),
                 pa.array([width], pa.int32())], ["part", "ids", "vectors", "width"])

    return vectors.repartition(count).mapInArrow(run, BLOCK_ROW), count


def threshold_search(
    ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the (ids, scores) of its k best vectors, without the one whose id is its own."""
    n, width = vectors.shape
    order = np.argsort(vectors, axis=0, kind="stable")
    ranked = np.take_along_axis(vectors, order, axis=0)
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, width)
    kind = np.float64 if largest < EXACT else np.int64
    values, asked, ranked = vectors.astype(kind), queries.astype(kind), ranked.astype(kind)
    found = []
    for query, me in zip(asked, own):
        used = np.flatnonzero(query)
        up = query[used] < 0
        seen = ids == me
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, kind)
        depth, step = 0, STEP
        while True:
            end = min(n, depth + step)
            here = np.where(up, np.arange(depth, end)[:, None], n - 1 - np.arange(depth, end)[:, None])
            new = np.zeros(n, bool)
            new[order[here, used].ravel()] = True
            if not len(used) or end == n:
                new[:] = True  # the lists are at their end
            new &= ~seen
            seen |= new
            at = np.flatnonzero(new)
            scores = np.concatenate([best, values[at] @ query])
            names = np.concatenate([best_ids, ids[at]])
            if len(scores) > 4 * k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                names, scores = names[scores >= kth], scores[scores >= kth]
            first = np.lexsort((names, -scores))[:k]
            best_ids, best = names[first], scores[first]
            depth, step = end, end
            if seen.all():
                break
            bound = ranked[np.where(up, depth - 1, n - depth), used] @ query[used]
            if len(best) == k and best[-1] > bound:
                break
        found.append((best_ids, best.astype(np.int64)))
    return found


def _meet(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(queries):
            width = max(candidates["width"][0], queries["width"][0])
            sides = []
            for side in (candidates, queries):
                names = np.frombuffer(side["ids"][0], np.int64)
                matrix = np.frombuffer(side["vectors"][0], np.int64).reshape(len(names), -1)
                sides.append((names, np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))))
            (ids, vectors), (own, asked) = sides
            for me, (names, scores) in zip(own, threshold_search(ids, vectors, asked, own, k)):
                out.append(pd.DataFrame({"query_id": me, "vec_id": names, "score": scores}))
        empty = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
        return pd.concat([empty, *out])

    return run


def search(
    embeddings: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
    block: int = BLOCK, query_block: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query, smaller ids first.

    ``embeddings`` has vec_id and embedding; ``is_query`` picks the queries by vec_id. Rows
    without a vec_id, and vectors that are NULL or hold a NULL or a number that is not finite,
    take no part. Of rows with the same vec_id the smallest vector counts. Shorter vectors are
    filled up with zeros. Fewer than k others: all of them; an empty table: no rows. Scores are
    exact while they fit a long.
    """
    vector = whole(F.col("embedding"), scale)
    vectors = stored(
        embeddings.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    total, asked = vectors.select(F.count("*"), F.count_if(is_query)).first()
    candidates, n = blocks(vectors, total, block)
    queries, m = blocks(vectors.filter(is_query), asked, query_block)
    left = candidates.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    right = queries.withColumnRenamed("part", "asked").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    best = left.groupBy("part", "asked").cogroup(right.groupBy("part", "asked")).applyInPandas(_meet(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
