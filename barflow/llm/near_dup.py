"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification.

Texts with equal sets of word shingles are one class, whose node is its smallest doc_id; from here
on a thousand copies are one row. Signatures of ``BANDS * ROWS`` minima give ``BANDS`` keys, and
nodes that share a key are in one bucket. At the similarity asked for (0.8) two nodes share none of
32 keys of five rows with a probability of 3e-6.

A candidate pair is compared signature batch by signature batch. After each batch the posterior of
its similarity (uniform prior) tells how likely it is still to reach the threshold; below ``MISS``
the pair is dropped. Survivors are verified on their full sets.

Pairs are not made of whole buckets. First every node is compared with the smallest of each of its
buckets; verified links already join most of a group of near copies. Only pairs of nodes that are
then still in different components matter. Buckets are cut into blocks, and two blocks are
compared as arrays within a task, each pair in the first of its common buckets alone. A first pass
returns the nodes that have a likely partner there, a second one has their full sets and returns
links, of which it leaves out those between components that it has joined before. So no component
of candidates is lost, and no list of a bucket's pairs is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import pieces, scratch, shuffle_partitions, stored
from barflow.llm.components import components
from barflow.llm.words import NOT_SPACE, U, mix, words
from barflow.operators.numbering import numbered

#: Words of a shingle, the least similarity in hundredths, and the shape of signatures.
WORDS, LEAST = 4, 80
BANDS, ROWS = 32, 5
#: Minima compared at a time, and how unlikely a pair must be to be dropped.
BATCH, MISS = 32, 1e-6
#: Nodes of a block of a large bucket.
BLOCK = 2048
#: Bytes of full sets that the nodes of a block have on average, at most.
BLOCK_BYTES = 64 << 20
#: Up to so many nodes (numbers of 8 bytes) are broadcast to find their texts; more are joined.
BROADCAST_ROWS = 500_000
#: Parts of a bucket in a join without broadcast.
SALT = 16
#: What a writer of wide rows holds before it writes them.
GROUP_BYTES = 8 << 20

_STEPS = mix(np.arange(1, 1025, dtype=U) * U(0xD6E8FEB86659FD93)) | U(1)
SIGNED = "doc_id long, n_shingles long, set1 long, set2 long, keys array<long>, signature binary"


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, sorted; offsets by text).

    With fewer than k words the whole sequence is the one shingle; without words there is none.
    """
    text = words(column, NOT_SPACE)
    first, n = text.first, np.diff(text.first)
    out: list[np.ndarray] = []
    size = np.zeros(len(n), np.int64)
    if len(text.hash) >= k:
        every = np.zeros(len(text.hash) - k + 1, U)
        for j in range(k):
            every += text.hash[j:len(text.hash) - k + 1 + j] * _STEPS[j]
        every = mix(every + U(k))
    for i in np.flatnonzero(n):
        if n[i] >= k:
            found = every[first[i]:first[i + 1] - k + 1]
        else:
            some = text.hash[first[i]:first[i + 1]]
            found = mix((some * _STEPS[:n[i]]).sum(keepdims=True) + U(n[i]))
        found.sort()
        found = found[np.append(True, found[1:] != found[:-1])]
        size[i] = len(found)
        out.append(found)
    return np.concatenate([np.zeros(0, U), *out]), np.concatenate([[0], np.cumsum(size)])


@cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = mix(np.arange(2 * n, dtype=U) + U(0x632BE59BD9B4E019)) >> U(32)
    return both[:n].astype(np.uint32) | np.uint32(1), both[n:].astype(np.uint32)


def signatures(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """n minima of each set; ``starts`` are where the sets (none empty) begin."""
    factor, shift = _permutations(n)
    low = (hashes >> U(32)).astype(np.uint32)
    out = np.empty((len(starts), n), np.uint32)
    if len(starts):
        for j in range(n):
            out[:, j] = np.minimum.reduceat(low * factor[j] + shift[j], starts)
    return out


def sign(documents: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """Size, fingerprint, band keys and one byte of each minimum of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hashes, ends = shingle_sets(batch["text"], k)
            size = np.diff(ends)
            full = np.flatnonzero(size)
            starts = ends[:-1][full]
            minima = signatures(hashes, starts, bands * rows)
            wide = minima.astype(U).reshape(-1, bands, rows)
            keys = mix((wide * _STEPS[:rows]).sum(axis=2, dtype=U) + _STEPS[:bands])
            marks = [np.zeros(len(size), U) for _ in range(2)]
            if len(full):
                marks[0][full] = np.add.reduceat(mix(hashes + U(1)), starts)
                marks[1][full] = np.add.reduceat(mix(hashes ^ U(0x9FB21C651E98DF25)), starts)
            bounds = np.concatenate([[0], np.cumsum(size > 0)]) * bands
            held = iter((minima & np.uint32(255)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].cast("int64"), pa.array(size), *[pa.array(m.view(np.int64)) for m in marks],
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(keys.reshape(-1).view(np.int64))),
                pa.array([next(held).tobytes() if s else None for s in size], pa.binary()),
            ], [f.split()[0] for f in SIGNED.split(", ")])
            pa.default_memory_pool().release_unused()

    return documents.select("doc_id", "text").mapInArrow(run, SIGNED)


@cache
def least_matches(total: int, batch: int, least: int, miss: float) -> tuple[tuple[int, int], ...]:
    """(minima compared, fewest that must agree) after each batch.

    A minimum's byte agrees with probability s + (1 - s) / 256 at similarity s. With m of n equal
    and a uniform prior the posterior of at least t is the binomial sum up to m of n + 1 draws at t.
    """
    t = least / 100 + (1 - least / 100) / 256
    out = []
    for n in range(batch, total + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return tuple(out)


def likely(left: np.ndarray, right: np.ndarray, least: int, miss: float = MISS) -> np.ndarray:
    """Indexes of the pairs of signature rows that the posterior keeps, batch after batch."""
    kept, equal, begin = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, fewest in least_matches(left.shape[1], BATCH, least, miss) if len(left) else ():
        equal = equal + (left[kept, begin:n] == right[kept, begin:n]).sum(axis=1)
        kept, equal = kept[equal >= fewest], equal[equal >= fewest]
        begin = n
    return kept


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    """Binary values of equal length as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def prune(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) that their signatures leave likely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                kept = likely(_rows(batch["left"], np.uint8), _rows(batch["right"], np.uint8), least)
                yield batch.select(["a", "b"]).take(pa.array(kept))

    return (
        pairs.join(nodes.select(F.col("node").alias("b"), F.col("signature").alias("right")), "b")
        .join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("left")), "a")
        .select("a", "b", "left", "right").mapInArrow(run, "a long, b long")
    )


def _sets_of(needed: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """(node, hashes) of the nodes in the column ``doc_id`` of ``needed``, from their whole texts."""
    if needed.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hashes, ends = shingle_sets(batch["text"], k)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].cast("int64"),
                pa.array([hashes[b:e].tobytes() for b, e in zip(ends, ends[1:])], pa.binary())], ["node", "hashes"])
            pa.default_memory_pool().release_unused()

    return stored(documents.select("doc_id", "text").join(needed, "doc_id", "left_semi").mapInArrow(
        sets, "node long, hashes binary"), "sets", GROUP_BYTES)


def _alike(x: np.ndarray, y: np.ndarray, least: int) -> bool:
    """Two sorted sets share ``least`` hundredths of their union or more."""
    if 100 * min(len(x), len(y)) < least * max(len(x), len(y)) or not len(x):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= least * (len(x) + len(y) - both)


def verify(pairs: DataFrame, documents: DataFrame, k: int, least: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``pairs`` is read more than once."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    found = _sets_of(needed, documents, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ((np.frombuffer(s.as_buffer(), U) for s in both) for both in zip(batch["left"], batch["right"]))
            yield batch.select(["a", "b"]).filter(pa.array([_alike(*both, least) for both in sets], pa.bool_()))

    return (
        pairs.join(found.select(F.col("node").alias("b"), F.col("hashes").alias("right")), "b")
        .join(found.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
        .select("a", "b", "left", "right").mapInArrow(run, "a long, b long")
    )


GROUP = ["key", "i", "j"]


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each (key, i, j), which stand together but may go on in the next batch."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        names = [batch[c].to_numpy() for c in GROUP]
        new = np.any([c[1:] != c[:-1] for c in names], axis=0)
        edges = [0, *(np.flatnonzero(new) + 1).tolist()]
        for begin, end in zip(edges, edges[1:]):
            yield batch.slice(begin, end - begin)
        rest = batch.slice(edges[-1])
    if rest is not None:
        yield rest


def _open_pairs(rows: pa.RecordBatch, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows) that are likely alike: in different components, and met here first.

    ``rows`` are those of two blocks of one bucket, or of one block with itself.
    """
    block, node, component = (rows[c].to_numpy() for c in ("block", "node", "component"))
    if (component == component[0]).all():
        return
    i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
    keys = rows["keys"].flatten().to_numpy().reshape(len(rows), -1)
    signature = _rows(rows["signature"], np.uint8)
    band = int(np.argmax(keys[0] == rows["key"][0].as_py()))
    right = np.flatnonzero(block == j)
    for x in np.flatnonzero(block == i):
        y = right[component[right] != component[x]]
        if i == j:
            y = y[node[y] > node[x]]
        if band:
            y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)]
        if len(y):
            y = y[likely(np.broadcast_to(signature[x], (len(y), signature.shape[1])), signature[y], least)]
        if len(y):
            yield int(x), y


def _links_of(rows: pa.RecordBatch, least: int) -> list[tuple[int, int]]:
    """Verified links between the rows, none within what earlier ones have joined."""
    node, component = rows["node"].to_numpy(), rows["component"].to_pylist()
    sets = [np.frombuffer(s.as_buffer(), U) for s in rows["hashes"]]
    above: dict[int, int] = {}

    def top(c: int) -> int:
        while c in above:
            c = above[c]
        return c

    found = []
    for x, others in _open_pairs(rows, least):
        for y in others.tolist():
            a, b = top(component[x]), top(component[y])
            if a != b and _alike(sets[x], sets[y], least):
                above[max(a, b)] = min(a, b)
                found.append((int(min(node[x], node[y])), int(max(node[x], node[y]))))
    return found


def _with_key(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` joined with a stored table that has one row for some keys, however many rows a key has."""
    if keys.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keys), "key")
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    part = F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int")
    return rows.withColumn("salt", part).join(salted, ["key", "salt"]).drop("salt")


def rest_links(
    members: DataFrame, nodes: DataFrame, joined: DataFrame, documents: DataFrame, k: int, least: int
) -> DataFrame:
    """Links between nodes of one bucket that are in different components, enough to join these.

    ``members`` has key, node, the bucket's smallest node (leader), which all others were compared
    with, and its size n. ``nodes`` has the signatures and all band keys.
    """
    spark = members.sparkSession
    labelled = members.filter("n > 2").join(joined, "node", "left").select(
        "key", "node", "leader", "n", F.coalesce("component", "node").alias("component"))
    others = labelled.filter("node <> leader").select("key", "node", "component")
    mixed = stored(others.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key"), "mixed")
    inner = _with_key(others, mixed).join(nodes.select("node", "n_shingles"), "node")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") * 8 / BLOCK_BYTES)).cast("int")
    cut = stored(inner.groupBy("key").agg(blocks.alias("blocks")), "cut")
    place = _with_key(inner, cut).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "node", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    marked = nodes.select("node", "signature", "keys")

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(shuffle_partitions(spark), *GROUP).sortWithinPartitions(*GROUP, "node")

    def likely_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_group(batches):
            some = {x for row, others in _open_pairs(rows, least) for x in (row, *others.tolist())}
            if some:
                yield rows.select(columns).take(pa.array(sorted(some)))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_group(batches):
            if found := _links_of(rows, least):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    columns = [*GROUP, "block", "node", "component"]
    schema = "key long, i int, j int, block int, node long, component long"
    open_ = stored(together(place.join(marked, "node")).mapInArrow(likely_nodes, schema), "open")
    if open_.isEmpty():
        return spark.createDataFrame([], "a long, b long")
    sets = _sets_of(open_.select(F.col("node").alias("doc_id")).distinct(), documents, k)
    return together(open_.join(marked, "node").join(sets, "node")).mapInArrow(links, "a long, b long")


def _sign_all(documents: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    return stored(sign(documents.select("doc_id", "text"), k, bands, rows), "signed", GROUP_BYTES)


def _components(signed: DataFrame, texts: DataFrame, k: int, least: int) -> DataFrame:
    """``signed`` with the component of each row's set; no doc_id has two different sets.

    Of the tables written on the way only the nodes and their components stay.
    """
    with scratch() as keep:
        nodes = keep(stored(
            signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set1", "set2", "n_shingles").agg(
                F.min("doc_id").alias("node"), F.first("keys").alias("keys"), F.first("signature").alias("signature")),
            "nodes", GROUP_BYTES))
        keys = nodes.select(F.explode("keys").alias("key"), "node")
        buckets = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
        members = stored(keys.join(buckets, "key"), "members")
        first = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        links = stored(verify(stored(prune(first, nodes, least), "pairs"), texts, k, least), "verified")
        joined = components(links)
        rest = stored(rest_links(members, nodes, joined, texts, k, least), "links")
        if not rest.isEmpty():
            stars = joined.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            joined = components(rest.unionByName(stars))
        keep(joined)
    whole = signed.select("doc_id", "n_shingles", "set1", "set2").join(
        nodes.select("set1", "set2", "n_shingles", "node"), ["set1", "set2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return whole.join(joined, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"))


def _has_different_texts(signed: DataFrame) -> bool:
    """Does any doc_id stand for several different sets?"""
    spread = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("set1").alias("x"), F.max("set1").alias("y"))
    return not spread.filter("x <> y").isEmpty()


def _told_apart(documents: DataFrame) -> DataFrame:
    """(doc_id, tie, number, text): the different texts of every doc_id, numbered in the order of doc_ids."""
    rows = documents.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    different = rows.groupBy("doc_id", "tie").agg(F.first("text").alias("text"))
    return stored(numbered(different, ["doc_id", "tie"], "number"), "texts")


def _kept(components_: DataFrame) -> DataFrame:
    return components_.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def groups(
    documents: DataFrame, words_in_shingle: int = WORDS, least: int = LEAST, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable), kept (it is its own).

    Words are runs of anything but white space, A-Z lower-cased. Two documents are linked if the
    shared part of their shingle sets is ``least`` hundredths of their union or more. NULL and empty
    texts have no shingles and no links: they are their own component. Rows without a doc_id
    are never linked; their component is NULL and ``kept`` is true. Rows with the same doc_id are
    one document, whatever their texts: it is linked with what any of them is linked with, and each row
    returns its own n_shingles. An empty table gives an empty result; other columns play no part.
    """
    k, texts = words_in_shingle, documents.select("doc_id", "text")
    signed = _sign_all(texts, k, bands, rows)
    if not _has_different_texts(signed):
        return _kept(_components(signed, texts, k, least))
    told = _told_apart(texts)
    apart = told.select(F.col("number").alias("doc_id"), "text")
    by_number = stored(_components(_sign_all(apart, k, bands, rows), apart, k, least), "by-number")
    own = told.select("doc_id", "tie", "number").join(
        by_number.select(F.col("doc_id").alias("number"), "n_shingles", "component_id"), "number")
    lowest = told.groupBy("doc_id").agg(F.min("number").alias("a"))
    links = stored(
        own.select(F.col("component_id").alias("a"), F.col("number").alias("b")).unionByName(
            told.select("doc_id", F.col("number").alias("b")).join(lowest, "doc_id").select("a", "b")
        ).filter("a <> b"), "links")
    first = components(links).select(F.col("node").alias("number"), F.col("component").alias("first"))
    # Numbers follow doc_ids, so the smallest number of a component has its smallest doc_id.
    smallest = told.select(F.col("number").alias("first"), F.col("doc_id").alias("component_id"))
    found = own.drop("component_id").join(first, "number", "left").withColumn("first", F.coalesce("first", "number")).join(
        smallest, "first").select(F.col("doc_id").alias("of"), F.col("tie").alias("mark"), "n_shingles", "component_id")
    marked = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"))
    with_id = marked.join(found, (F.col("doc_id") == F.col("of")) & (F.col("tie") == F.col("mark"))).select(
        "doc_id", "n_shingles", "component_id")
    without = signed.filter("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return _kept(with_id.unionByName(without))


def _one_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that are equal in their keys the smallest, all columns kept; rows of a NULL doc_id all stay."""
    known = rows.filter("doc_id IS NOT NULL")
    again = stored(known.groupBy(*keys).count().filter("count > 1").select(*keys), "again")
    if again.isEmpty():
        return rows
    several = known.join(again, keys, "left_semi").select(rows.columns)
    one = several.groupBy(*keys).agg(F.min(F.struct(*rows.columns)).alias("row")).select("row.*")
    return rows.join(again, keys, "left_anti").select(rows.columns).unionByName(one)


def keep_one(documents: DataFrame, words_in_shingle: int = 5, least: int = LEAST) -> DataFrame:
    """One row of ``documents``, unchanged, of each group of near duplicates: the one of the smallest doc_id.

    Texts decide, not doc_ids: different texts of one doc_id stay unless they are near duplicates of each
    other or of an earlier document's, and a text that has no near duplicate never goes. Of rows equal in
    doc_id and text the smallest stays. Rows without a doc_id all stay. An empty table gives no rows.
    """
    columns = documents.columns
    with scratch() as keep:
        signed = _sign_all(documents, words_in_shingle, BANDS, ROWS)
        several = _has_different_texts(signed)
        if not several:
            found = _kept(_components(signed, documents.select("doc_id", "text"), words_in_shingle, least))
            gone = keep(stored(found.filter("NOT kept").select("doc_id").distinct(), "gone"))
        else:
            told = _told_apart(documents)
            apart = told.select(F.col("number").alias("doc_id"), "text")
            found = _kept(_components(_sign_all(apart, words_in_shingle, BANDS, ROWS), apart, words_in_shingle, least))
            kept = keep(stored(found.filter("kept").select(F.col("doc_id").alias("number")).join(told, "number").select(
                F.col("doc_id").alias("of"), F.col("tie").alias("mark")), "kept"))
    if not several:
        if gone.count() <= BROADCAST_ROWS:
            gone = F.broadcast(gone)
        return _one_of_each(documents.join(gone, "doc_id", "left_anti").select(columns), ["doc_id"])
    mark = "_text_mark"
    marked = documents.withColumn(mark, F.xxhash64("text"))
    stays = marked.join(kept, (F.col("doc_id") == F.col("of")) & (F.col(mark) == F.col("mark")), "left_semi")
    one = _one_of_each(stays, ["doc_id", mark]).select(columns)
    return one.unionByName(documents.filter("doc_id IS NULL"))
