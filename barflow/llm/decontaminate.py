"""Benchmark decontamination by latent semantic retrieval, then word order and answer checks.

Features are the words of the benchmark. Their document frequencies are counted over all documents;
words of more than half of them weigh little, never nothing. Passages of ``PASSAGE`` words, with the benchmark's
own items, make a TF-IDF matrix A; a randomised SVD takes a random matrix W with ``RANK``
columns, sums A' A W over all passages (each task its own, then block by block) and makes it
orthonormal: the latent space. In the corpus' passages words below the weight ``RARE`` are left
out, or they would take all of the few dimensions; the items keep theirs.

Every document is then read in overlapping windows about as long as the items. A window is a
candidate for an item if its cosine with the item in the latent space is ``COSINE`` or more. The
cosine is only taken where the words around the window hold so many of the item's (``PART``, counted
by blocks of ``STEP`` words) that the check below could accept it; it leaves out nothing else. Where
they hold ``VERBATIM`` of them the window is a candidate at any cosine, for the words of an item that
is all over the corpus weigh less than those beside it. A candidate is checked against the words around it: the longest common subsequence with the
item, and with the item's answer, its last sentence; words of more than half of all documents are
left out of both (unless the item has few others). It is a leak if most of the item is there in
order (``VERBATIM``), or if half is and nearly all of the answer (a paraphrase).

Which windows hold enough of an item's words is told in two ways with the same result. An item of n
checked words that needs h of them has t of its n - h + t rarest in every such window. Where these
are rare in a piece of text their places are looked up, and the other words are counted only around
t of them close together: such an item costs what its rare words occur. Items of words that are
frequent in the piece (more than one place in ``PLACES`` blocks) are counted block by block.

Characters of scripts without spaces (Han, kana, Thai and others) are words of their own. Items of
fewer than ``LEAST_WORDS`` words are searched for exactly, as a sequence of words, in the same pass.

What goes to the driver and to the tasks is bounded by the benchmark, the stated query set, of
which ``ITEMS`` items at a time are searched for.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import pieces, shuffle_partitions
from barflow.llm.words import ALPHANUMERIC, U, Vocabulary, Words, mix, words

PASSAGE, RANK, ITEMS = 32, 64, 10_000
#: Windows in words and their step; items with fewer words than LEAST_WORDS are searched for exactly.
WINDOWS, STEP, LEAST_WORDS = (16, 32, 48, 64, 128, 256), 8, 5
#: Words in more than one of e**2 documents are common; those below COMMON are in more than half of all,
#: and none weighs less than FLOOR.
RARE, COMMON, FLOOR = 2.0, np.log(2), 0.05
#: Least latent cosine.
COSINE = 0.5
#: Share of the item's words in order for a leak; the same and the answer's for a paraphrase.
VERBATIM, PART, ANSWER = 0.7, 0.5, 0.8
#: Features in a row when partial sums are added; items and windows whose words are counted at once.
BLOCK = 256
GROUP, AT_ONCE = 256, 8192
#: Blocks that are counted in the time that a place of a rare word is looked up; places held at once.
PLACES, HELD = 16, 1 << 20
_SENTENCE = re.compile(r"[.!?]\s+|[\u3002\uff01\uff1f\uff61]\s*")
_UNSPACED = "\u0e00-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\uff00-\uffef\U0001b000-\U0001b16f\U00020000-\U0003ffff"
_UNIT = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")


class Group(NamedTuple):
    """Items with the same windows; words beside their item's place in ``items``."""

    size: int
    pad: int  # words around a window that are checked with it
    items: np.ndarray
    need: np.ndarray  # checked words of each item
    wanted: np.ndarray  # these words, once each
    of_wanted: np.ndarray
    rarest: np.ndarray  # the rarest of them, once each
    of_rarest: np.ndarray
    least: np.ndarray  # how many places of its rarest words each item needs


class Query(NamedTuple):
    """The items and all that is known about their words."""

    item_ids: list[int]
    vocabulary: Vocabulary
    item_words: list[np.ndarray]  # numbers of the vocabulary
    answers: list[np.ndarray]
    weights: np.ndarray  # inverse document frequencies
    latent: np.ndarray  # row of the latent space for each word, weight included
    directions: np.ndarray  # of the items, of length 1
    short: dict[int, tuple[Vocabulary, list[list[int]]]]  # by words: their sequences, item_ids of each
    groups: list[Group] = []


def _answer(text: str) -> str:
    """The last sentence; the last quarter of the words if there is but one."""
    parts = [s for s in _SENTENCE.split(text.strip()) if s.strip()]
    if len(parts) > 1:
        return parts[-1]
    some = _UNIT.findall(text)
    return " ".join(some[-max(1, len(some) // 4):])


def _words(column: pa.Array) -> Words:
    return words(column, ALPHANUMERIC, cut=True)


def _sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each sequence of n words."""
    out = hashes[:len(hashes) - n + 1]
    for i in range(1, n):
        out = mix(out * U(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - n + 1 + i])
    return out


def _short(item_ids: list[int], texts: list[str]) -> dict[int, tuple[Vocabulary, list[list[int]]]]:
    text = _words(pa.array(texts, pa.string()))
    held: dict[int, list[tuple[int, int]]] = {}
    for item_id, a, b in zip(item_ids, text.first, text.first[1:]):
        held.setdefault(int(b - a), []).append((item_id, _sequences(text.hash[a:b], int(b - a))[0]))
    out = {}
    for n, some in held.items():
        known = Vocabulary(np.array([h for _, h in some], U))
        ids: list[list[int]] = [[] for _ in range(len(known))]
        for (item_id, _), number in zip(some, known.numbers(np.array([h for _, h in some], U))):
            ids[number].append(item_id)
        out[n] = known, ids
    return out


def short_leaks(query: Query, text: Words) -> set[tuple[int, int]]:
    """(document, item_id) of every short item."""
    found = set()
    for n, (known, ids) in query.short.items():
        if len(text.hash) < n:
            continue
        numbers = known.numbers(_sequences(text.hash, n))
        at = np.flatnonzero(numbers >= 0)
        document = np.searchsorted(text.first, at, side="right") - 1
        within = at + n <= text.first[document + 1]
        pairs = np.unique(np.stack([document[within], numbers[at[within]]], axis=1), axis=0)
        found.update((d, item_id) for d, number in pairs.tolist() for item_id in ids[number])
    return found


def _of(text: Words, vocabulary: Vocabulary) -> list[np.ndarray]:
    numbers = vocabulary.numbers(text.hash)
    return [numbers[a:b] for a, b in zip(text.first, text.first[1:])]


def _passages(text: Words, numbers: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words with weight, where their passages begin among them)."""
    n = np.diff(text.first)
    count = -(-n // PASSAGE)
    own = np.repeat(np.cumsum(count) - count, n) + (np.arange(len(numbers)) - np.repeat(text.first[:-1], n)) // PASSAGE
    kept = np.flatnonzero((numbers >= 0) & (weights[numbers] > 0))
    own = own[kept]
    return numbers[kept], np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(kept) else kept


def _add(total: np.ndarray, numbers: np.ndarray, starts: np.ndarray, start_space: np.ndarray) -> None:
    """Add a' (a W) of each passage; ``start_space`` is W with the weights of the words."""
    if not len(numbers):
        return
    sums = np.add.reduceat(start_space[numbers], starts, axis=0)
    order = np.argsort(numbers.astype(np.uint16) if len(total) <= 1 << 16 else numbers, kind="stable")
    ordered = numbers[order]
    begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    passage = np.searchsorted(starts, order, side="right") - 1
    total[ordered[begin]] += np.add.reduceat(sums[passage], begin, axis=0)


def _frequencies(documents: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many documents each word of the vocabulary stands, and how many documents there are."""
    size = len(vocabulary)
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, np.int64)
        for batch in pieces(batches):
            text = _words(batch["text"])
            numbers = sent.value.numbers(text.hash)
            of = np.repeat(np.arange(len(batch)), np.diff(text.first))
            known = np.flatnonzero(numbers >= 0)
            pairs = np.unique(of[known] * size + numbers[known])
            counts[:size] += np.bincount(pairs % size, minlength=size)
            counts[size] += len(batch)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], ["word", "n"])

    out = np.zeros(size + 1, np.int64)
    found = documents.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    for word, n in found.collect():  # a row for each word of the benchmark at most
        out[word] = n
    return out[:size], int(out[size])


def _range_sum(
    documents: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, space: np.ndarray
) -> tuple[np.ndarray, float]:
    """The sum of a' (a W) over all passages of all documents, and how many words took part."""
    spark, (size, rank) = documents.sparkSession, space.shape
    sent = spark.sparkContext.broadcast((vocabulary, weights, space))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight, start = sent.value
        total, count = np.zeros((size, rank), np.float64), 0
        for batch in pieces(batches):
            text = _words(batch["text"])
            numbers, starts = _passages(text, known.numbers(text.hash), weight)
            _add(total, numbers, starts, start)
            count += len(numbers)
        if count:
            blocks = range(0, size, BLOCK)
            yield pa.RecordBatch.from_arrays([
                pa.array([-1, *blocks], pa.int64()),
                pa.array([np.array([count], float).tobytes(), *[total[b:b + BLOCK].tobytes() for b in blocks]])],
                ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["sums"]):
                values = np.frombuffer(data.as_buffer(), float)
                sums[block] = sums[block] + values if block in sums else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            ["block", "sums"])

    kind = "block long, sums binary"
    parts = documents.select("text").mapInArrow(part, kind).repartition(shuffle_partitions(spark), "block")
    out, count = np.zeros((size, rank)), 0.0
    for block, data in parts.mapInArrow(add, kind).collect():  # the size of the latent space
        values = np.frombuffer(data, float)
        if block < 0:
            count = values[0]
        else:
            out[block:block + BLOCK] = values.reshape(-1, rank)
    return out, count


def fit(documents: DataFrame, item_ids: list[int], texts: list[str], rank: int = RANK) -> Query:
    long = np.diff(_words(pa.array(texts, pa.string())).first) >= LEAST_WORDS
    short = _short(*([x for x, is_long in zip(some, long) if not is_long] for some in (item_ids, texts)))
    item_ids, texts = ([x for x, is_long in zip(some, long) if is_long] for some in (item_ids, texts))
    if not texts:
        none = np.zeros((0, 1), np.float32)
        return Query([], Vocabulary(np.zeros(0, U)), [], [], none[:, 0], none, none, short)
    items = _words(pa.array(texts, pa.string()))
    vocabulary = Vocabulary(items.hash)
    frequency, n = _frequencies(documents, vocabulary)
    weights = np.maximum(FLOOR, np.log((n + 1) / (frequency + 0.5)))
    rank = min(rank, len(vocabulary))
    start = (np.random.default_rng(7).standard_normal((len(vocabulary), rank)) * weights[:, None]).astype(np.float32)
    total, count = _range_sum(documents, vocabulary, np.where(weights > RARE, weights, 0), start)
    # The items weigh as much as all passages together.
    of_items = _of(items, vocabulary)
    own, (numbers, starts) = np.zeros_like(total), _passages(items, np.concatenate(of_items), weights)
    _add(own, numbers, starts, start)
    total += own * max(1.0, count / max(1, len(numbers)))
    basis, _ = np.linalg.qr(total * weights[:, None])
    latent = (basis * weights[:, None]).astype(np.float32)
    directions = np.stack([latent[w].sum(axis=0) for w in of_items])
    directions /= np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-9)
    answers = _of(_words(pa.array([_answer(t) for t in texts], pa.string())), vocabulary)
    query = Query(item_ids, vocabulary, of_items, answers, weights, latent, directions, short)
    return query._replace(groups=list(_groups(query)))


def common_length(text: list[int], item: list[int]) -> int:
    """Length of the longest common subsequence, a machine word of the item at a time."""
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    whole = (1 << len(item)) - 1
    row = whole
    for word in text:
        hit = row & places.get(word, 0)
        row = (row + hit | row - hit) & whole
    return len(item) - row.bit_count()


def _window_of(lengths: np.ndarray) -> np.ndarray:
    """The window size that is nearest to each item's length."""
    sizes = np.array(WINDOWS)
    return sizes[np.abs(np.log(lengths[:, None] / sizes)).argmin(axis=1)]


def _checked(query: Query, item: int) -> tuple[list[int], list[int], bool]:
    """The words of an item and its answer to be found in order, and whether common ones are among them."""
    every, answer = query.item_words[item], query.answers[item]
    rare = every[query.weights[every] >= COMMON]
    if len(rare) < LEAST_WORDS:
        return every.tolist(), answer.tolist(), True
    return rare.tolist(), answer[query.weights[answer] >= COMMON].tolist(), False


def _groups(query: Query) -> Iterator[Group]:
    lengths = np.array([len(w) for w in query.item_words])
    of_item = _window_of(np.maximum(1, lengths))
    for size in sorted(set(of_item.tolist())):
        every = np.flatnonzero(of_item == size)
        for items in (every[at:at + GROUP] for at in range(0, len(every), GROUP)):
            need, least, wanted, rarest = [], [], [], []
            for item in items:
                checked = np.array(_checked(query, item)[0], np.int64)
                enough = max(1, int(np.ceil(PART * len(checked))))
                places = min(enough, max(3, enough // 4))
                by_rarity = checked[np.argsort(-query.weights[checked], kind="stable")]
                need.append(len(checked))
                least.append(places)
                wanted.append(np.unique(checked))
                rarest.append(np.unique(by_rarity[:len(checked) - enough + places]))
            columns = np.arange(len(items))
            yield Group(
                size, STEP + max(0, int(lengths[items].max()) - size), items, np.array(need, float),
                np.concatenate(wanted), np.repeat(columns, [len(w) for w in wanted]),
                np.concatenate(rarest), np.repeat(columns, [len(w) for w in rarest]), np.array(least))


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... , count[i] numbers each."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Places:
    """Where each word of the vocabulary stands in a piece of text."""

    def __init__(self, blocks: np.ndarray, size: int) -> None:
        flat = blocks.reshape(-1)
        known = np.flatnonzero(flat >= 0)
        self.at = known[np.argsort(flat[known], kind="stable")]
        self.count = np.bincount(flat[known], minlength=size)
        self.begin = np.cumsum(self.count) - self.count


def _around_rare(
    group: Group, columns: np.ndarray, places: Places, blocks: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``_near`` says of the items ``columns``, from the places of their rarest words, some items at a time.

    Windows are in the order of the text: neither ``low`` nor ``high`` falls.
    """
    hits = np.bincount(group.of_rarest, places.count[group.rarest], len(group.items)).astype(np.int64)
    columns = columns[hits[columns] >= group.least[columns]]
    member = np.zeros(len(places.count) + 1, bool)  # the last is for words of no item
    widest = int((high - low).max(initial=0))
    parts = (np.cumsum(hits[columns]) - hits[columns]) // HELD
    for part in np.unique(parts):
        here = np.zeros(len(group.items), bool)
        here[columns[parts == part]] = True
        some = np.flatnonzero(here[group.of_rarest])
        count = places.count[group.rarest[some]]
        at = places.at[_spread(places.begin[group.rarest[some]], count)]
        column = np.repeat(group.of_rarest[some], count)
        # In blocks; between two items lies more than any window's width.
        short = len(group.items) * (len(blocks) + widest) < 1 << 31
        place = np.sort((column * (len(blocks) + widest) + at // STEP).astype(np.int32 if short else np.int64))
        # A place and the last of as many as the item needs: the windows that hold both.
        last = np.arange(len(place)) + np.repeat(group.least[here] - 1, hits[here])
        first = np.flatnonzero(last < len(place))
        first = first[place[last[first]] - place[first] < widest]
        column, begin = np.divmod(place[first], len(blocks) + widest)
        end = np.searchsorted(low, begin, side="right")
        begin = np.searchsorted(high, place[last[first]] - place[first] + begin, side="right")
        # Windows that an earlier place of the item has given already.
        begin[1:] = np.where(column[1:] == column[:-1], np.maximum(begin[1:], end[:-1]), begin[1:])
        held = np.flatnonzero(begin < end)
        window = _spread(begin[held], (end - begin)[held])
        column = np.repeat(column[held], (end - begin)[held])
        cuts = np.flatnonzero(np.append(True, column[1:] != column[:-1])) if len(column) else column
        own = np.searchsorted(group.of_wanted, np.arange(len(group.items) + 1))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b in zip(cuts, np.append(cuts[1:], len(column))):
            item = column[a]
            words_ = group.wanted[own[item]:own[item + 1]]
            member[words_] = True
            for rows in (window[c:min(b, c + AT_ONCE)] for c in range(a, b, AT_ONCE)):
                # Running sums over the blocks of the windows, without what lies between them.
                new = np.maximum(low[rows], np.maximum.accumulate(np.append(0, high[rows[:-1]])))
                used = _spread(new, np.maximum(0, high[rows] - new))
                sums = np.append(0, np.cumsum(np.count_nonzero(member[blocks[used]], axis=1)))
                told = sums[np.searchsorted(used, high[rows])] - sums[np.searchsorted(used, low[rows])]
                enough = np.flatnonzero(told >= np.ceil(PART * group.need[item]))
                found.append((rows[enough], np.full(len(enough), item), told[enough]))
                if sum(len(f[0]) for f in found) >= AT_ONCE:
                    yield tuple(map(np.concatenate, zip(*found)))
                    found = []
            member[words_] = False
        if any(len(f[0]) for f in found):
            yield tuple(map(np.concatenate, zip(*found)))


def _counted(
    group: Group, columns: np.ndarray, size: int, blocks: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same for the items ``columns`` by counts in every block, some windows at a time."""
    place = np.full(len(group.items), -1)
    place[columns] = np.arange(len(columns))
    own = np.flatnonzero(place[group.of_wanted] >= 0)
    counted = np.zeros((size + 1, len(columns)), np.uint8)  # the last row is for words of no item
    counted[group.wanted[own], place[group.of_wanted[own]]] = 1
    for at in range(0, len(low), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        row, column, held = _near(counted, blocks, low[some], high[some], PART * group.need[columns])
        if len(row):
            yield row + at, columns[column], held


def _near(
    counted: np.ndarray, blocks: np.ndarray, low: np.ndarray, high: np.ndarray, need: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, item, words) where blocks ``low`` to ``high`` hold as many of the item's words as it needs.

    ``counted`` has the items that a word counts for. Running sums are in the shortest numbers that hold any
    of their differences; the sums themselves may wrap around.
    """
    base, size = int(low.min()), int(high.max())
    least = np.ceil(need).astype(np.int64)
    most = max(blocks.shape[1] * int((high - low).max()), int(least.max(initial=0)))
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int32
    sums = np.zeros((size - base, counted.shape[1]), np.uint8)
    for words_ in blocks[base:size].T:
        sums += counted[words_]
    whole = np.zeros((size - base + 1, counted.shape[1]), kind)
    np.cumsum(sums, axis=0, dtype=kind, out=whole[1:])
    held = whole[high - base] - whole[low - base]
    row, column = np.nonzero(held >= least.astype(kind))
    return row, column, held[row, column].astype(np.int64)


def candidates(query: Query, text: Words) -> Iterator[tuple[int, int, int, int, float]]:
    """(document, item, first word, end, cosine) of all candidate windows."""
    if not query.item_ids:
        return
    numbers = query.vocabulary.numbers(text.hash)
    n = np.diff(text.first)
    count = -(-n // STEP)
    first_block = np.cumsum(count) - count
    blocks = np.full((count.sum(), STEP), -1, np.int32)
    blocks.reshape(-1)[np.arange(len(numbers)) + np.repeat(first_block * STEP - text.first[:-1], n)] = numbers
    places = Places(blocks, len(query.vocabulary))
    size = 0
    for group in query.groups:
        if group.size != size:  # groups are in the order of sizes
            size = group.size
            count = np.where(n > 0, 1 + np.maximum(0, -(-(n - size) // STEP)), 0)
            document = np.repeat(np.arange(len(n)), count)
            begin = (np.arange(len(document)) - np.repeat(np.cumsum(count) - count, count)) * STEP
            begin = np.minimum(begin, np.maximum(0, n[document] - size))
            end = np.minimum(begin + size, n[document])
        low = first_block[document] + np.maximum(0, begin - group.pad) // STEP
        high = first_block[document] - (-np.minimum(end + group.pad, n[document]) // STEP)
        hits = np.bincount(group.of_rarest, places.count[group.rarest], len(group.items))
        rare = hits * PLACES < len(blocks)
        found: list[Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        if rare.any():
            found.append(_around_rare(group, np.flatnonzero(rare), places, blocks, low, high))
        if len(low) and not rare.all():
            found.append(_counted(group, np.flatnonzero(~rare), len(query.vocabulary), blocks, low, high))
        for row, column, held in chain(*found):
            windows, row = np.unique(row, return_inverse=True)
            begins = text.first[document[windows]] + begin[windows]
            length = end[windows] - begin[windows]
            words_ = numbers[_spread(begins, length)]
            known = np.flatnonzero(words_ >= 0)
            window = np.repeat(np.arange(len(windows)), length)[known]
            starts = np.flatnonzero(np.append(True, window[1:] != window[:-1])) if len(known) else known
            sums = np.zeros((len(windows), query.latent.shape[1]), np.float32)
            if len(known):
                sums[window[starts]] = np.add.reduceat(query.latent[words_[known]], starts, axis=0)
            sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
            cosine = np.einsum("ij,ij->i", sums[row], query.directions[group.items[column]])
            for k in np.flatnonzero((cosine >= COSINE) | (held >= VERBATIM * group.need[column])):
                window = row[k]
                yield (int(document[windows[window]]), int(group.items[column[k]]), int(begins[window]),
                       int(begins[window] + length[window]), float(cosine[k]))


def leaks(query: Query, text: Words) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(cosine, part of the item, part of the answer) of each (document, item), at its best window."""
    numbers = query.vocabulary.numbers(text.hash).tolist()
    first = text.first.tolist()
    checked: dict[int, tuple[list[int], list[int], Counter[int], frozenset[int], int]] = {}
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for document, item, begin, end, cosine in candidates(query, text):
        if item not in checked:
            wanted, answer, _ = _checked(query, item)
            times = Counter(wanted)
            checked[item] = wanted, answer, times, frozenset(times), len(query.item_words[item])
        wanted, answer, times, own, length = checked[item]
        pad = STEP + max(0, length - (end - begin))
        around = numbers[max(first[document], begin - pad):min(first[document + 1], end + pad)]
        # Words that are not the item's are in no common subsequence.
        if sum(map(times.__getitem__, own.intersection(around))) < PART * len(wanted):
            continue
        part = common_length(around, wanted) / len(wanted)
        if part < PART:
            continue
        of_answer = common_length(around, answer) / len(answer) if answer else 0.0
        if part >= VERBATIM or part >= PART and of_answer >= ANSWER:
            best = found.get((document, item), (0.0, 0.0, 0.0))
            found[document, item] = max(best, (cosine, part, of_answer), key=lambda x: (x[1], x[2], x[0]))
    return found


def queries_of(documents: DataFrame, benchmark: DataFrame) -> Iterator[Query]:
    """One for each ``ITEMS`` items. Items without id, text or any word are left out."""
    rows = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text").collect()
    count = np.diff(_words(pa.array([r[1] for r in rows], pa.string())).first)
    rows = [r for r, n in zip(rows, count) if n]
    for at in range(0, len(rows), ITEMS):
        some = rows[at:at + ITEMS]
        yield fit(documents, [r[0] for r in some], [r[1] for r in some])


RESULT = "doc_id long, item_id long, cosine double, part double, answer double"


def find(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, part and answer of every leak of an item in a document.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII; characters of
    scripts without spaces stand alone. NULL and empty texts have no leaks. Repeated documents each have their rows, also without a doc_id;
    items that are repeated with the same id and text count once. Empty documents or an
    empty benchmark give an empty result. Other columns play no part.
    """
    spark, out = documents.sparkSession, None
    for query in queries_of(documents, benchmark):
        sent = spark.sparkContext.broadcast(query)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                text = _words(batch["text"])
                found = [(d, sent.value.item_ids[i], *x) for (d, i), x in leaks(sent.value, text).items()]
                found += [(d, item_id, 1.0, 1.0, 1.0) for d, item_id in short_leaks(sent.value, text)]
                if found:
                    at, items, *shares = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch["doc_id"].cast("int64").take(pa.array(at, pa.int64())), pa.array(items, pa.int64()),
                         *map(pa.array, shares)],
                        ["doc_id", "item_id", "cosine", "part", "answer"])

        part = documents.select("doc_id", "text").mapInArrow(run, RESULT)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], RESULT) if out is None else out


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, unchanged, that have no leak."""
    out = documents
    for query in queries_of(documents, benchmark):
        sent = documents.sparkSession.sparkContext.broadcast(query)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean, at = np.ones(len(batch), bool), 0
                for piece in pieces(iter([batch])):
                    text = _words(piece["text"])
                    for document, _ in (*leaks(sent.value, text), *short_leaks(sent.value, text)):
                        clean[at + document] = False
                    at += len(piece)
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, documents.schema)
    return out
