"""Licence scan: matching statistics against a generalised suffix automaton of licence words.

The automaton holds the words of all templates: notices and passages of well-known licences, and
the fixed phrases. A text is streamed through it: after each word the state tells the longest end
of the text read so far that stands somewhere in a template. Where such a match ends, it is a
long match with its places in templates; long matches of one template that follow each other in
text and template with small gaps are chained, and a chain that covers enough of its template is a
span with that licence's label. The score is the largest part of a template that a chain covers.

A fixed phrase stands wherever the state, or one on its way up the suffix links, is the phrase's.

Only words that stand in a template in that order, pair by pair, can make a match of three words or
more, so arrays of word hashes pick the stretches of text that are streamed. The automaton is
built from a few thousand words and sent to the tasks; texts are never compared with each other.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barflow.llm.common import pieces
from barflow.llm.words import ALPHANUMERIC, word_hash, words

#: Phrases that count wherever their words stand consecutively.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices and opening passages of public licences, by label.
TEMPLATES = {
    "apache-2": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "bsd-3": [
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
    ],
    "cc-by": ["this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc": [
        "licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "cc-by-sa": [
        "licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "gpl-3": [
        "licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
    ],
    "mpl-2": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ],
}

#: Words of a long match; words that may be missing or added between two of a chain; the part of a
#: template that a chain must cover.
LONG, GAP, COVERED = 3, 8, 0.6


class SuffixAutomaton:
    """Generalised: the words of all sequences added, each begun anew at the root (state 0)."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: (sequence, place of the last word) of each state's matches.
        self.places: list[set[tuple[int, int]]] = [set()]

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.places.append(set())
        return len(self.next) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        """A copy of ``state`` for its shorter matches, those one word longer than ``before``."""
        copy = self._state(self.length[before] + 1, dict(self.next[state]), self.link[state])
        self.link[state] = copy
        while before != -1 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        state = self.next[last].get(word)
        if state is not None:
            return state if self.length[state] == self.length[last] + 1 else self._split(last, word, state)
        new = self._state(self.length[last] + 1, {}, 0)
        while last != -1 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last != -1:
            state = self.next[last][word]
            whole = self.length[state] == self.length[last] + 1
            self.link[new] = state if whole else self._split(last, word, state)
        return new

    def add(self, sequence: Sequence[int]) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word)

    def mark(self, sequences: Sequence[Sequence[int]]) -> None:
        """Note all places of all states once every sequence is added."""
        for number, sequence in enumerate(sequences):
            state = 0
            for place, word in enumerate(sequence):
                state = self.next[state][word]
                above = state
                while above > 0:
                    self.places[above].add((number, place))
                    above = self.link[above]

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        follow = self.next[state].get(word)
        return (0, 0) if follow is None else (follow, matched + 1)


class Scanner:
    """The automaton with what it needs to be used on word hashes."""

    def __init__(self, templates: Mapping[str, Sequence[str]], phrases: Mapping[str, str]) -> None:
        self.labels = [label for label, texts in templates.items() for _ in texts] + list(phrases.values())
        texts = [t.split() for some in templates.values() for t in some] + [p.split() for p in phrases]
        if min(map(len, texts), default=LONG) < LONG:
            raise ValueError(f"templates and phrases have at least {LONG} words")
        known = sorted({w for t in texts for w in t}, key=word_hash)
        self.hashes = np.array([word_hash(w) for w in known], np.uint64)
        number = {w: i for i, w in enumerate(known)}
        self.texts = [[number[w] for w in t] for t in texts]
        self.first_phrase = len(texts) - len(phrases)
        self.pairs = np.zeros((len(known) + 1, len(known) + 1), bool)  # the last is for other words
        self.automaton = SuffixAutomaton()
        for sequence in self.texts:
            self.automaton.add(sequence)
            self.pairs[sequence[:-1], sequence[1:]] = True
        self.automaton.mark(self.texts)
        # Phrases that end a state's matches: those of the state itself and of all up its links.
        own = defaultdict(list)
        for number in range(self.first_phrase, len(texts)):
            state = 0
            for word in self.texts[number]:
                state = self.automaton.next[state][word]
            own[state].append((number, len(texts[number])))
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.automaton.next]
        for state in sorted(range(1, len(self.ends)), key=self.automaton.length.__getitem__):
            self.ends[state] = own[state] + self.ends[self.automaton.link[state]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, len(self.hashes))

    def stretches(self, numbers: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, first word, end) of the longest runs in which each pair stands in a template."""
        if len(numbers) < LONG:
            return
        joined = self.pairs[numbers[:-1], numbers[1:]]
        borders = first[1:-1]
        borders = borders[(borders > 0) & (borders < len(numbers))]
        joined[borders - 1] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]])))
        begin, end = edges[::2], edges[1::2] + 1
        long = end - begin >= LONG
        begin, end = begin[long], end[long]
        documents = np.searchsorted(first, begin, side="right") - 1
        yield from zip(documents.tolist(), begin.tolist(), end.tolist())

    def scan(self, words_of: Sequence[int], start: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """(start, phrase) of all phrases; (start, length, template, place there) of long matches."""
        step, places, ends = self.automaton.step, self.automaton.places, self.ends
        state = matched = 0
        found, long = [], []
        for i, word in enumerate(words_of):
            before, was = state, matched
            state, matched = step(state, matched, word)
            if was >= LONG and matched <= was:
                long += [(start + i - was, was, t, p - was + 1) for t, p in places[before] if p + 1 >= was]
            if matched >= LONG:
                found += [(start + i - n + 1, t) for t, n in ends[state] if n <= matched]
        if matched >= LONG:
            end = start + len(words_of)
            long += [(end - matched, matched, t, p - matched + 1) for t, p in places[state] if p + 1 >= matched]
        return found, long

    def chains(self, long: list[tuple[int, int, int, int]]) -> list[tuple[float, int, int, int]]:
        """(part covered, template, first word, end) of the best chain that ends with each match."""
        by_template = defaultdict(list)
        for start, n, template, place in long:
            by_template[template].append((start, start + n, place, place + n))
        out = []
        for template, matches in by_template.items():
            matches.sort()
            size, chains = len(self.texts[template]), []  # a chain: covered, first, end, end in template
            open_from = 0
            for start, end, place, place_end in matches:
                while open_from < len(chains) and chains[open_from][2] + GAP < start:
                    open_from += 1
                best = (place_end - place, start)
                for covered, first, last, last_place in chains[open_from:]:
                    overlap = max(0, last - start, last_place - place)
                    gap = max(start - last, place - last_place)
                    if last < end and last_place < place_end and gap <= GAP and overlap < place_end - place:
                        best = max(best, (covered + place_end - place - overlap, first), key=lambda x: x[0])
                chains.append((*best, end, place_end))
            out += [(min(1.0, covered / size), template, first, end) for covered, first, end, _ in chains]
        return out


@cache
def _scanner(templates: tuple, phrases: tuple) -> Scanner:
    return Scanner({label: list(texts) for label, texts in templates}, dict(phrases))


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label: string, first: long, end: long, part: double>>"
)
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("part", pa.float64())]))


def _best_spans(chains: list[tuple[float, str, int, int]]) -> list[tuple[float, str, int, int]]:
    """Of chains of one label that overlap, the one that covers most; of equal ones the first."""
    kept: list[tuple[float, str, int, int]] = []
    reach: dict[str, list[tuple[int, int]]] = defaultdict(list)  # kept spans, apart from each other, in order
    for chain in sorted(chains, key=lambda c: (-c[0], c[2], c[3])):
        _, label, first, end = chain
        known = reach[label]
        at = bisect_left(known, (first, end))
        if (at == 0 or known[at - 1][1] <= first) and (at == len(known) or end <= known[at][0]):
            known.insert(at, (first, end))
            kept.append(chain)
    return sorted(kept, key=lambda c: (c[2], c[1]))


def scan(
    documents: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES, covered: float = COVERED,
) -> DataFrame:
    """Per document: words, fixed phrases, labels, score, and the spans of covered templates.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII, counted from
    0. ``n_base`` counts all places of fixed phrases, ``first_word`` and ``last_word`` are their
    smallest and largest start (NULL without one). Labels are distinct, sorted and joined by commas;
    ``labels`` has those of phrases and of spans. ``score`` is 1 with a phrase. NULL and empty
    texts have no words, empty labels and score 0. Rows with a repeated or NULL doc_id are
    scanned like all others; an empty table gives an empty result; other columns play no part.
    """
    known = (tuple((a, tuple(b)) for a, b in templates.items()), tuple(phrases.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*known)
        for batch in pieces(batches):
            text = words(batch["text"], ALPHANUMERIC)
            numbers = scanner.numbers(text.hash)
            bases, longs = defaultdict(list), defaultdict(list)
            for document, begin, end in scanner.stretches(numbers, text.first):
                found, long = scanner.scan(numbers[begin:end].tolist(), begin - int(text.first[document]))
                bases[document] += found
                longs[document] += long
            rows = []
            for document in range(len(batch)):
                base, long = bases.get(document, ()), longs.get(document, ())
                chains = [(part, scanner.labels[t], a, b) for part, t, a, b in scanner.chains(long)] if long else []
                spans = _best_spans([c for c in chains if c[0] >= covered])
                own = {scanner.labels[t] for _, t in base}
                starts = [start for start, _ in base]
                rows.append((
                    len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
                    ",".join(sorted(own | {c[1] for c in spans})),
                    1.0 if base else max((c[0] for c in chains), default=0.0),
                    [{"label": c[1], "first": c[2], "end": c[3], "part": c[0]} for c in spans]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast("int64"), pa.array(np.diff(text.first), pa.int64()), *columns],
                [f.split()[0] for f in RESULT.split(", ")[:8]] + ["spans"])

    return documents.select("doc_id", "text").mapInArrow(run, RESULT)
