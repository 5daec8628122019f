"""Secret scan: fixed patterns, and long tokens that pass a battery of randomness tests.

A token is a run of ``LEAST`` or more characters of [A-Za-z0-9+/_-], with up to two "=" after it.
Its encoding is the smallest alphabet below that has all its characters. Three tests ask whether
it could be random in that alphabet: chi-squared for equal use of the characters, the number of
runs above and below the middle of the alphabet, and the correlation of neighbours. A token that
fails one at ``FAIR`` is not random.

Passing is weak evidence for a short token. So the chi-squared value is also held against ordinary
text: how often would a token of this length, drawn from the characters of the corpus, be spread as
evenly? That is the p-value of "ordinary text", small only where length allows it. The tokens kept
are chosen among those of all documents by the Benjamini-Hochberg rule, weighted by length (up to
``HEAVY``), so that at most a part ``FALSE`` of them is expected to be ordinary.

Two counts over all documents fit this, 256 characters and a histogram of p-values in fixed bins;
the third pass finds and judges, each document on its own.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import pieces
from barflow.llm.words import runs, text_bytes

#: The kinds in their order, and the patterns with the least length of what counts.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
#: Any match of ``ASSIGN`` has one of these, lower-cased.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encodings by size of alphabet.
ALPHABETS = [
    _DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER, _UPPER, _UPPER + "234567", _LOWER + _DIGITS,
    _UPPER + _DIGITS, _LOWER + _UPPER, _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "+/",
    _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _LOWER + _DIGITS + "+/-_",
]
LEAST, HEAVY = 20, 64
FAIR, FALSE = 1e-3, 1e-3
#: Bins of p-values for each power of ten.
BINS = 50

TOKEN_BYTES = np.isin(np.arange(256), np.frombuffer(ALPHABETS[-1].encode(), np.uint8))
HEX_BYTES = np.isin(np.arange(256), np.frombuffer(ALPHABETS[1].encode(), np.uint8))


def _below(z: float) -> float:
    """The normal distribution up to z."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def battery(codes: np.ndarray, size: int) -> tuple[float, float, float]:
    """P-values of "random": equal use (Wilson-Hilferty), runs and neighbours (both two-sided).

    ``codes`` are places in an alphabet of ``size`` characters.
    """
    n = len(codes)
    counts = np.bincount(codes, minlength=size)
    chi = float((counts.astype(float) ** 2).sum() * size / n - n)
    free = size - 1
    even = 1 - _below(((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)))
    high = codes >= size / 2
    p = (size - math.ceil(size / 2)) / size
    changes = int((high[1:] != high[:-1]).sum())
    mean = 2 * p * (1 - p) * (n - 1)
    spread = math.sqrt(max(1e-9, mean * (1 - 2 * p * (1 - p))))
    runs_p = 2 * _below(-max(0.0, abs(changes - mean) - 0.5) / spread)
    centred = codes - codes.mean()
    square = float((centred ** 2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / square if square else 1.0
    return even, runs_p, 2 * _below(-abs(serial + 1 / n) * math.sqrt(n))


def ordinary(codes: np.ndarray, usual: np.ndarray) -> float:
    """How often characters drawn as ``usual`` are spread as evenly as these, or more so.

    The chi-squared value of such a draw has a known mean and spread; normal approximation.
    """
    n, size = len(codes), len(usual)
    counts = np.bincount(codes, minlength=size)
    chi = float((counts.astype(float) ** 2).sum() * size / n - n)
    two, three = float((usual ** 2).sum()), float((usual ** 3).sum())
    mean = size * (1 - two) + n * (size * two - 1)
    spread = size / n * math.sqrt(max(1e-9, 4 * n**3 * max(0.0, three - two**2) + 2 * n**2 * two**2))
    return max(1e-300, _below((chi - mean) / spread))


class Judge:
    """Knows the usual characters; says how ordinary a token is, 1 where it is not random."""

    def __init__(self, usual: list[float]) -> None:
        self.tables = []
        for alphabet in ALPHABETS:
            places = np.full(256, -1)
            places[list(alphabet.encode())] = np.arange(len(alphabet))
            part = np.array([usual[b] for b in alphabet.encode()])
            self.tables.append((places, part / part.sum()))

    def p_value(self, token: np.ndarray) -> float:
        for places, usual in self.tables:
            codes = places[token]
            if codes.min() >= 0:
                return ordinary(codes, usual) if min(battery(codes, len(usual))) >= FAIR else 1.0
        return 1.0


class Model(NamedTuple):
    """What was counted over all documents. Tokens with bin >= ``least_bin`` are kept."""

    usual: list[float]
    least_bin: int


def _bin(p: float, n: int) -> int:
    return math.floor(-BINS * math.log10(p / min(n, HEAVY)))


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(document, begin, end) in bytes of all tokens."""
    begin, end = runs(data, offsets, TOKEN_BYTES)
    long = end - begin >= LEAST
    begin, end = begin[long], end[long]
    documents = np.searchsorted(offsets, begin, side="right") - 1
    yield from zip(documents.tolist(), begin.tolist(), end.tolist())


def fit(documents: DataFrame, false: float = FALSE) -> Model:
    """Count the characters of all texts, then the p-values of all tokens, and set the limit."""

    def characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(256, np.int64)
        for batch in pieces(batches):
            counts += np.bincount(text_bytes(batch["text"])[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(counts)], ["byte", "n"])

    found = documents.select("text").mapInArrow(characters, "byte int, n long").groupBy("byte").agg(F.sum("n"))
    usual = [1.0] * 256  # each character once more than seen
    for byte, n in found.collect():  # 256 rows
        usual[byte] += n

    def p_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(usual)
        for batch in pieces(batches):
            data, offsets = text_bytes(batch["text"])
            rows = [(_bin(judge.p_value(data[b:e]), e - b), min(e - b, HEAVY)) for _, b, e in tokens_of(data, offsets)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], ["bin", "weight"])

    counted = documents.select("text").mapInArrow(p_values, "bin long, weight long").groupBy("bin").agg(
        F.count("*"), F.sum("weight")).collect()  # bins are bounded: 300 powers of ten
    return Model(usual, limit([tuple(r) for r in counted], false))


def limit(counted: list[tuple[int, int, int]], false: float = FALSE) -> int:
    """The lowest bin that the rule keeps, from (bin, tokens, their weights); beyond all if none."""
    total = sum(n for _, n, _ in counted)
    mean = sum(w for _, _, w in counted) / total if total else 1
    kept, least = 0, 1 << 30
    for number, n, _ in sorted(counted, reverse=True):
        kept += n
        if 10 ** (-number / BINS) * mean <= kept * false / total:  # the upper end of the bin
            least = number
    return least


def fixed_spans(text: str, hex_spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; runs of hex digits are found by the caller."""
    found = [(start, 2, end) for start, end in hex_spans]
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _reach(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Sorted starts, and the furthest end of all spans up to each of them."""
    ordered = sorted(spans)
    return [s[0] for s in ordered], list(accumulate((s[2] for s in ordered), max))


def _spans(batch: pa.RecordBatch, judge: Judge, least_bin: int) -> list[list[tuple[int, int, int]]]:
    """All spans of each document, in code points. A random token within a fixed span adds none."""
    data, offsets = text_bytes(batch["text"])
    texts = batch["text"].to_pylist()
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte

    def at(document: int, byte: int) -> int:
        return int(points[byte] - points[offsets[document]])

    begin, end = runs(data, offsets, HEX_BYTES)
    long = end - begin >= HEX_LEAST
    hexes: dict[int, list[tuple[int, int]]] = {}
    for b, e in zip(begin[long].tolist(), end[long].tolist()):
        document = int(np.searchsorted(offsets, b, side="right")) - 1
        start = at(document, b)
        hexes.setdefault(document, []).append((start, start + e - b))
    spans = [fixed_spans(text, hexes.get(i, [])) for i, text in enumerate(texts)]
    fixed = [_reach(found) for found in spans]
    for document, b, e in tokens_of(data, offsets):
        if _bin(judge.p_value(data[b:e]), e - b) >= least_bin:
            start = at(document, b)
            last = start + e - b
            last += len(re.match("={0,2}", texts[document][last:last + 2])[0])
            starts, furthest = fixed[document]
            before = bisect_right(starts, start)
            if not before or furthest[before - 1] < last:
                spans[document].append((start, 3, last))
    return spans


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """The spans of every document, and counts and checksum of those of the fixed patterns.

    Spans are kind:start:end in code points, end exclusive, by start and then kind, joined by
    commas. NULL and empty texts have none. Rows with a repeated or NULL doc_id are scanned like
    all others; an empty table gives an empty result; other columns play no part.
    """
    known = model or fit(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(known.usual)
        for batch in pieces(batches):
            spans = _spans(batch, judge, known.least_bin)
            counts = [pa.array([sum(k == kind for _, k, _ in s) for s in spans], pa.int64()) for kind in range(3)]
            fixed = [_joined([x for x in s if x[1] < 3]) for s in spans]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].cast("int64"), *counts,
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in fixed], pa.string()),
                pa.array([_joined(s) for s in spans], pa.string())], [f.split()[0] for f in RESULT.split(", ")])

    return documents.select("doc_id", "text").mapInArrow(run, RESULT)


def redact(documents: DataFrame, mask: str = "<secret>", model: Model | None = None) -> DataFrame:
    """All rows and columns of ``documents`` with each secret in ``text`` replaced by the mask.

    Secrets that overlap are replaced together. A NULL text stays NULL. A column ``n_chars`` is set
    to the new length where something was replaced.
    """
    known = model or fit(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(known.usual)
        for batch in batches:
            missing = batch["text"].is_null()
            for piece, gone in zip(pieces(iter([batch])), _like(pieces(iter([batch])), missing)):
                texts, sizes = piece["text"].to_pylist(), None
                for i, spans in enumerate(_spans(piece, judge, known.least_bin)):
                    if spans:
                        texts[i] = _masked(texts[i], spans, mask)
                        sizes = sizes or {}
                        sizes[i] = len(texts[i])
                texts = [None if g else t for t, g in zip(texts, gone.to_pylist())]
                out = piece.set_column(piece.schema.get_field_index("text"), "text", pa.array(texts, piece["text"].type))
                if sizes and "n_chars" in piece.schema.names:
                    held = piece["n_chars"].to_pylist()
                    for i, n in sizes.items():
                        held[i] = n
                    place = piece.schema.get_field_index("n_chars")
                    out = out.set_column(place, "n_chars", pa.array(held, piece["n_chars"].type))
                yield out

    return documents.mapInArrow(run, documents.schema)


def _like(cut: Iterator[pa.RecordBatch], column: pa.Array) -> Iterator[pa.Array]:
    at = 0
    for piece in cut:
        yield column.slice(at, len(piece))
        at += len(piece)


def _masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])
