"""Token ids of whole texts with the tokenizers library, encoding each distinct piece of text once.

White space always ends a piece for the vocabularies used here (they drop it before they look for
tokens), so the ids of a text are the ids of its runs of other characters put together. Runs
repeat far more often than texts do: a task collects the distinct runs of some megabytes of text,
lets the library encode those it has not met, and puts the ids together as arrays. Documents
that hold nothing but ASCII and the letters U+00C0 to U+00FF are also lower-cased (A-Z) and cut
where letters, digits and punctuation meet, apostrophes aside: the vocabulary cuts there too, and
"word," then costs nothing new after "word". Texts with the strings of special tokens keep to runs.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barflow.llm.common import pieces
from barflow.llm.words import text_bytes

END = 1
#: Runs whose ids a worker keeps; beyond that it keeps those of the text at hand.
KEPT_RUNS = 400_000
#: Bytes of text handled at once, and runs that the library encodes at once.
PIECE = 4 << 20
ENCODED = 8192

# Classes of bytes: white space and all that is never cut 0, letters 1, punctuation 2, digits 3.
_CLASS = np.zeros(256, np.uint8)
for _b in range(0x21, 0x7F):
    _CLASS[_b] = 1 if chr(_b).isalpha() else 3 if chr(_b).isdigit() else 2
_CLASS[0xC3] = 1
_CLASS[0x80:0xC0] = 1
_CLASS[ord("'")] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each document: only ASCII and letters U+00C0..U+00FF, and nothing like a special token."""
    odd = (data >= 0xC0) & (data != 0xC3)
    odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the signs among them
    odd[1:] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    found = np.ones(len(offsets) - 1, bool)
    found[np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1] = False
    return found


def _cut(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Lower-cased texts with a space between letters, digits and punctuation."""
    kind = _CLASS[data]
    change = np.zeros(len(data), bool)
    change[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    change[1:] |= (kind[1:] == 3) & (kind[:-1] == 3)
    places = np.flatnonzero(change)
    out = np.insert(_LOWER[data], places, 32)
    ends = offsets + np.searchsorted(places, offsets)
    return pa.Array.from_buffers(pa.large_utf8(), len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(out)])


class Encoder:
    """Ids of texts; ``special`` strings of the vocabulary keep their meaning, as in the library."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # The cut needs a vocabulary that lower-cases and never joins letters, digits and punctuation.
        split = re.search(r'"Regex":\s*"([^"]*\\\\p\{L\}[^"]*)"', self.library.to_str())
        self.cuts = split is not None and split[1] == (
            r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+") and "Lowercase" in self.library.to_str()
        if not self.cuts:
            raise ValueError("runs of text stand alone only in vocabularies that drop white space")
        # Number 0, under a name that no run has, is the end of a document.
        self.known: dict[str, int] = {"\n": 0}
        self.lists = pa.ListArray.from_arrays(pa.array([0, 1], pa.int32()), pa.array([END], pa.uint32()))

    def _numbers(self, runs: list[str]) -> np.ndarray:
        """Number of each run; ``self.lists`` has the ids by number."""
        if len(self.known) > KEPT_RUNS:
            kept = [x for x in runs if x in self.known]
            self.lists = self.lists.take(pa.array([0, *map(self.known.__getitem__, kept)]))
            self.known = {"\n": 0, **dict(zip(kept, range(1, len(kept) + 1)))}
        known = self.known
        new = [x for x in runs if x not in known]
        known.update(zip(new, range(len(known), len(known) + len(new))))
        found = [self.lists]
        for at in range(0, len(new), ENCODED):
            some = self.library.encode_batch_fast(new[at:at + ENCODED], add_special_tokens=False)
            found.append(pa.array([e.ids for e in some], pa.list_(pa.uint32())))
        self.lists = pa.concat_arrays(found)
        return np.fromiter(map(known.__getitem__, runs), np.int32, len(runs))

    def _documents(self, texts: pa.Array) -> pa.ListArray:
        split = pc.ascii_split_whitespace(texts)
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_pylist())
        each = np.insert(numbers[coded.indices.to_numpy()], ends[1:] - ends[0], 0)
        taken = self.lists.take(pa.array(each))
        of_run = taken.offsets.to_numpy()
        of_document = of_run[ends - ends[0] + np.arange(len(ends))]
        return pa.ListArray.from_arrays(pa.array(of_document - of_run[0], pa.int32()), taken.flatten())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each followed by ``END``; offsets by text). No NULLs."""
        data, offsets = text_bytes(texts)
        plain = _plain(data, offsets)
        if plain.all():
            found = self._documents(_cut(data, offsets))
        else:
            odd = self._documents(texts.filter(pa.array(~plain)))
            cut = self._documents(_cut(*text_bytes(texts.filter(pa.array(plain)))))
            order = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
            found = pa.concat_arrays([cut, odd]).take(pa.array(order))
        ends = found.offsets.to_numpy().astype(np.int64)
        return found.flatten().to_numpy(), ends - ends[0]


@cache
def encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)


def encoded(
    batches: Iterator[pa.RecordBatch], path: str
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with a ``text``, piece by piece, with their ids and the ids' offsets by row."""
    for piece in pieces(batches, size=PIECE):
        yield piece, *encoder(path).encode(piece["text"])
        pa.default_memory_pool().release_unused()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
