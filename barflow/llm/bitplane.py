"""Token ids on disk: fixed-size blocks of ids, transposed into planes and compressed plane by plane.

A file holds the ids of consecutive documents:

    magic | planes of block 0 | planes of block 1 | ... | documents | index | index size | magic

A block of ``BLOCK`` ids (the last one may be shorter) is transposed: plane k has bits, or bytes, k
of all its ids; planes above the highest id of a block are not written. Each plane is a zstandard
frame. The index has, for every block, the number of ids and where its planes begin and end, so a
reader can fetch any block alone. ``documents`` has doc_id and number of ids of each document.

Documents are range-partitioned and sorted by id; a task writes its ids to files of at most
``FILE_IDS`` ids plus one document, each attempt under names of its own. The rows that name the
files are written as a table once all tasks are done, and only files named there are read, so
what a lost or repeated attempt left behind is never seen.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm import tokens
from barflow.llm.common import shuffle_partitions, stored
from barflow.session import work_dir

#: Fixed value: begins and ends a file.
MAGIC = b"idplane1"
BLOCK = 1 << 16
FILE_IDS = 1 << 24
LEVEL = 3

FILE = "part int, number int, path string, n_documents long, n_ids long, n_bytes long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, kind: str) -> list[np.ndarray]:
    """Planes of a block, lowest first, without the empty ones above the highest id."""
    columns = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        return [np.ascontiguousarray(columns[:, k]) for k in range(-(-top // 8))]
    return [np.packbits(columns[:, k // 8] >> (k % 8) & 1, bitorder="little") for k in range(top)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    ids = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        values = np.frombuffer(plane, np.uint8)
        if kind == "byte":
            ids[:, k] = values
        else:
            ids[:, k // 8] |= np.unpackbits(values, count=n, bitorder="little") << (k % 8)
    return ids.reshape(-1).view("<u4")


class Writer:
    """Writes one file; ``add`` takes whole documents."""

    def __init__(self, uri: str, kind: str = "byte", level: int = LEVEL) -> None:
        system, path = fs.FileSystem.from_uri(uri)
        self.uri, self.kind = uri, kind
        self.out = system.open_output_stream(path, compression=None)
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.at = self.out.write(MAGIC) or len(MAGIC)
        self.at = len(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.blocks: list[list[int]] = []
        self.documents: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _write(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return self.at

    def _block(self, ids: np.ndarray) -> None:
        ends = [self.at]
        for plane in to_planes(ids, self.kind):
            ends.append(self._write(self.pack(plane.tobytes())))
        self.blocks.append([len(ids), *ends])

    def add(self, known: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """``known`` is 0 where the document has no id of its own."""
        self.documents.append((known, doc_ids, lengths))
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= BLOCK:
            together = np.concatenate(self.waiting)
            whole = len(together) // BLOCK * BLOCK
            for begin in range(0, whole, BLOCK):
                self._block(together[begin:begin + BLOCK])
            self.waiting, self.held = [together[whole:].copy()], len(together) - whole

    def close(self) -> tuple[str, int, int, int]:
        """(path, documents, ids, bytes)."""
        if self.held:
            self._block(np.concatenate(self.waiting))
        columns = [np.concatenate(c) for c in zip(*self.documents)]
        n = len(columns[0])
        ends = [self.at]
        for column, kind in zip(columns, ("u1", "<i8", "<i8")):
            ends.append(self._write(self.pack(column.astype(kind).tobytes())))
        flat = [self.kind == "byte", n, *ends]
        for block in self.blocks:
            flat += [len(block), *block]
        index = self.pack(np.array(flat, "<i8").tobytes())
        self._write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return self.uri, n, self.n_ids, self.at


class Reader:
    """Reads the documents of one file, or any block of it."""

    def __init__(self, uri: str) -> None:
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no whole file of ids")
        n = int.from_bytes(tail[:8], "little")
        flat = np.frombuffer(self.unpack(self.file.read_at(n, size - 16 - n)), "<i8")
        self.kind = "byte" if flat[0] else "bit"
        self.n_documents, self.document_ends = int(flat[1]), flat[2:6]
        self.blocks, at = [], 6
        while at < len(flat):
            self.blocks.append(flat[at + 1:at + 1 + flat[at]])
            at += 1 + int(flat[at])

    def _frames(self, ends: np.ndarray) -> list[bytes]:
        data = self.file.read_at(int(ends[-1] - ends[0]), int(ends[0]))
        return [self.unpack(data[int(b - ends[0]):int(e - ends[0])]) for b, e in zip(ends, ends[1:])]

    def block(self, k: int) -> np.ndarray:
        n, *ends = self.blocks[k]
        return from_planes(self._frames(np.array(ends)), int(n), self.kind)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether the id is known, doc ids, lengths)."""
        frames = self._frames(self.document_ends)
        return tuple(np.frombuffer(x, kind) for x, kind in zip(frames, ("u1", "<i8", "<i8")))

    def texts(self) -> Iterator[np.ndarray]:
        """The ids of each document in turn; one block and one document in memory."""
        held, k = np.zeros(0, "<u4"), 0
        for length in self.documents()[2]:
            if len(held) < length:
                some, n = [held], len(held)
                while n < length:
                    some.append(self.block(k))
                    n, k = n + len(some[-1]), k + 1
                held = np.concatenate(some)
            yield held[:length]
            held = held[length:]


def write_ids(documents: DataFrame, folder: str, vocabulary: str, kind: str = "byte") -> DataFrame:
    """Encode texts and write the files; the table of files, in the order of their documents.

    Ascending doc_id, NULL first; documents with the same doc_id stand in the order of a hash of
    their texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, writer = TaskContext.get().partitionId(), [], None
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        for rows, ids, ends in tokens.encoded(batches, vocabulary):
            doc_ids = rows["doc_id"].cast("int64")
            known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
            numbers = doc_ids.fill_null(0).to_numpy()
            begin = 0
            while begin < len(rows):
                writer = writer or Writer(f"{folder}/{part:06d}-{uuid.uuid4().hex}.ids", kind)
                room = max(0, FILE_IDS - writer.n_ids)
                end = min(len(rows), int(np.searchsorted(ends, ends[begin] + room, side="left")))
                end = max(end, begin + 1)
                writer.add(known[begin:end], numbers[begin:end], np.diff(ends[begin:end + 1]),
                           ids[ends[begin]:ends[end]])
                begin = end
                if writer.n_ids >= FILE_IDS:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        if done:
            columns = zip(*[(part, number, *file) for number, file in enumerate(done)])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=written)

    written = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()),
                         *[(c, pa.int64()) for c in ("n_documents", "n_ids", "n_bytes")]])
    # A running number lets rows that are equal in both go to different tasks.
    order = ["doc_id", "tie", "salt"]
    ordered = documents.select(
        "doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("salt")
    ).repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "salt")
    return stored(ordered.mapInArrow(run, FILE), "id-files")


def read_ids(files: DataFrame) -> DataFrame:
    """doc_id, first id's number among all ids, number of ids and their checksum, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
                file = Reader(path)
                known, doc_ids, lengths = file.documents()
                sums = np.fromiter((zlib.crc32(x.tobytes()) for x in file.texts()), np.int64, len(lengths))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=known == 0), pa.array(start + np.cumsum(lengths) - lengths),
                     pa.array(lengths), pa.array(sums)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    placed = files.withColumn("start", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    spread = placed.repartition(shuffle_partitions(files.sparkSession))
    return spread.mapInArrow(run, DOCUMENT)


def encode_and_read(
    documents: DataFrame, vocabulary: str | None = None, kind: str = "byte", folder: str | None = None
) -> DataFrame:
    """Write the ids of all documents, read the files back, and tell what they hold.

    NULL and empty texts have the end id alone. Repeated rows stay repeated; rows without a
    doc_id come first. An empty table gives an empty result. Other columns play no part.
    """
    folder = folder or work_dir(documents.sparkSession, "ids")
    return read_ids(write_ids(documents, folder, vocabulary or tokens.default_vocabulary(), kind))
