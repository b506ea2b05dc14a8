"""Packing along a space-filling curve.

Every document becomes a vector: its token ids are hashed into rows of a seeded
random matrix whose mean is a point in `DIMS` dimensions. The Hilbert key of the
point puts documents with similar tokens close together on one line; a range
sort by (key, hash, doc_id) deals the line out over tasks, and each task pours
its stretch into sequences of `length` tokens, cutting where a sequence is full.
The last tokens of a stretch are cut into sequences whose lengths are powers of
two, which need no padding.

Defined cases: null text is empty and yields just the end id; very long
documents are cut into as many pieces as they need; repeated rows are packed
one by one; an empty table gives an empty result; only doc_id and text are read.
The order along the curve is total up to identical rows, so a lost task rebuilds
the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table
from tallymart.llm.tokens import END_ID, Ids, byte_bpe_path
from tallymart.session import cut_lineage

LENGTH = 2048
DIMS = 4
BITS = 12
SEED = 97
ROWS = 256  # documents encoded together
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points, one per row (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _matrix(rows: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((rows, DIMS)).astype(np.float32)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids.at(path)
        kind, rows = f"<u{ids.width}", 1 << 16
        matrix = _matrix(rows)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                end = END_ID.to_bytes(ids.width, "little")
                found = [x + end for x in ids.encode_all([x or "" for x in part.column("text").to_pylist()])]
                points = np.stack([
                    matrix[np.frombuffer(x, kind) & (rows - 1)].mean(axis=0) for x in found])
                grid = ((np.tanh(2 * points) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(hilbert_key(grid)), pa.array(found, pa.binary())],
                    ["doc_id", "key", "ids"])

    return run


class _Pour:
    """Fills sequences one after another; keeps only the one that is open."""

    def __init__(self, task: int, length: int):
        self.next, self.length, self.open, self.used = task << 40, length, [], 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            part = ids[at:at + self.length - self.used]
            self.open.append((doc_id, at, part, len(ids)))
            self.used, at = self.used + len(part), at + len(part)
            if self.used == self.length:
                self._close(self.open)
                self.open, self.used = [], 0

    def _close(self, parts: list[tuple]) -> None:
        offset = 0
        for doc_id, start, part, whole in parts:
            crc = zlib.crc32(part.astype("<u4").tobytes())
            self.rows.append((doc_id, start, len(part), crc, whole, self.next, offset))
            offset += len(part)
        self.next += 1

    def end(self) -> None:
        """Cuts what is left into lengths that are powers of two, largest first."""
        left, todo = self.used, self.open[::-1]
        while left:
            room = 1 << (left.bit_length() - 1)
            left, parts = left - room, []
            while room:
                doc_id, start, part, whole = todo.pop()
                if len(part) > room:
                    todo.append((doc_id, start + room, part[room:], whole))
                    part = part[:room]
                parts.append((doc_id, start, part, whole))
                room -= len(part)
            self._close(parts)
        self.open, self.used = [], 0

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(schema)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], schema=schema)


def _packer(width: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
        pour = _Pour(TaskContext.get().partitionId(), length)
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                pour.add(doc_id, np.frombuffer(ids.as_buffer(), f"<u{width}"))
            yield pour.take(schema)
        pour.end()
        yield pour.take(schema)

    return run


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece of a document (see the query's contract for the columns)."""
    path = path or byte_bpe_path()
    encoded = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encoder(path), "doc_id long, key long, ids binary"))
    order = ["key", F.xxhash64("doc_id"), "doc_id"]
    lined = encoded.repartitionByRange(*order).sortWithinPartitions(*order, "ids")
    return lined.select("doc_id", "ids").mapInArrow(_packer(Ids.at(path).width, length), PIECES)


def op6_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
