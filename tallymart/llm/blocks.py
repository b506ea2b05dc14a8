"""Repeats across documents: blocks of documents, anchors, and where they recur.

Documents are dealt into blocks of about `BLOCK_BYTES` of text by a hash, and
written once as a bucketed table, so that later steps read a block again without
another shuffle. A block describes its windows of `window` units (bytes or words)
by anchors: the smallest hash among the `window - seed + 1` seeds a window holds.
Equal windows have equal anchors, neighbouring windows mostly share one, so a
block has far fewer anchors than windows.

Anchors travel as arrays: one row per (bucket of the hash range, block) holds
the block's distinct hashes in that range. A bucket sees which hashes lie in
several documents and answers every block with one bit per hash in the same
order; no row ever stands for a single occurrence, and a hash that a third of
all documents share appears once per block. Windows without a shared anchor
cannot recur and are done.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.session import checkpoint_folder, cut_lineage

BLOCK_BYTES = 6 << 20
CHUNK_BYTES = 1 << 17  # so that the arrays of a chunk stay in a cache
BUCKET_BYTES = 16 << 20
FILES = 50_000  # bucket files at most; more blocks than that share files
HOT_BLOCKS = 2_048  # anchors in more blocks than this are resolved window by window
NO_ID = np.iinfo(np.int64).max  # a null id is larger than any other


@dataclass(frozen=True)
class Layout:
    blocks: int
    total: int  # bytes of all texts
    parts: int

    def buckets(self, share: float, size: int = BUCKET_BYTES) -> int:
        """How many ranges keep `share` bytes per byte of text near `size` each."""
        return max(self.parts, math.ceil(self.total * share / size))


def write_blocks(docs: DataFrame) -> tuple[DataFrame, Layout]:
    """(block, doc_id, text) clustered by block, and its layout."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layout = Layout(max(parts, math.ceil(total / BLOCK_BYTES)), total, parts)
    name = f"llm_blocks_{uuid.uuid4().hex}"
    files = min(layout.blocks, FILES)
    rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(layout.blocks))).repartition(
        files, "block").write.bucketBy(files, "block").option("compression", "zstd").option(
        "path", f"{checkpoint_folder(spark)}/tables/{name}").saveAsTable(name)
    return spark.table(name), layout


class Block:
    """The documents of one block in a fixed order, whatever order they arrive in."""

    def __init__(self, rows: pa.Table):
        texts = pc.cast(rows.column("text").combine_chunks(), pa.binary()).to_pylist()
        ids = rows.column("doc_id").to_pylist()
        keys = [(NO_ID if i is None else i, t) for i, t in zip(ids, texts, strict=True)]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        self.number = rows.column("block")[0].as_py() if len(keys) else None
        self.texts = [texts[i] for i in order]
        self.doc_ids = [ids[i] for i in order]
        self.ids = np.array([keys[i][0] for i in order], dtype=np.int64)

    def chunks(self):
        """Ranges of documents of about `CHUNK_BYTES` together."""
        start, size = 0, 0
        for i, text in enumerate(self.texts):
            if size and size + len(text) > CHUNK_BYTES:
                yield start, i
                start, size = i, 0
            size += len(text)
        if start < len(self.texts):
            yield start, len(self.texts)


@dataclass
class Runs:
    """Stretches of windows with one anchor: document, first window, windows, hash."""

    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    hash: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every `width` neighbours."""
    span = 1
    while 2 * span <= width:
        hashes = np.minimum(hashes[:-span], hashes[span:])
        span *= 2
    rest = width - span
    return np.minimum(hashes[:-rest], hashes[rest:]) if rest else hashes


def runs_of(anchors: np.ndarray, lengths: np.ndarray, window: int, first: int) -> Runs:
    """Runs in a chunk of documents of `lengths` units, laid end to end.

    `anchors[i]` belongs to the window that starts at unit i; windows that would
    cross the end of a document are left out. `first` is the first document's number.
    """
    ends = np.cumsum(lengths)
    windows = np.maximum(lengths - window + 1, 0)
    doc = np.repeat(np.arange(len(lengths)), windows)
    inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    values = anchors[np.repeat(ends - lengths, windows) + inside]
    new = np.flatnonzero(np.append(True, (values[1:] != values[:-1]) | (doc[1:] != doc[:-1]))) \
        if len(values) else np.zeros(0, np.int64)
    size = np.diff(np.append(new, len(values)))
    # Smallest hashes crowd at the low end; mixed again they fill all ranges alike.
    return Runs(doc[new] + first, inside[new], size, mix(values[new]))


def joined(parts: list[Runs]) -> Runs:
    empty = [Runs(*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))]
    return Runs(*[np.concatenate([getattr(p, f) for p in parts or empty])
                  for f in ("doc", "start", "size", "hash")])


def bounds(buckets: int) -> np.ndarray:
    """First hash of every bucket but the first."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)


def sliced(hashes: np.ndarray, buckets: int):
    """(bucket, slice) of sorted hashes, empty buckets left out."""
    cut = np.concatenate([[0], np.searchsorted(hashes, bounds(buckets)), [len(hashes)]])
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), slice(cut[b], cut[b + 1])


def shortened(hashes: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """The leading 32 bits of hashes inside their bucket's range. Two hashes that fall
    together here only make a candidate more, never one less."""
    shift = max(0, 33 - buckets.bit_length())
    return ((hashes - np.uint64((bucket << 64) // buckets)) >> np.uint64(shift)).astype(np.uint32)


def planes(values: np.ndarray) -> bytes:
    """Bytes of 64-bit values by significance, which lets the shuffle compress the high ones."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def bits_of(marks: pa.Table, kind: int) -> np.ndarray:
    """All answer bits of one kind for a block, in the order of its sorted hashes."""
    rows = sorted((b, x, n) for b, x, k, n in zip(
        marks.column("bucket").to_pylist(), marks.column("bits").to_pylist(),
        marks.column("kind").to_pylist(), marks.column("n").to_pylist(), strict=True) if k == kind)
    parts = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for _, x, n in rows]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


ANSWER = "block long, kind int, bucket long, n int, bits binary"
ANSWER_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()),
                          ("n", pa.int32()), ("bits", pa.binary())])
SHARED, HOT = 0, 1


def find_shared(blocks: DataFrame, anchors: Callable[[Block], Runs], buckets: int,
                levels: dict[int, int] | None = None) -> DataFrame:
    """Answers per block (see ANSWER): which of its anchors lie in several documents, and
    which lie in more blocks than a level says (kind of the answer to level; HOT by default)."""
    levels = {HOT: HOT_BLOCKS} if levels is None else levels

    def send(rows: pa.Table) -> pa.Table:
        block = Block(rows)
        runs = anchors(block)
        # Per distinct hash the first and the last document of the block that holds it.
        order = np.argsort(runs.hash, kind="stable")  # runs come in the order of documents
        hashes, docs = runs.hash[order], block.ids[runs.doc[order]]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
        last = np.append(first[1:], len(hashes)) - 1 if len(hashes) else order
        several, hashes = docs[first] != docs[last], hashes[first]
        out = [(b, block.number, shortened(hashes[s], b, buckets).tobytes(), np.packbits(several[s]).tobytes())
               for b, s in sliced(hashes, buckets)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(
            list(zip(*out, strict=True)) or [[]] * 4,
            (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
            names=["bucket", "block", "hashes", "several"])

    def answer(rows: pa.Table) -> pa.Table:
        owner = rows.column("block").to_pylist()
        each = [np.frombuffer(x, np.uint32) for x in rows.column("hashes").to_pylist()]
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(h))
                                  for x, h in zip(rows.column("several").to_pylist(), each, strict=True)])
        hashes = np.concatenate(each)
        order = np.argsort(hashes)
        sorted_ = hashes[order]
        first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        held = np.diff(np.append(first, len(sorted_)))  # blocks that hold the hash
        shared = (held > 1) | (np.add.reduceat(several[order].astype(np.int64), first) > 0)
        flags = {kind: np.empty(len(hashes), bool) for kind in (SHARED, *levels)}
        flags[SHARED][order] = np.repeat(shared, held)
        for kind, level in levels.items():
            flags[kind][order] = np.repeat(held > level, held)
        cut = np.cumsum([0, *map(len, each)])
        bucket = rows.column("bucket")[0].as_py()
        out = [(owner[i], kind, bucket, len(each[i]), np.packbits(flags[kind][cut[i]:cut[i + 1]]).tobytes())
               for i in range(len(each)) for kind in flags]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(
            zip(*out, strict=True), ANSWER_ARROW, strict=True)], schema=ANSWER_ARROW)

    sent = blocks.groupBy("block").applyInArrow(
        send, "bucket long, block long, hashes binary, several binary")
    return cut_lineage(sent.groupBy("bucket").applyInArrow(answer, ANSWER))


def flagged(runs: Runs, marks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Per run of a block whether its anchor is shared, and whether it is hot."""
    hashes, place = np.unique(runs.hash, return_inverse=True)
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, bool)
    return bits_of(marks, SHARED)[place], bits_of(marks, HOT)[place]


def covered(starts: np.ndarray, window: int, length: int) -> np.ndarray:
    """Mask of the units that windows at `starts` cover."""
    step = np.zeros(length + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + window, length), -1)
    return np.cumsum(step[:-1]) > 0
