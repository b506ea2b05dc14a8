"""Which hashes of a block occur elsewhere, asked and answered in two levels.

Sending one row per (block, range of hashes) makes blocks times ranges rows, the square of the
input. Here blocks and ranges are dealt into groups of about the square root of their number.
A block sends one row per group of ranges; a task per (group of blocks, group of ranges)
turns these into one row per range; a range answers with one row per group of blocks; and a
second task per pair of groups sorts the answers by block. So rows number blocks times the root
of ranges and ranges times the root of blocks, and each carries a root's worth of hashes.
Nothing but hashes and bits moves, and no task holds more than a root of either side.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm import blocks as B
from tallymart.session import cut_lineage

# Several pieces in one row: what each belongs to, how many hashes it has, hashes, bits.
PIECES = "range_group long, block_group long, name long, of array<long>, sizes array<long>, hashes binary, bits binary"
PIECES_ARROW = pa.schema([
    ("range_group", pa.int64()), ("block_group", pa.int64()), ("name", pa.int64()), ("of", pa.list_(pa.int64())),
    ("sizes", pa.list_(pa.int64())), ("hashes", pa.binary()), ("bits", pa.binary())])


def groups(n: int) -> int:
    return max(1, math.isqrt(n))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _packed(flags: list[np.ndarray]) -> bytes:
    return b"".join(np.packbits(x).tobytes() for x in flags)


def _unpacked(data: bytes, sizes: list[int]) -> list[np.ndarray]:
    out, at = [], 0
    for n in sizes:
        width = -(-n // 8)
        out.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=n).astype(bool))
        at += width
    return out


def _turned(rows: pa.Table) -> pa.Table:
    """Rows that name a block and hold pieces per range become rows that name a range and hold
    pieces per block; and the other way round."""
    found: dict[int, list[tuple[int, int, bytes, bytes]]] = {}
    for row in rows.to_pylist():
        hashes, bits = row["hashes"] or b"", row["bits"]
        at_hash = at_bit = 0
        planes = len(bits) // sum(-(-n // 8) for n in row["sizes"])  # kinds of bits side by side
        for of, n in zip(row["of"], row["sizes"], strict=True):
            width = planes * -(-n // 8)
            found.setdefault(of, []).append(
                (row["name"], n, hashes[at_hash:at_hash + 4 * n], bits[at_bit:at_bit + width]))
            at_hash, at_bit = at_hash + 4 * n, at_bit + width
    range_group, block_group = rows.column("range_group")[0].as_py(), rows.column("block_group")[0].as_py()
    out = []
    for name, pieces in sorted(found.items()):
        of, sizes, hashes, bits = zip(*sorted(pieces), strict=True)
        out.append((range_group, block_group, name, list(of), list(sizes), b"".join(hashes), b"".join(bits)))
    return _table(out, PIECES_ARROW)


def find_shared(blocks: DataFrame, anchors: Callable[[B.Block], B.Runs], layout: B.Layout, ranges: int,
                levels: dict[int, int]) -> DataFrame:
    """Answers per block (see `blocks.ANSWER`): which of its hashes lie in several documents,
    and which lie in more blocks than a level says (kind of the answer to level)."""
    range_groups, block_groups = groups(ranges), groups(layout.blocks)
    each = -(-ranges // range_groups)  # neighbouring ranges share a group, so answers stay in order

    def send(rows: pa.Table) -> pa.Table:
        block = B.Block(rows)
        runs = anchors(block)
        # Per distinct hash the first and the last document of the block that holds it.
        order = np.argsort(runs.hash, kind="stable")  # runs come in the order of documents
        hashes, docs = runs.hash[order], block.ids[runs.doc[order]]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
        last = np.append(first[1:], len(hashes)) - 1 if len(hashes) else order
        several, hashes = docs[first] != docs[last], hashes[first]
        by_group: dict[int, list[tuple[int, slice]]] = {}
        for r, s in B.sliced(hashes, ranges):
            by_group.setdefault(r // each, []).append((r, s))
        return _table([
            (g, block.number % block_groups, block.number, [r for r, _ in own], [s.stop - s.start for _, s in own],
             b"".join(B.shortened(hashes[s], r, ranges).tobytes() for r, s in own), _packed([several[s] for _, s in own]))
            for g, own in by_group.items()], PIECES_ARROW)

    def answer(rows: pa.Table) -> pa.Table:
        held = rows.to_pylist()
        sizes = [n for row in held for n in row["sizes"]]
        hashes = np.concatenate([np.frombuffer(row["hashes"], np.uint32) for row in held])
        several = np.concatenate([x for row in held for x in _unpacked(row["bits"], row["sizes"])])
        order = np.argsort(hashes)
        sorted_ = hashes[order]
        first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        holders = np.diff(np.append(first, len(sorted_)))  # blocks that hold the hash
        shared = (holders > 1) | (np.add.reduceat(several[order].astype(np.int64), first) > 0)
        flags = []
        for value in (shared, *(holders > level for level in levels.values())):
            flag = np.empty(len(hashes), bool)
            flag[order] = np.repeat(value, holders)
            flags.append(flag)
        cut, out, at = np.cumsum([0, *sizes]), [], 0
        for row in held:
            bits = []
            for n in row["sizes"]:
                bits += [f[cut[at]:cut[at] + n] for f in flags]
                at += 1
            out.append((row["range_group"], row["block_group"], row["name"], row["of"], row["sizes"], b"", _packed(bits)))
        return _table(out, PIECES_ARROW)

    kinds = (B.SHARED, *levels)

    def sort_out(rows: pa.Table) -> pa.Table:
        """One row per block, kind and group of ranges, its bits in the order of the hashes."""
        out = []
        for row in _turned(rows).to_pylist():
            bits = _unpacked(row["bits"], [n for n in row["sizes"] for _ in kinds])
            n = sum(row["sizes"])
            out += [(row["name"], kind, row["range_group"], n, np.packbits(np.concatenate(bits[k::len(kinds)])).tobytes())
                    for k, kind in enumerate(kinds)]
        return _table(out, B.ANSWER_ARROW)

    pairs = ["range_group", "block_group"]
    by_range = blocks.groupBy("block").applyInArrow(send, PIECES).groupBy(*pairs).applyInArrow(_turned, PIECES)
    answers = by_range.groupBy("name").applyInArrow(answer, PIECES)
    return cut_lineage(answers.groupBy(*pairs).applyInArrow(sort_out, B.ANSWER))
