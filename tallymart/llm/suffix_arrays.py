"""Substring dedup over bytes by induced sorting of suffix arrays.

Windows of 50 bytes whose anchor occurs in no other document cannot recur
(`blocks.find_shared`). The rest lies in segments, stretches of bytes whose windows
share one anchor. Equal windows have equal anchors, so windows can only meet among
the segments of one anchor. Blocks first send a 128-bit digest and the smallest
doc_id per distinct segment: where all segments of an anchor are the same text,
there is nothing to sort, and its smallest doc_id is that of each window. The others
are open and travel to the shard that owns the anchor's hash range: equal windows
meet in one shard. A shard lays its distinct segments end to end, sorts
all suffixes by induced sorting, computes permuted common prefixes, and reads the
smallest doc_id of every group of equal windows off the sorted order. Blocks get
back, per segment, where a window's smallest doc_id lies below their own.

An anchor of very many texts (a passage that a third of all documents hold, as each
continues differently) would bring them all to its shard. Its segments are cut into
single windows that are dealt out by their own hash; windows inside the passage are
equal and travel once per block. An anchor in very many blocks is cut before digests
are sent.

Every byte covered by a 50-byte string that also starts in a document with a
smaller doc_id is removed; strings are judged on the input, matches never cross
documents. Defined cases: null text is empty; documents below 50 bytes stay
whole; a null doc_id counts as larger than any other; rows that repeat a doc_id
do not remove each other's bytes; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import blocks as B
from tallymart.llm.induced import common_prefixes, suffix_array
from tallymart.llm.text import table
from tallymart.session import cut_lineage

WINDOW = 50
SEED = 24
SHARD_BYTES = 6 << 20
PIECES = 4  # a shard's suffix arrays, built one after another to bound a task's memory
SEGMENTS = 0.35  # expected bytes of open segments per byte of text; only sizes shards
DIGESTS = 0.45  # expected bytes of described segments per byte of text; only sizes ranges
RANGE_BYTES = 8 << 20
WIDE_TEXTS = 4_096  # segments of anchors with more texts than this are resolved window by window
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                          ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
OPEN, WIDE, LOWER, REPLY = 2, 3, 4, 5  # kinds of answers, next to those of `blocks`
ALONE = B.ANSWER + ", values binary"
ALONE_ARROW = B.ANSWER_ARROW.append(pa.field("values", pa.binary()))
SEGMENT_ROWS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()),
                          ("digests", pa.binary()), ("ids", pa.binary())])
SHARD_ROWS = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("data", pa.binary()),
                        ("lens", pa.binary()), ("ids", pa.binary()), ("pieces", pa.binary())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _anchors(block: B.Block, window: int) -> B.Runs:
    seed, parts = min(SEED, window), []
    for a, z in block.chunks():
        texts = block.texts[a:z]
        size = np.array([len(t) for t in texts], dtype=np.int64)
        data = b"".join(texts) + bytes(8)
        n = len(data) - 8 - seed + 1
        if n < window - seed + 1:
            continue
        words = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
        hashes = B.mix(words[:n])
        for k in range(8, seed - 7, 8):
            hashes = B.mix(hashes + words[k:k + n])
        if seed % 8:
            hashes = B.mix(hashes + words[seed - 8:seed - 8 + n])
        parts.append(B.runs_of(B.least(hashes, window - seed + 1), size, window, a))
    return B.joined(parts)


class _Segments:
    """The distinct segments of a block with a shared anchor, by anchor, and the runs they come from."""

    def __init__(self, block: B.Block, marks: pa.Table, window: int):
        runs = _anchors(block, window)
        shared, hot = B.flagged(runs, marks)
        self.block, self.window, self.runs = block, window, runs
        self.base = np.cumsum([0, *map(len, block.texts)])
        place: dict[bytes, int] = {}
        cold = np.flatnonzero(shared & ~hot)
        self.cold, self.hot = cold, np.flatnonzero(hot)
        self.doc = runs.doc[cold]
        self.begin, self.size = self.base[self.doc] + runs.start[cold], runs.size[cold]
        which = np.fromiter((place.setdefault(c, len(place)) for c in self._texts(cold)), np.int64, len(cold))
        first = np.unique(which, return_index=True)[1]
        hashes = runs.hash[cold][first]
        order = np.argsort(hashes, kind="stable")
        distinct = list(place)
        self.contents = [distinct[i] for i in order.tolist()]
        self.hash = hashes[order]
        self.least = block.ids[self.doc[first]][order]  # documents come by id, so the first is the smallest
        self.which = np.argsort(order)[which] if len(order) else which

    def _texts(self, chosen: np.ndarray) -> list[bytes]:
        texts, runs, start = self.block.texts, self.runs, self.runs.start[chosen]
        ends = start + runs.size[chosen] + self.window - 1
        return [texts[d][a:z] for d, a, z in zip(runs.doc[chosen].tolist(), start.tolist(), ends.tolist(), strict=True)]

    def digests(self) -> np.ndarray:
        joined_ = b"".join(map(xxhash.xxh3_128_digest, self.contents))
        return np.frombuffer(joined_, np.uint64).reshape(-1, 2)

    def shipped(self, marks: pa.Table, shards: int) -> "_Shipped":
        """What the suffix arrays need: open segments, and the windows of hot and wide ones one by one."""
        chosen = np.flatnonzero(B.bits_of(marks, OPEN))
        contents = [self.contents[i] for i in chosen.tolist()]
        piece = np.searchsorted(B.bounds(shards * PIECES), self.hash[chosen], side="right").tolist()
        least = self.least[chosen].tolist()
        single: dict[bytes, int] = {}
        cut: set[bytes] = set()
        parted = np.sort(np.concatenate([self.hot, self.cold[B.bits_of(marks, WIDE)[self.which]]]))
        doc = self.runs.doc[parted]
        parts = list(zip(doc.tolist(), (self.base[doc] + self.runs.start[parted]).tolist(), self._texts(parted), strict=True))
        for doc, _, content in parts:
            if content not in cut:
                cut.add(content)
                for k in range(len(content) - self.window + 1):
                    part = content[k:k + self.window]
                    if part not in single:
                        single[part] = len(contents)
                        contents.append(part)
                        piece.append(xxhash.xxh3_64_intdigest(part) % (shards * PIECES))
                        least.append(int(self.block.ids[doc]))
        return _Shipped(contents, np.array(piece, np.int64), np.array(least, np.int64), chosen, single, parts)


class _Shipped(NamedTuple):
    contents: list[bytes]
    piece: np.ndarray  # shards * PIECES pieces, PIECES neighbours a shard
    least: np.ndarray  # smallest id of the block
    chosen: np.ndarray  # the open segments, which come first
    single: dict[bytes, int]  # windows of hot and wide segments to their place
    parted: list[tuple]  # the runs of these: document, first window in the block, text

    def by_shard(self):
        """(shard, places) in the order that rows are sent and answered."""
        order = np.argsort(self.piece // PIECES, kind="stable")
        shard = self.piece[order] // PIECES
        edges = np.flatnonzero(shard[1:] != shard[:-1]) + 1
        for places in np.split(order, edges) if len(order) else []:
            yield int(self.piece[places[0]]) // PIECES, places


def _alone(rows: pa.Table, wide: int) -> pa.Table:
    """Per block which segments of a range of anchors meet another text under their anchor
    (OPEN), or more than `wide` texts (WIDE), and of the others which have a smaller id
    elsewhere (LOWER), and that id."""
    owner = rows.column("block").to_pylist()
    each = [np.frombuffer(x, np.uint32) for x in rows.column("hashes").to_pylist()]
    hashes = np.concatenate(each)
    digest = np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 2) for x in rows.column("digests").to_pylist()])
    ids = np.concatenate([B.unplanes(x, np.int64) for x in rows.column("ids").to_pylist()])
    order = np.lexsort((digest[:, 1], digest[:, 0], hashes))
    h, d = hashes[order], digest[order]
    anchor = np.append(True, h[1:] != h[:-1])
    text = anchor | np.append(True, (d[1:] != d[:-1]).any(axis=1))
    first, place = np.flatnonzero(text), np.cumsum(text) - 1
    texts = np.bincount(np.cumsum(anchor)[first] - 1)  # distinct texts per anchor
    held, least = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
    held[order] = texts[np.cumsum(anchor) - 1]
    least[order] = np.minimum.reduceat(ids[order], first)[place]
    flags = {OPEN: (held > 1) & (held <= wide), WIDE: held > max(1, wide), LOWER: (held == 1) & (least < ids)}
    cut = np.cumsum([0, *map(len, each)])
    bucket, out = rows.column("bucket")[0].as_py(), []
    for i, block in enumerate(owner):
        here = slice(cut[i], cut[i + 1])
        values = B.planes(least[here][flags[LOWER][here]])
        out += [(block, kind, bucket, len(each[i]), np.packbits(flag[here]).tobytes(), values if kind == LOWER else None)
                for kind, flag in flags.items()]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(
        zip(*out, strict=True), ALONE_ARROW, strict=True)], schema=ALONE_ARROW)


def least_ids(segments: list[bytes], ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of all segments end to end (one mark after each) the smallest id of
    the equal windows starting there; and where each segment begins."""
    lengths = np.array([len(s) for s in segments], dtype=np.int64) + 1
    data = b"\x00".join(segments) + b"\x00" + bytes(window + 16)
    raw = np.frombuffer(data, np.uint8)
    n = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    t = np.empty(n + 1, dtype=np.uint16)
    t[:n] = raw[:n]
    t[:n] += 2
    t[begin + lengths - 1], t[n] = 1, 0
    sa = suffix_array(t, window)[1:]  # without the end mark
    same = common_prefixes(raw, sa, window)[sa] >= window
    owner = np.repeat(ids, lengths)
    inside = np.repeat(begin + lengths - 1, lengths) - np.arange(n) >= window
    owner[~inside] = B.NO_ID
    # Bytes of marks and of zeros in texts look alike in `raw`, so windows that cross a
    # segment's end may only look equal to their neighbours: they stand alone.
    valid = inside[sa]
    first = np.flatnonzero(~(same & valid & np.append(False, valid[:-1])))
    least = np.minimum.reduceat(owner[sa], first) if n else owner
    out = np.empty(n, dtype=np.int64)
    out[sa] = np.repeat(least, np.diff(np.append(first, n)))
    return out, begin


def _stretches(segments: list[bytes], own: np.ndarray, window: int) -> list[tuple | None]:
    """Per segment the stretches of windows with one smallest id: where each begins and the
    id; None where no window has a smaller one than the segment's own."""
    place: dict[bytes, int] = {}
    which = np.fromiter((place.setdefault(s, len(place)) for s in segments), np.int64, len(segments))
    smallest = np.full(len(place), B.NO_ID)
    np.minimum.at(smallest, which, own)
    distinct = list(place)
    least, begin = least_ids(distinct, smallest, window)
    size = np.array([len(s) for s in distinct], dtype=np.int64) - window + 1
    new = np.zeros(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    new[begin] = True
    edges = np.flatnonzero(new)
    lo, hi = np.searchsorted(edges, begin), np.searchsorted(edges, begin + size)
    out = []
    for s, mine in zip(which.tolist(), own.tolist(), strict=True):
        e = edges[lo[s]:hi[s]]
        alone = len(e) == 1 and least[e[0]] == mine
        out.append(None if alone else (e - begin[s], least[e]))
    return out


def _resolve(window: int):
    def run(rows: pa.Table) -> pa.Table:
        shipped, lens, ids, pieces = [], [], [], []
        for data, length, own, piece in zip(*[rows.column(c).to_pylist() for c in (
                "data", "lens", "ids", "pieces")], strict=True):
            sizes = np.frombuffer(length, np.uint32)
            lens.append(len(sizes))
            ids.append(B.unplanes(own, np.int64))
            pieces.append(np.frombuffer(piece, np.uint8))
            at = 0
            for size in sizes.tolist():
                shipped.append(data[at:at + size])
                at += size
        own, piece = np.concatenate(ids), np.concatenate(pieces)
        answer: list[tuple | None] = [None] * len(shipped)
        for k in range(PIECES):
            here = np.flatnonzero(piece == k).tolist()
            if here:
                for i, found in zip(here, _stretches([shipped[i] for i in here], own[here], window), strict=True):
                    answer[i] = found
        cut, out, none = np.cumsum([0, *lens]), [], [np.zeros(0, np.int64)]
        for r, (block, shard) in enumerate(zip(
                rows.column("block").to_pylist(), rows.column("shard").to_pylist(), strict=True)):
            mine = answer[cut[r]:cut[r + 1]]
            counts = np.array([0 if x is None else len(x[0]) for x in mine], np.uint32)
            held = [x for x in mine if x is not None]
            out.append((block, shard, counts.tobytes(),
                        np.concatenate([x for x, _ in held] or none).astype(np.uint32).tobytes(),
                        B.planes(np.concatenate([x for _, x in held] or none))))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()),
            strict=True)], names=["block", "shard", "counts", "starts", "values"])

    return run


def _apply(found: _Segments, marks: pa.Table, shards: int) -> np.ndarray:
    """Mask of the removed bytes of a block's texts, laid end to end."""
    block, window = found.block, found.window
    step = np.zeros(sum(map(len, block.texts)) + 1, dtype=np.int32)

    def remove(begin: np.ndarray, windows: np.ndarray) -> None:
        np.add.at(step, begin, 1)
        np.add.at(step, begin + windows + window - 1, -1)

    open_, lower = B.bits_of(marks, OPEN), B.bits_of(marks, LOWER)
    settled = ~(open_ | B.bits_of(marks, WIDE))
    kinds, bucket = marks.column("kind").to_pylist(), marks.column("bucket").to_pylist()
    least = found.least.copy()
    least[lower] = np.concatenate([np.zeros(0, np.int64), *[
        B.unplanes(marks.column("values")[i].as_py(), np.int64)
        for i in sorted((i for i, k in enumerate(kinds) if k == LOWER), key=bucket.__getitem__)]])
    own = block.ids[found.doc]
    gone = settled[found.which] & (least[found.which] < own)
    remove(found.begin[gone], found.size[gone])

    # Of what went to the suffix arrays: where a stretch of windows begins, and its smallest id.
    sent = found.shipped(marks, shards)
    starts: list = [None] * len(sent.contents)
    replies = {bucket[i]: [marks.column(c)[i].as_py() for c in ("counts", "starts", "values")]
               for i, k in enumerate(kinds) if k == REPLY}
    for shard, places in sent.by_shard():
        counts, at, values = replies[shard]
        at, values = np.frombuffer(at, np.uint32).astype(np.int64), B.unplanes(values, np.int64)
        end = 0
        for i, n in zip(places.tolist(), np.frombuffer(counts, np.uint32).tolist(), strict=True):
            if n:
                starts[i] = at[end:end + n], values[end:end + n]
                end += n
    whole = np.zeros(1, np.int64)
    held = [starts[i] or (whole, sent.least[i:i + 1]) for i in range(len(sent.chosen))]
    if held:
        stretches = np.array([len(x) for x, _ in held], dtype=np.int64)
        at, values = (np.concatenate([x[k] for x in held]) for k in (0, 1))
        lead = np.cumsum(stretches) - stretches
        total = np.array([len(c) - window + 1 for c in sent.contents[:len(held)]], dtype=np.int64)
        after = np.append(at[1:], 0)
        after[lead + stretches - 1] = total
        runs = np.flatnonzero(open_[found.which])
        mine = np.searchsorted(sent.chosen, found.which[runs])
        n = stretches[mine]
        i = np.repeat(lead[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        run = np.repeat(runs, n)
        gone = values[i] < own[run]
        remove((found.begin[run] + at[i])[gone], (after - at)[i][gone])
    windows: dict[bytes, np.ndarray] = {}
    for doc, begin, content in sent.parted:
        if content not in windows:
            parts = [sent.single[content[k:k + window]] for k in range(len(content) - window + 1)]
            windows[content] = np.array([starts[i][1][0] if starts[i] else sent.least[i] for i in parts], dtype=np.int64)
        removed = np.flatnonzero(windows[content] < block.ids[doc]) + begin
        remove(removed, np.ones(len(removed), np.int64))
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 per document; with `texts` also the kept bytes."""
    blocks, layout = B.write_blocks(docs)
    shared = B.find_shared(blocks, lambda block: _anchors(block, window), layout.buckets(0.3))
    shards = layout.buckets(SEGMENTS, SHARD_BYTES)
    ranges = max(1, math.ceil(layout.total * DIGESTS / RANGE_BYTES))

    def describe(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            block = B.Block(rows)
            found = _Segments(block, marks, window)
            digests = found.digests()
            out = [(b, block.number, B.shortened(found.hash[s], b, ranges).tobytes(), digests[s].tobytes(),
                    B.planes(found.least[s])) for b, s in B.sliced(found.hash, ranges)]
        return _rows(out, SEGMENT_ROWS)

    wide = WIDE_TEXTS

    def settle(rows: pa.Table) -> pa.Table:
        return _alone(rows, wide)

    def send(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            block = B.Block(rows)
            sent = _Segments(block, marks, window).shipped(marks, shards)
            for shard, places in sent.by_shard():
                contents = [sent.contents[i] for i in places.tolist()]
                out.append((shard, block.number, b"".join(contents),
                            np.array([len(c) for c in contents], np.uint32).tobytes(),
                            B.planes(sent.least[places]), (sent.piece[places] % PIECES).astype(np.uint8).tobytes()))
        return _rows(out, SHARD_ROWS)

    described = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        describe, "bucket long, block long, hashes binary, digests binary, ids binary")
    alone = cut_lineage(described.groupBy("bucket").applyInArrow(settle, ALONE))
    marks = shared.withColumn("values", F.lit(None).cast("binary")).unionByName(alone)
    sent = blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        send, "shard long, block long, data binary, lens binary, ids binary, pieces binary")
    # A shard costs far more time than its bytes suggest: a task each, none merged.
    replies = cut_lineage(sent.repartition(shards, "shard").groupBy("shard").applyInArrow(
        _resolve(window), "block long, shard long, counts binary, starts binary, values binary"))
    answers = marks.unionByName(
        replies.selectExpr("block", f"{REPLY} AS kind", "shard AS bucket", "0 AS n", "counts", "starts", "values"),
        allowMissingColumns=True)
    schema = RESULT_ARROW.append(pa.field("kept", pa.binary())) if texts else RESULT_ARROW

    def apply(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            block = B.Block(rows)
            gone = _apply(_Segments(block, marks, window), marks, shards)
            end = 0
            for doc_id, text in zip(block.doc_ids, block.texts, strict=True):
                mask, end = gone[end:end + len(text)], end + len(text)
                kept, removed, spans = text, int(np.count_nonzero(mask)), 0
                if removed:
                    kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                    spans = int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1]))
                row = (doc_id, len(text), removed, spans, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if texts else row)
        return _rows(out, schema)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        apply, RESULT + (", kept binary" if texts else ""))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents
), s AS (
  SELECT doc_id, i, hash(substr(x, 2 * i + 1, {2 * WINDOW})) AS h FROM d, unnest(range(0, n - {WINDOW - 1})) t(i)
), m AS (SELECT h, min(doc_id) AS f FROM s GROUP BY h
), w AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER o + {WINDOW}, true) AS fresh FROM s JOIN m USING (h) WHERE f < doc_id
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), r AS (
  SELECT doc_id, g, min(i) AS a, max(i) + {WINDOW} AS z FROM (
    SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM w) GROUP BY ALL
), p AS (
  SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS last FROM r
), k AS (
  SELECT doc_id, sum(z - a)::BIGINT AS gone, count(*) AS spans, max(z) AS z,
    string_agg(substr(x, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS kept FROM p JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(x, 2 * z + 1), x))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
