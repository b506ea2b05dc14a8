"""Substring dedup over words by level-wise doubling.

Level one looks at windows of seven words: a seed of every longer window, picked
by the smallest hash, is checked for a second document (`blocks.find_shared`).
Where it recurs alone, windows are extended to twice that length, 13 words with
one word in common; a window recurs when its hash is found under a smaller
doc_id. The query makes this one step. `longest_levels` reports longer windows (26,
52, ...): it judges the whole input anew for each length until a length finds
nothing, and carries no windows over from the length before.

Words are runs of characters other than space and \\t to \\r and enter by 64-bit
hashes. Every word covered by a 13-word window that also starts in a document with
a smaller doc_id is removed; windows are judged on the input.

Defined cases: null text has no words; documents below 13 words stay whole; a
null doc_id counts as larger than any other; rows that repeat a doc_id do not
remove each other's words; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import blocks as B
from tallymart.llm.text import table
from tallymart.session import cut_lineage

WINDOW = 13
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                          ("kept_sha256", pa.string())])


class _Hashes(dict):
    """Word to 64-bit hash; forgets everything when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _Hashes()


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` neighbouring words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[k:k + n]
    return B.mix(out)


@dataclass
class _Read:
    runs: B.Runs
    lengths: np.ndarray  # words of each document
    windows: np.ndarray  # hash of every window, documents one after another


def _read(block: B.Block, window: int) -> _Read:
    parts, lengths, windows = [], [], []
    for a, z in block.chunks():
        each = [t.split() for t in block.texts[a:z]]  # bytes split at space and \t to \r
        size = np.array([len(w) for w in each], dtype=np.int64)
        words = np.fromiter((_HASHES[w] for ws in each for w in ws), np.uint64, size.sum())
        seed = (window + 1) // 2
        anchors = B.least(_rolled(words, seed), window - seed + 1) if len(words) >= window else words[:0]
        parts.append(B.runs_of(anchors, size, window, a))
        lengths.append(size)
        full = _rolled(words, window)
        begin = np.cumsum(size) - size
        keep = np.maximum(size - window + 1, 0)
        at = np.repeat(begin, keep) + np.arange(keep.sum()) - np.repeat(np.cumsum(keep) - keep, keep)
        windows.append(full[at])
    none = [np.zeros(0, np.int64)]
    return _Read(B.joined(parts), np.concatenate(lengths or none), np.concatenate(windows or none).astype(np.uint64))


def _candidates(block: B.Block, read: _Read, marks: pa.Table):
    """Windows whose seed recurs: document, place in it, hash; and their order by (hash, id)."""
    shared, _ = B.flagged(read.runs, marks)
    windows = np.repeat(shared, read.runs.size)
    doc = np.repeat(read.runs.doc, read.runs.size)[windows]
    start = (np.repeat(read.runs.start, read.runs.size) + np.arange(len(windows))
             - np.repeat(np.cumsum(read.runs.size) - read.runs.size, read.runs.size))[windows]
    hashes = read.windows[windows]
    order = np.lexsort((block.ids[doc], hashes))
    sorted_ = hashes[order]
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else order
    return doc, start, hashes, order, first


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Blocks of `docs`, and the answers that tell each block which windows to remove (kind 2)."""
    blocks, layout = B.write_blocks(docs)
    shared = B.find_shared(blocks, lambda block: _read(block, window).runs, layout.buckets(0.2))
    buckets = layout.buckets(1.0)

    def send(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            block = B.Block(rows)
            doc, _, hashes, order, first = _candidates(block, _read(block, window), marks)
            each, ids = hashes[order][first], block.ids[doc[order][first]]
            out = [(b, block.number, each[s].tobytes(), B.planes(ids[s])) for b, s in B.sliced(each, buckets)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(
            list(zip(*out, strict=True)) or [[]] * 4,
            (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
            names=["bucket", "block", "hashes", "ids"])

    def answer(rows: pa.Table) -> pa.Table:
        owner = rows.column("block").to_pylist()
        each = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
        ids = np.concatenate([B.unplanes(x, np.int64) for x in rows.column("ids").to_pylist()])
        hashes = np.concatenate(each)
        order = np.argsort(hashes)
        sorted_ = hashes[order]
        first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        least = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(sorted_))))
        flags = np.empty(len(hashes), bool)
        flags[order] = least < ids[order]
        cut, bucket = np.cumsum([0, *map(len, each)]), rows.column("bucket")[0].as_py()
        out = [(owner[i], 2, bucket, len(each[i]), np.packbits(flags[cut[i]:cut[i + 1]]).tobytes())
               for i in range(len(each))]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(
            zip(*out, strict=True), B.ANSWER_ARROW, strict=True)], schema=B.ANSWER_ARROW)

    sent = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        send, "bucket long, block long, hashes binary, ids binary")
    removed = cut_lineage(sent.groupBy("bucket").applyInArrow(answer, B.ANSWER))
    return blocks, shared.unionByName(removed)


def _removed(block: B.Block, marks: pa.Table, window: int):
    """Per document of the block its number of words and the mask of removed words."""
    read = _read(block, window)
    doc, start, hashes, order, first = _candidates(block, read, marks)
    elsewhere = B.bits_of(marks, 2)
    size = np.diff(np.append(first, len(order)))
    ids = block.ids[doc[order]]
    gone = np.empty(len(order), bool)
    gone[order] = np.repeat(elsewhere, size) | (np.repeat(ids[first], size) < ids) if len(order) else False
    doc, start = doc[gone], start[gone]
    cut = np.searchsorted(doc, np.arange(len(block.texts) + 1))
    for i, n in enumerate(read.lengths):
        yield int(n), B.covered(start[cut[i]:cut[i + 1]], window, int(n)) if cut[i] < cut[i + 1] else None


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 per document; with `texts` also the kept text."""
    blocks, marks = repeated_windows(docs, window)
    schema = RESULT_ARROW.append(pa.field("kept", pa.string())) if texts else RESULT_ARROW

    def apply(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            block = B.Block(rows)
            for doc_id, text, (n, mask) in zip(
                    block.doc_ids, block.texts, _removed(block, answers, window), strict=True):
                words = text.split()
                kept = b" ".join(words if mask is None else [words[k] for k in np.flatnonzero(~mask)])
                row = (doc_id, n, 0 if mask is None else int(mask.sum()), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode()) if texts else row)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(
            list(zip(*out, strict=True)) or [[]] * len(schema), schema, strict=True)], schema=schema)

    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        apply, RESULT + (", kept string" if texts else ""))


def longest_levels(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, documents): per level how many documents still have a recurring window.

    Doubles the window until a level finds nothing.
    """
    levels, length = [], window
    while True:
        found = remove_repeats(docs, length).where("n_removed > 0").count()
        if not found:
            break
        levels.append((length, found))
        length *= 2
    return docs.sparkSession.createDataFrame(levels, "window int, documents long")


def op4_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, i, hash(w[i:i+{WINDOW - 1}]) AS h FROM d, unnest(range(1, len(w) - {WINDOW - 2})) t(i)
), m AS (SELECT h, min(doc_id) AS f FROM s GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM s JOIN m USING (h), unnest(range(0, {WINDOW})) t(k) WHERE f < doc_id
), g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
