"""Two tokenizers aligned on whole texts, and how often their tokens meet.

Both encode a space and the text. Byte offsets where a token of A and a token of B end
together cut the tokens into groups; the two tokens that end there are a link. How many
links of the whole table hold a pair of ids is the pair's count.

Cutting. A byte-level BPE begins a new piece at a single space between two characters that
are not white space, and this kind of B never joins a space to what stands before it; so
such places, and single line breaks between printable lines, end tokens of both, and a text
is the sequence of its units. A unit is encoded and aligned once per task and remembered
(`UNITS` at most); documents are sums and joins over their units. Loading the models checks
that no piece of B speaks against this; otherwise a text is one unit.

Counting. Every task counts the pairs of its documents and writes, per bucket of B ids, one
row of keys and counts. A tree of groupings (`FAN` rows at a time) unites the keys; each
bucket's distinct pairs get a minimal perfect hash: levels of bit arrays, where a pair is
placed by the first level at which its position is its own, and its number is the rank of
its bit. Then the tasks' counts become dense vectors indexed by that hash, summed by the same
kind of tree. The pair stored at a number verifies it. No bucket grows beyond what two
vocabularies can pair, however large the table is.

The second pass aligns the documents again and looks the counts up: in a broadcast copy while
there are at most `LOOKUP_PAIRS` pairs, else by a join of each document's distinct pairs
with the table of pairs. Both give the same rows.

Defined cases: null and empty texts, and texts that a tokenizer does not give back byte by
byte, have no tokens: zeros and an empty hash; repeated rows count each time; a null doc_id
is a row like any other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table
from tallymart.llm.tokens import byte_bpe_path, pieces
from tallymart.session import cut_lineage

BUCKETS = 64  # of B ids
FAN = 32
UNITS = 500_000  # remembered at once, and what a chunk adds; only speed depends on it
CHUNK = 1 << 20  # characters resolved at once
JOINED = 1 << 16  # characters of new units encoded together
LOOKUP_PAIRS = 4_000_000  # 17 bytes each
SPACE_MARK = "▁"


def piece_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Numbers(dict):
    """Numbers strings as they come, from a list that it shares with others."""

    def __init__(self, mark: str, met: list[str]):
        super().__init__()
        self.mark, self.met = mark, met

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.met)
        self.met.append(self.mark + word)
        return number


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    _loaded: dict[tuple[str, str], Pair] = {}

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        of = byte_characters()
        names = self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            if all(c in of for c in name):
                self.a_bytes[i] = bytes(of[c] for c in name)
        self.b = SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(SPACE_MARK, " ").encode()
                        for i, x in enumerate(names)]
        self.a_length, self.b_length = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.cuts = not any("\n" in x or SPACE_MARK in x.lstrip(SPACE_MARK) for x in names)

    @classmethod
    def at(cls, a_path: str, b_path: str) -> Pair:
        key = a_path, b_path
        if key not in cls._loaded:
            cls._loaded[key] = cls(*key)
        return cls._loaded[key]

    def units(self, text: str, first: Numbers, spaced: Numbers) -> list[int]:
        """Numbers of the parts of space + text that are encoded alike alone and in place:
        `spaced` knows words behind a space, `first` words behind a line break, and whatever
        else a unit may be as it is."""
        if not self.cuts:
            return [first[" " + text]]
        out: list[int] = []
        for line in text.split("\n"):
            words = line.split(" ")
            # Printable: no white space but spaces. No empty word: each of them stands alone.
            if "" in words or not line.isprintable():
                parts = pieces(" " + text)
                return [first[parts[0]], *[spaced[x[1:]] for x in parts[1:]]]
            if out:
                out.append(first["\n" + words[0]])
                out.extend(map(spaced.__getitem__, words[1:]))
            else:
                out.extend(map(spaced.__getitem__, words))
        return out

    def apart(self, unit: str) -> bool:
        """Units that may not stand between others: they end in white space, or B may read them
        as something else."""
        return not self.cuts or unit[-1].isspace() or SPACE_MARK in unit

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both for a text that begins with a space; B puts a space of its own first."""
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])


def decimals(ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Every id in decimal digits with its end mark behind it, and the length of each."""
    digits = np.zeros((len(ids), 11), np.uint8)
    digits[:, 10] = ends
    width, rest = np.full(len(ids), 2), ids.copy()
    for k in range(9, -1, -1):
        digits[:, k] = 48 + rest % 10
        rest //= 10
        width += rest > 0
        if not rest.any():
            break
    return digits[np.arange(11) >= 11 - width[:, None]].tobytes(), width


class Aligned:
    """Units seen so far: their tokens, groups and pairs, by a number from 0.

    A worker keeps one from task to task."""

    _kept: dict[tuple[str, str], Aligned] = {}

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    @classmethod
    def at(cls, paths: tuple[str, str]) -> Aligned:
        if paths not in cls._kept:
            cls._kept[paths] = cls(Pair.at(*paths))
        return cls._kept[paths]

    def clear(self) -> None:
        self.met: list[str] = []  # the units by number; `learn` brings the rest up to it
        self.first, self.spaced = Numbers("", self.met), Numbers(" ", self.met)
        self.groups: list[str | None] = []  # None where a tokenizer does not give the bytes back
        self.bad = False
        self._sizes: list[np.ndarray] = [np.zeros((0, 3), np.int64)]  # tokens of A, of B, links
        self._keys: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.scores, self.scored_by = np.zeros((0, 3), np.int64), None

    @property
    def sizes(self) -> np.ndarray:
        if len(self._sizes) > 1:
            self._sizes = [np.concatenate(self._sizes)]
        return self._sizes[0]

    @property
    def keys(self) -> np.ndarray:
        if len(self._keys) > 1:
            self._keys = [np.concatenate(self._keys)]
        return self._keys[0]

    def learn(self) -> None:
        """Encodes and aligns the units met since the last time."""
        near, size = [], 0
        for unit in self.met[len(self.groups):]:
            if self.pair.apart(unit):
                self._add(near)
                near, size = [], 0
                self._add_one(unit)
                continue
            near.append(unit)
            size += len(unit)
            if size >= JOINED:
                self._add(near)
                near, size = [], 0
        self._add(near)

    def _add(self, units: list[str]) -> None:
        """Units encoded as one text behind a first word, and taken apart at their ends."""
        if not units:
            return
        raw = [u.encode() for u in units]
        whole = b" x" + b"".join(raw)
        a, b = (np.array(x, np.int64) for x in self.pair.encode(whole.decode()))
        if not self._same(whole, a, b):
            for unit in units:
                self._add_one(unit)
            return
        a_ends, b_ends = np.cumsum(self.pair.a_length[a]), np.cumsum(self.pair.b_length[b])
        mark = np.zeros(len(whole) + 1, bool)
        mark[a_ends] = True
        b_common = mark[b_ends]
        common = b_ends[b_common]
        a_common = np.zeros(len(whole) + 1, bool)
        a_common[common] = True
        a_common = a_common[a_ends]
        # Group of every token, then its place among all tokens, A before B in each group.
        a_group, b_group = np.cumsum(a_common) - a_common, np.cumsum(b_common) - b_common
        b_until = np.append(0, np.flatnonzero(b_common) + 1)
        a_until = np.append(0, np.flatnonzero(a_common) + 1)
        a_place = np.arange(len(a)) + b_until[a_group]
        b_place = np.arange(len(b)) + a_until[b_group + 1]
        ids, ends = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        ids[a_place], ids[b_place] = a, b
        ends[a_place] = np.where(a_common, ord("|"), ord(","))
        ends[b_place] = np.where(b_common, ord(";"), ord(","))
        digits, width = decimals(ids, ends)
        until = np.append(0, np.cumsum(width))
        # The units' ends, as numbers of groups, tokens and digits.
        at = 2 + np.append(0, np.cumsum(list(map(len, raw))))
        group_at = np.searchsorted(common, at, side="right")
        a_at, b_at = np.searchsorted(a_ends, at, side="right"), np.searchsorted(b_ends, at, side="right")
        text_at = until[a_at + b_at].tolist()
        text = digits.decode()
        self.groups.extend([text[i:j - 1] for i, j in zip(text_at[:-1], text_at[1:], strict=True)])
        self._sizes.append(np.stack([np.diff(a_at), np.diff(b_at), np.diff(group_at)], axis=1))
        pairs = (a[a_common].astype(np.uint64) << np.uint64(32)) | b[b_common].astype(np.uint64)
        self._keys.append(pairs[group_at[0]:])

    def _same(self, raw: bytes, a, b) -> bool:
        return (b"".join(map(self.pair.a_bytes.__getitem__, a)) == raw
                and b"".join(map(self.pair.b_bytes.__getitem__, b)) == raw)

    def _add_one(self, unit: str) -> None:
        a, b = self.pair.encode(unit)
        good, out, keys = self._same(unit.encode(), a, b), [], []
        i = j = at_a = at_b = from_a = from_b = 0
        while good and i < len(a):
            at_a += len(self.pair.a_bytes[a[i]])
            i += 1
            while at_b < at_a:
                at_b += len(self.pair.b_bytes[b[j]])
                j += 1
            if at_a == at_b:
                out.append(f"{','.join(map(str, a[from_a:i]))}|{','.join(map(str, b[from_b:j]))}")
                keys.append(a[i - 1] << 32 | b[j - 1])
                from_a, from_b = i, j
        self.groups.append(";".join(out) if good else None)
        self.bad |= not good
        self._sizes.append(np.array([[len(a), len(b), len(keys)]], np.int64))
        self._keys.append(np.array(keys, np.uint64))

    def score(self, name: str, counts: dict[int, Counts]) -> np.ndarray:
        """Per unit how many of its links are best, the sum of their counts, and how many were
        not counted (units of other tables, or of documents that have no tokens)."""
        if self.scored_by != name:
            self.scores, self.scored_by = np.zeros((0, 3), np.int64), name
        done = len(self.scores)
        if done < len(self.groups):
            links = self.sizes[:, 2]
            keys = self.keys[links[:done].sum():]
            found, buckets = np.zeros((len(keys), 3), np.int64), bucket_of(keys)
            found[:, 2] = 1
            for b in np.unique(buckets):
                if int(b) in counts:
                    here, of = np.flatnonzero(buckets == b), counts[int(b)]
                    at = of.find(keys[here])
                    here, at = here[at >= 0], at[at >= 0]
                    found[here, 0], found[here, 1], found[here, 2] = of.best[at], of.counts[at], 0
            own = np.zeros((len(links) - done, 3), np.int64)
            np.add.at(own, np.repeat(np.arange(len(own)), links[done:]), found)
            self.scores = np.concatenate([self.scores, own])
        return self.scores


def _documents(texts: Iterator[str | None], aligned: Aligned, before_clear=None):
    """Numbers of the units of every text, None for texts without tokens, chunk by chunk."""

    def resolve(chunk: list[list[int] | None]):
        aligned.learn()
        for numbers in chunk:
            if aligned.bad and numbers is not None and None in map(aligned.groups.__getitem__, numbers):
                numbers = None
            yield numbers
        if len(aligned.met) > UNITS:
            if before_clear:
                before_clear()
            aligned.clear()

    chunk, size = [], 0
    for text in texts:
        chunk.append(aligned.pair.units(text, aligned.first, aligned.spaced) if text else None)
        size += len(text or "")
        if size >= CHUNK:
            yield from resolve(chunk)
            chunk, size = [], 0
    yield from resolve(chunk)


# Pairs and their counts ------------------------------------------------------------------------


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def bucket_of(keys: np.ndarray) -> np.ndarray:
    """All pairs of one B id share a bucket."""
    return (mix(keys & np.uint64(0xFFFFFFFF), 0) % np.uint64(BUCKETS)).astype(np.int64)


class PerfectHash:
    """Numbers 0..n-1 for n distinct keys: levels of bits, and ranks within them."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words = [], [np.zeros(0, np.uint64)]
        while len(keys):
            size = -(-max(64, len(keys) * 3 // 2) // 64) * 64
            at = mix(keys, len(sizes) + 1) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[at.astype(np.int64)]]
        return cls(sizes, np.concatenate(words))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of every key, -1 where no level holds it; a strange key may get any number."""
        out, left, first = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = mix(keys[left], level + 1) % np.uint64(size)
            word = (at >> np.uint64(6)).astype(np.int64) + first
            bit = np.uint64(1) << (at & np.uint64(63))
            there = (self.words[word] & bit) != 0
            hit = word[there]
            out[left[there]] = self.before[hit] + np.bitwise_count(self.words[hit] & (bit[there] - np.uint64(1)))
            left, first = left[~there], first + size // 64
        return out


class Counts:
    """One bucket's pairs by number: the pair, its count, whether it is its B id's highest."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(list(row["sizes"]), np.frombuffer(row["words"], np.uint64))
        self.keys = np.frombuffer(row["keys"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.best = np.frombuffer(row["best"], np.bool_)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 for those that were not counted."""
        at = self.hash.numbers(keys)
        at[at >= 0] = np.where(self.keys[at[at >= 0]] == keys[at >= 0], at[at >= 0], -1)
        return at


FOUND = "bucket long, slot long, keys binary, counts binary"
FOUND_ARROW = pa.schema([("bucket", pa.int64()), ("slot", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _count(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned, tally, total = Aligned.at(paths), np.zeros(0, np.int64), (np.zeros(0, np.uint64), np.zeros(0, np.int64))

        def flush() -> None:
            nonlocal tally, total
            times = np.zeros(len(aligned.groups), np.int64)
            times[:len(tally)] = tally
            each = np.repeat(times, aligned.sizes[:, 2])
            used = each > 0
            total = _summed(np.concatenate([total[0], aligned.keys[used]]), np.concatenate([total[1], each[used]]))
            tally = np.zeros(0, np.int64)

        texts = (t for batch in batches for t in batch.column("text").to_pylist())
        for numbers in _documents(texts, aligned, before_clear=flush):
            if numbers:
                if len(tally) < len(aligned.groups):
                    tally = np.append(tally, np.zeros(len(aligned.groups) - len(tally), np.int64))
                np.add.at(tally, numbers, 1)
        flush()
        keys, counts = total
        bucket, slot = bucket_of(keys), TaskContext.get().partitionId()
        out = [(int(b), slot, keys[bucket == b].tobytes(), counts[bucket == b].tobytes()) for b in np.unique(bucket)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), FOUND_ARROW, strict=True)], schema=FOUND_ARROW)

    return run


def _arrays(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _united(rows: pa.Table) -> pa.Table:
    """Distinct keys of several rows of one bucket; `FAN` of them at most, and no row of a
    bucket is longer than its distinct pairs."""
    keys = np.unique(np.concatenate(_arrays(rows.column("keys"), np.uint64)))
    return pa.table({"bucket": rows.column("bucket")[:1], "slot": rows.column("slot")[:1],
                     "keys": pa.array([keys.tobytes()], pa.binary())})


def _hashed(rows: pa.Table) -> pa.Table:
    keys = np.frombuffer(rows.column("keys")[0].as_py(), np.uint64)
    made = PerfectHash.build(keys)
    ordered = np.zeros_like(keys)
    ordered[made.numbers(keys)] = keys
    return pa.table({"bucket": rows.column("bucket"), "sizes": pa.array([made.sizes], pa.list_(pa.int64())),
                     "words": pa.array([made.words.tobytes()], pa.binary()),
                     "keys": pa.array([ordered.tobytes()], pa.binary())})


def _dense(rows: pa.Table, hashes: pa.Table) -> pa.Table:
    """The counts of several tasks as one vector, indexed by the bucket's hash."""
    made = PerfectHash(hashes.column("sizes")[0].as_py(), np.frombuffer(hashes.column("words")[0].as_py(), np.uint64))
    out = np.zeros(len(hashes.column("keys")[0].as_py()) // 8, np.int64)
    for keys, counts in zip(_arrays(rows.column("keys"), np.uint64), _arrays(rows.column("counts"), np.int64), strict=True):
        out[made.numbers(keys)] += counts
    return pa.table({"bucket": rows.column("bucket")[:1], "slot": rows.column("slot")[:1],
                     "counts": pa.array([out.tobytes()], pa.binary())})


def _added(rows: pa.Table) -> pa.Table:
    total = np.sum(_arrays(rows.column("counts"), np.int64), axis=0)
    return pa.table({"bucket": rows.column("bucket")[:1], "slot": rows.column("slot")[:1],
                     "counts": pa.array([total.tobytes()], pa.binary())})


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = []
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            b, n = np.frombuffer(keys, np.uint64) & np.uint64(0xFFFFFFFF), np.frombuffer(counts, np.int64)
            ids, place = np.unique(b, return_inverse=True)
            highest = np.zeros(len(ids), np.int64)
            np.maximum.at(highest, place, n)
            best.append((n == highest[place]).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.binary())],
                                         names=[*batch.schema.names, "best"])


def _fold(slots: int) -> DataFrame | int:
    return F.floor(F.col("slot") / FAN).cast("long") if slots > 1 else F.lit(0).cast("long")


def count_pairs(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(bucket, sizes, words, keys, counts, best) per bucket of B ids, see `Counts`."""
    found = cut_lineage(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count(paths), FOUND))
    tasks = (found.agg(F.max("slot")).first()[0] or 0) + 1
    keys, slots = found.select("bucket", "slot", "keys"), tasks
    while True:
        keys = keys.withColumn("slot", _fold(slots)).groupBy("bucket", "slot").applyInArrow(
            _united, "bucket long, slot long, keys binary")
        slots = -(-slots // FAN)
        if slots == 1:
            break
    hashes = cut_lineage(keys.groupBy("bucket").applyInArrow(
        _hashed, "bucket long, sizes array<long>, words binary, keys binary"))
    slots = -(-tasks // FAN)
    spread = hashes.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"))
    counts = found.withColumn("slot", _fold(tasks)).groupBy("bucket", "slot").cogroup(
        spread.groupBy("bucket", "slot")).applyInArrow(
        lambda rows, made: _dense(rows, made) if len(rows) else EMPTY, "bucket long, slot long, counts binary")
    while slots > 1:
        counts = counts.withColumn("slot", _fold(slots)).groupBy("bucket", "slot").applyInArrow(
            _added, "bucket long, slot long, counts binary")
        slots = -(-slots // FAN)
    return cut_lineage(hashes.join(counts.drop("slot"), "bucket").mapInArrow(
        _finished, "bucket long, sizes array<long>, words binary, keys binary, counts binary, best binary"))


EMPTY = pa.table({"bucket": pa.array([], pa.int64()), "slot": pa.array([], pa.int64()), "counts": pa.array([], pa.binary())})


def pair_counts(table_: DataFrame) -> DataFrame:
    """The counts as plain rows: a, b, links, best."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], np.uint64)
                counts, best = np.frombuffer(row["counts"], np.int64), np.frombuffer(row["best"], np.bool_)
                for at in range(0, len(keys), 1 << 17):
                    part = slice(at, at + (1 << 17))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((keys[part] >> np.uint64(32)).astype(np.int64)),
                         pa.array((keys[part] & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                         pa.array(counts[part]), pa.array(best[part])], names=["a", "b", "links", "best"])

    return table_.mapInArrow(rows, "a long, b long, links long, best boolean")


# Documents -------------------------------------------------------------------------------------

FACTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_LONGS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _align(paths: tuple[str, str], shared=None, whole: bool = False, pairs: bool = False):
    """Per document its facts; with the shared counts also n_best and count_sum. `whole` gives
    the groups themselves, `pairs` the document's distinct pairs and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = Aligned.at(paths)
        counts = {b: Counts(row) for b, row in shared.value.items()} if shared else {}
        name = uuid.uuid4().hex
        for batch in batches:
            out, sizes = [], np.zeros((0, 3), np.int64)
            texts = iter(batch.column("text").to_pylist())
            for doc_id, numbers in zip(batch.column("doc_id").to_pylist(), _documents(texts, aligned), strict=True):
                if not numbers:
                    out.append((doc_id, 0, 0, 0, 0, 0, 0, "", *([[], []] if pairs else [])))
                    continue
                if sizes is not aligned.sizes:
                    sizes = aligned.sizes
                    starts = np.append(0, np.cumsum(sizes[:, 2]))
                n_a, n_b, links = sizes[numbers].sum(axis=0).tolist()
                best = total = 0
                if shared:
                    best, total, strange = aligned.score(name, counts)[numbers].sum(axis=0).tolist()
                    if strange:
                        raise ValueError("a pair was not counted: the documents changed between the passes")
                groups = ";".join(map(aligned.groups.__getitem__, numbers))
                if not whole:
                    groups = hashlib.sha256(groups.encode()).hexdigest()
                row = (doc_id, n_a, n_b, links, links, best, total, groups)
                if pairs:
                    keys, times = np.unique(np.concatenate([aligned.keys[starts[i]:starts[i + 1]] for i in numbers]),
                                            return_counts=True)
                    row = (*row, keys.astype(np.int64), times)
                out.append(row)
            if out:
                columns = list(zip(*out, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.string())]
                arrays += [pa.array(c, pa.list_(pa.int64())) for c in columns[8:]]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=[*_LONGS, "groups_sha256", *(["keys", "times"] if pairs else [])])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def align(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, tokens of A and B, and the groups as `a1,a2|b1;a3|b2,b3` (empty without tokens)."""
    return _texts(docs).mapInArrow(_align(paths or (byte_bpe_path(), piece_bpe_path()), whole=True), FACTS).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("groups_sha256").alias("groups"))


def report(docs: DataFrame, paths: tuple[str, str] | None = None, lookup_pairs: int = LOOKUP_PAIRS) -> DataFrame:
    """Per document its tokens, groups and links, and how common the links are in the table."""
    paths = paths or (byte_bpe_path(), piece_bpe_path())
    counted = count_pairs(docs, paths)
    pairs = counted.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    if pairs <= lookup_pairs:
        rows = {r["bucket"]: {k: bytes(v) if k != "sizes" else list(v) for k, v in r.asDict().items() if k != "bucket"}
                for r in counted.collect()}
        return _texts(docs).mapInArrow(_align(paths, docs.sparkSession.sparkContext.broadcast(rows)), FACTS)
    each = cut_lineage(_texts(docs).mapInArrow(
        _align(paths, pairs=True), f"{FACTS}, keys array<long>, times array<long>").withColumn(
        "_row", F.monotonically_increasing_id()))
    key = F.shiftleft(F.col("a"), 32).bitwiseOR(F.col("b"))
    sums = each.select("_row", F.arrays_zip("keys", "times").alias("_pair")).select("_row", F.inline("_pair")).join(
        pair_counts(counted).select(key.alias("keys"), "links", "best"), "keys").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("times") * F.col("links")).alias("_sum"))
    return each.join(sums, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("_best", "n_best").alias("n_best"),
        F.coalesce("_sum", "count_sum").alias("count_sum"), "groups_sha256")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
