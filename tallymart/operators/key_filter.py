"""Which parts of a table may hold a key, told without reading the table.

Every part gets a Bloom filter of its keys, `BITS` bits a key. The filter of a large part is
cut into segments by the hash of the key, so that none is larger than `SEGMENT_KEYS` keys
need, and built by as many tasks. Looking up tests the hashed keys of a batch against every
segment; a part that fails cannot hold any of them. A batch of more than `MOST_KEYS` keys is
not worth testing: with so many, every part passes by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
PROBES = 8  # about one key in 20,000 passes by chance
SEGMENT_KEYS = 250_000
MOST_KEYS = 2_000_000  # 16 MB of hashes
FILTER = "part string, segments long, segment long, bits binary"
_ARROW = pa.schema([("part", pa.string()), ("segments", pa.int64()), ("segment", pa.int64()), ("bits", pa.binary())])


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _place(hashes: np.ndarray, probe: int, size: int) -> np.ndarray:
    """The bit that each hashed key has at a probe in a filter of `size` bits."""
    mixed = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first, step = mixed >> np.uint64(32), (mixed & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((first + np.uint64(probe) * step) % np.uint64(size)).astype(np.int64)


def build_filters(rows: DataFrame, keys: list[str], part: Column) -> DataFrame:
    """(part, segments, segment, bits) of all parts of `rows`."""
    hashed = rows.select(part.cast("string").alias("part"), key_hash(keys).alias("hash"))
    # One row per part. Repeated keys count here, which makes a filter larger, not wrong.
    sizes = hashed.groupBy("part").agg(
        F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.count("*") / SEGMENT_KEYS, F.lit(1.0))))).cast("long")
        .alias("segments"))
    spread = hashed.distinct().join(F.broadcast(sizes), "part").withColumn(
        "segment", F.pmod(F.col("hash"), F.col("segments")))

    def fill(group: pa.Table) -> pa.Table:
        hashes = group.column("hash").to_numpy()
        marks = np.zeros(-(-max(64, len(hashes) * BITS) // 64) * 64, bool)
        for probe in range(PROBES):
            marks[_place(hashes, probe, len(marks))] = True
        return pa.Table.from_arrays(
            [group.column(c).slice(0, 1) for c in ("part", "segments", "segment")]
            + [pa.array([np.packbits(marks).tobytes()], pa.binary())], schema=_ARROW)

    return spread.groupBy("part", "segments", "segment").applyInArrow(fill, FILTER)


def parts_that_may_hold(filters: DataFrame, changed: DataFrame, keys: list[str]) -> set[str] | None:
    """Parts whose filter lets a key of `changed` pass; None where testing is not worth it."""
    rows = changed.select(key_hash(keys).alias("hash")).distinct().limit(MOST_KEYS + 1).toArrow()
    if len(rows) > MOST_KEYS:
        return None
    shared = filters.sparkSession.sparkContext.broadcast(np.sort(rows.column("hash").to_numpy()))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for row in batch.to_pylist():
                hashes = shared.value
                hashes = hashes[hashes % row["segments"] == row["segment"]]  # both signs: as pmod
                bits = np.frombuffer(row["bits"], np.uint8)
                for probe in range(PROBES):
                    at = _place(hashes, probe, 8 * len(bits))
                    hashes = hashes[(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
                if len(hashes):
                    passed.append(row["part"])
            yield pa.RecordBatch.from_arrays([pa.array(passed, pa.string())], names=["part"])

    return {r["part"] for r in filters.mapInArrow(test, "part string").distinct().collect()}
