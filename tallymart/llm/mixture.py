"""Mixing sources to target weights by fitting each source's budget exactly.

Sources in code point order (null last) get the weights 5, 2, 1, repeating. All
words together are dealt out by weight; no target exceeds `most` times its
source's size, and what a capped source cannot use goes to the others by
weight. That is target = min(most * size, level * weight) for one level, which
a few aggregations over the table of sources find.

Inside a source the budget is met in three steps on its histogram of exact
document lengths (one row per distinct length, never the documents): whole
copies of the source, then the same fraction of every length, then the
remaining words by greedy rounding and a bounded-knapsack dynamic programme
(`subset_sum`), which finds the counts per length that come nearest from below.
Greedy rounding leaves the programme the last `DP_WORDS` words, or as many more
as the shortest remaining document asks for; where even that one is longer than
`DP_WORDS`, at most one more fits, and the longest that does is taken. So a
target is missed by at most half of the shortest remaining document. Which
documents of a length are used is decided by a seeded hash of their id. Counts per length are split over `SALTS` hash ranges, so a length
that a third of all documents share is picked in as many tasks.

Defined cases: null or blank text has size 0 and takes nothing; null sources
are one source; repeated rows are picked one by one; sources without a word get
target 0; an empty table gives an empty result. Only doc_id, text and source
are read; `mix_documents` returns all columns whatever their names. Equal
doc_ids with equal sizes are told apart arbitrarily, which changes no value of
the result taken as a set of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.text import table, words
from tallymart.operators.ranking import global_index
from tallymart.session import cut_lineage

WEIGHTS = (5, 2, 1)
MOST = 3
SALTS = 64
SEED = 20_240_601
DP_WORDS = 1 << 18  # words that greedy rounding leaves to the dynamic programme


def subset_sum(lengths: list[int], counts: list[int], budget: int) -> dict[int, int]:
    """Counts per length whose total is the largest reachable one up to `budget`.

    Reachable totals are the bits of one integer; every total remembers the
    bundle that first reached it, which is enough to walk back.
    """
    reach, mask = 1, (1 << (budget + 1)) - 1
    bundles: list[tuple[int, int]] = []
    first = np.zeros(budget + 1, dtype=np.int64)
    for length, count in zip(lengths, counts, strict=True):
        if not 0 < length <= budget:
            continue
        count, piece = min(count, budget // length), 1
        while count > 0:
            used = min(piece, count)
            fresh = (reach << (length * used)) & mask & ~reach
            reach |= fresh
            bits = np.frombuffer(fresh.to_bytes(budget // 8 + 1, "little"), dtype=np.uint8)
            first[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(bundles)
            bundles.append((length, used))
            count, piece = count - used, piece * 2
            if reach >> budget & 1:
                count = 0
        if reach >> budget & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    while total:
        length, used = bundles[first[total]]
        taken[length] = taken.get(length, 0) + used
        total -= length * used
    return taken


def fit_source(sizes: list[int], counts: list[int], target: int) -> tuple[int, list[int]]:
    """Whole copies of a source, and how many more documents of each length."""
    whole = sum(s * c for s, c in zip(sizes, counts, strict=True))
    if whole == 0:
        return 0, [0] * len(sizes)
    copies, budget = divmod(target, whole)
    take = [c * budget // whole for c in counts]
    rest = budget - sum(s * t for s, t in zip(sizes, take, strict=True))
    part = [(c * budget % whole, s, i) for i, (s, c) in enumerate(zip(sizes, counts, strict=True))]
    for _, size, i in sorted(part, reverse=True):
        if 0 < size <= rest - DP_WORDS and take[i] < counts[i]:
            more = min(counts[i] - take[i], (rest - DP_WORDS) // size)
            take[i], rest = take[i] + more, rest - more * size
    order = [i for _, _, i in sorted(part, reverse=True)]
    left = [sizes[i] for i in order if sizes[i] and take[i] < counts[i]]
    if min(left, default=0) > DP_WORDS:  # rest < DP_WORDS + shortest < 2 * shortest: one more at most
        best = {s: 1 for s in [max((s for s in left if s <= rest), default=0)] if s}
    else:  # rest <= DP_WORDS, or rest < DP_WORDS + shortest <= 2 * DP_WORDS
        best = subset_sum([sizes[i] for i in order], [counts[i] - take[i] for i in order], rest)
    place = {s: i for i, s in enumerate(sizes)}
    for size, more in best.items():
        take[place[size]] += more
        rest -= size * more
    # Where the last words cannot be met from below, one document may come nearer from above.
    over = [s for s, c, t in zip(sizes, counts, take, strict=True) if t < c and rest < s < 2 * rest]
    if over:
        take[place[min(over)]] += 1
    return copies, take


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("_size")
    sizes, counts = group["_size"].tolist(), group["_n"].tolist()
    copies, take = fit_source(sizes, counts, round(float(group["_target"].iloc[0])))
    return group[["_none", "_src", "_size"]].assign(_copies=copies, _take=take)


def _keys(source: Column) -> list[Column]:
    return [source.isNull().alias("_none"),
            F.coalesce(source.cast("string"), F.lit("")).alias("_src")]


def _rank(doc_id: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id)


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """Adds `_target` to one row per source (_none, _src, _whole)."""
    at = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                      (F.col("_index") % len(WEIGHTS) + 1).cast("int"))
    weighed = cut_lineage(global_index(sizes, [F.col("_none"), F.col("_src")], "_index")
                          .withColumn("_weight", at).drop("_index"))
    cap = F.col("_whole") * float(most)
    level, capped = 0.0, -1
    while True:
        full = cap <= F.lit(level) * F.col("_weight")
        row = weighed.agg(
            F.sum("_whole").alias("all"), F.count_if(full).alias("n"),
            F.sum(F.when(full, cap).otherwise(0.0)).alias("kept"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("weight")).first()
        if row["n"] == capped or not row["weight"]:
            break
        level, capped = (row["all"] - row["kept"]) / row["weight"], row["n"]
    return weighed.withColumn("_target", F.least(cap, F.lit(level) * F.col("_weight"))).drop("_weight")


def plan(narrow: DataFrame, most: int = MOST, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Per source its target; per (source, length, salt) the copies and documents to take.

    `narrow`: rows of _none, _src, _size, _salt.
    """
    cells = cut_lineage(narrow.groupBy("_none", "_src", "_size", "_salt").agg(F.count("*").alias("_n")))
    lengths = cells.groupBy("_none", "_src", "_size").agg(F.sum("_n").alias("_n"))
    sources = lengths.groupBy("_none", "_src").agg(
        F.sum(F.col("_size") * F.col("_n")).alias("_whole"))
    aims = cut_lineage(targets(sources, most))
    # One row per distinct length of a source: bounded by its longest document, not by its size.
    fitted = lengths.join(aims, ["_none", "_src"]).groupBy("_none", "_src").applyInPandas(
        _fit, "_none boolean, _src string, _size long, _copies long, _take long")
    by_salt = Window.partitionBy("_none", "_src", "_size").orderBy("_salt")
    total = F.sum("_n").over(Window.partitionBy("_none", "_src", "_size"))
    upto = F.sum("_n").over(by_salt)
    spread = cells.withColumn("_all", total).withColumn("_upto", upto).join(
        fitted, ["_none", "_src", "_size"])
    part = "CAST(floor(CAST(_upto{0} AS DECIMAL(19, 0)) * _take / _all) AS BIGINT)"
    cut = cut_lineage(spread.withColumn(
        "_take", F.expr(part.format("") + " - " + part.format(" - _n")))
        .select("_none", "_src", "_size", "_salt", "_copies", "_take"))
    return aims, cut


def _narrow(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    rank = _rank(F.col("doc_id"), seed)
    return docs.select(
        *_keys(F.col("source")), F.size(words(F.col("text"))).cast("long").alias("_size"),
        F.pmod(rank, F.lit(SALTS)).cast("int").alias("_salt"), rank.alias("_rank"), *more)


def _copies(rows: DataFrame, cells: DataFrame, doc_id: Column) -> DataFrame:
    keys = ["_none", "_src", "_size", "_salt"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_rank", doc_id))
    return rows.join(cells, keys).withColumn(
        "_copies", F.col("_copies") + F.when(place <= F.col("_take"), 1).otherwise(0))


def mix_report(docs: DataFrame, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words taken."""
    narrow = cut_lineage(_narrow(docs, seed, F.col("doc_id")))
    aims, cells = plan(narrow, most, seed)
    return _copies(narrow, cells, F.col("doc_id")).join(aims, ["_none", "_src"]).select(
        "doc_id", F.when(~F.col("_none"), F.col("_src")).alias("source"),
        F.col("_size").alias("size"), F.col("_whole").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


def mix_documents(docs: DataFrame, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    _, cells = plan(cut_lineage(_narrow(docs, seed).drop("_rank")), most, seed)
    rows = docs.select(F.struct("*").alias("_row"))
    rows = rows.select("_row", "_row.doc_id", "_row.text", "_row.source")
    placed = _copies(_narrow(rows, seed, F.col("_row")), cells, F.col("_row.doc_id"))
    return placed.where("_copies > 0").select(
        "_row", F.explode(F.expr("sequence(1L, _copies)"))).select("_row.*")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))
