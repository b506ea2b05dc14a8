"""Similarity join on word 5-grams by vertical partitioning.

1. Documents become sets of hashed 5-grams. Blocks learn which of their hashes
   occur in a second document, and roughly in how many blocks (`exchange.find_shared`).
   A document with Jaccard 0.8 to another shares at least four fifths of its set;
   all others are done.
2. The remaining documents with one set form one node. A node's set is cut along
   the order of hashes into `FRAGMENTS` fragments; pairs are counted fragment by
   fragment (`array_intersect`) and the partial overlaps are summed.
3. Candidates come from prefixes: with the grams of all sets in one order, rare
   ones first, two sets with Jaccard 0.8 share one of the n - ceil(0.8 n) + 1 first
   grams of each, at places that leave room for the overlap they need. Nodes that
   share such a gram are a group; a group is not expanded into pairs. Its pivot, the
   node with the fewest rarer grams and so the nearest to what the group has in
   common, is compared with all others of a different component and leaves the group; groups with one component are done. After `ROUNDS` of that, or as many
   as it takes, the pairs of different components whose sizes and places still leave
   room are few, and are compared at once. Every pair that could link two components
   is compared, so components are exact.

Defined cases: null or blank text has no grams, is linked with nothing and is its
own component; with fewer than five words the whole sequence is one gram; a null
doc_id takes part, and a component is named by its smallest doc_id that is not
null (null if all are); repeated rows fall into one component; an empty table
gives an empty result; further columns are ignored. Grams are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import blocks as B
from tallymart.llm.exchange import find_shared
from tallymart.llm.text import table
from tallymart.session import cut_lineage

GRAM = 5
PERCENT = 80
FRAGMENTS = 4
FEW = 8  # pairs per node that may be compared at once
ROUNDS = 1  # of pivots at least
LEAST_TASKS = 8
LEVELS = {10: 2, 11: 4, 12: 8, 13: 16, 14: 32, 15: 64}  # answer kind to blocks: how frequent a gram is


class _Hashes(dict):
    """Word to 64-bit hash; forgets everything when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _Hashes()


def grams(text: bytes, gram: int = GRAM) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a lower-cased text."""
    words = text.lower().split()  # ASCII letters only; split at space and \t to \r
    if not words:
        return np.zeros(0, np.uint64)
    at = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(gram, len(at))
    out = at[:len(at) - width + 1].copy()
    for k in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += at[k:k + len(out)]
    # A short sequence must not meet the grams of longer ones.
    return np.unique(B.mix(out + np.uint64(width)))


def _sets(block: B.Block, gram: int) -> tuple[list[np.ndarray], B.Runs]:
    sets = [grams(t, gram) for t in block.texts]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    doc = np.repeat(np.arange(len(sets)), size)
    return sets, B.Runs(doc, np.zeros(len(flat), np.int64), np.ones(len(flat), np.int64), flat)


def _frequencies(runs: B.Runs, marks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Per gram of a block whether it is shared, and how many levels it exceeds."""
    hashes, place = np.unique(runs.hash, return_inverse=True)
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    shared = B.bits_of(marks, B.SHARED)
    above = shared.astype(np.int64) + sum(B.bits_of(marks, kind) for kind in LEVELS)
    return shared[place], above[place]


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


SENT = ("doc_id long, text_hash long, n long, node long, prefix array<long>, parts array<array<long>>")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    cut = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(flat))


def describe(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """Per document the hash of its text, its set size and node; prefix and fragments for one document of each
    candidate set of a block."""
    blocks, layout = B.write_blocks(docs)
    shared = find_shared(blocks, lambda block: _sets(block, gram)[1], layout, layout.buckets(0.6), LEVELS)

    def run(rows: pa.Table, marks: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"doc_id": [], "text_hash": [], "n": [], "node": [], "prefix": [], "parts": []})
        block = B.Block(rows)
        sets, runs = _sets(block, gram)
        common, rarity = _frequencies(runs, marks)
        cut = np.cumsum([0, *map(len, sets)])
        held = np.bincount(runs.doc, common, len(sets)).astype(np.int64)
        edges = B.bounds(FRAGMENTS)
        nodes, seen, prefix, parts, empty = [], set(), [], [], np.zeros(0, np.uint64)
        candidate = []
        for i, (s, k) in enumerate(zip(sets, held.tolist(), strict=True)):
            node = np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64) if len(s) else None
            keep = len(s) > 0 and 100 * k >= percent * len(s) and node not in seen
            if keep:
                seen.add(node)
            nodes.append(None if node is None else int(node))
            candidate.append(keep)
            first = np.argsort(rarity[cut[i]:cut[i + 1]], kind="stable")[:_prefix(len(s), percent)]
            prefix.append(s[first] if keep else empty)
            cuts = np.searchsorted(s, edges) if keep else []
            parts += np.split(s, cuts) if keep else []
        groups = np.cumsum([0, *[FRAGMENTS if c else 0 for c in candidate]]).astype(np.int32)
        inner = _lists(parts)
        missing = pa.array([not c for c in candidate])
        hashes = np.array([xxhash.xxh64_intdigest(t, 42) for t in block.texts], np.uint64)  # as Spark's xxhash64
        return pa.Table.from_arrays([
            pa.array(block.doc_ids, pa.int64()), pa.array(hashes.view(np.int64)), pa.array([len(s) for s in sets], pa.int64()),
            pa.array(nodes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, prefix)]).astype(np.int32)),
                                     pa.array(np.concatenate([*prefix, empty]).view(np.int64)), mask=missing),
            pa.ListArray.from_arrays(pa.array(groups), inner, mask=missing)],
            names=["doc_id", "text_hash", "n", "node", "prefix", "parts"])

    return cut_lineage(blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(run, SENT))


def _room(a: str, b: str, percent: int) -> Column:
    """Whether two sets that first meet at these places of their orders can reach `percent`."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    most = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (100 * small >= percent * large) & (most * (100 + percent) >= n * percent)


def verify(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Those of the (a, b, na, nb) whose overlap, summed over the fragments, is enough."""
    left = pairs.join(parts.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("gb")), "b")
    both = left.join(parts.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("ga")),
                     ["a", "fragment"])
    overlap = both.groupBy("a", "b", "na", "nb").agg(
        F.sum(F.size(F.array_intersect("ga", "gb"))).alias("common"))
    union = F.col("na") + F.col("nb") - F.col("common")
    return overlap.where(100 * F.col("common") >= percent * union).select("a", "b")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the links (a, b); a component is its smallest node.

    Alternates large-star and small-star steps until the links form stars. The tables
    joined on a node are written, so that a node with very many links can be split.
    """
    links = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"))
    # Two numbers a row: a task for every half million, however many the session has.
    tasks = max(LEAST_TASKS, links.count() // 500_000)

    def written(df: DataFrame) -> DataFrame:
        return cut_lineage(df.coalesce(tasks))

    edges = written(links.distinct())
    before = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")))
        large = written(both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")))
        least = written(large.groupBy("u").agg(F.min("v").alias("m")))
        edges = written(large.join(least, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct())
        after = _digest(edges)
        if after == before:
            break
        before = after
    return written(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("c", F.col("node"))
    return members.join(labels, "node", "left").withColumn(
        "c", F.coalesce("component", "node")).drop("component")


def _roomy(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) of different components that meet in a group with room enough.

    Of such a pair one node stands within (100 - p) / (100 + p) of its order, and the
    sizes lie in neighbouring bands, which the join uses as keys.
    """
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(101.0 / percent))).cast("int")
    light = members.where((100 + percent) * F.col("at") <= (100 - percent) * F.col("n"))
    x = light.select("*", F.explode(F.array(band - 1, band, band + 1)).alias("band")).alias("x")
    y = members.select(*[F.col(c).alias(c) for c in members.columns], band.alias("band")).alias("y")
    met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.band") == F.col("y.band"))
                 & (F.col("x.c") != F.col("y.c")) & _room("x", "y", percent))
    swap = F.col("x.node") < F.col("y.node")
    return met.select(
        F.when(swap, F.col("x.node")).otherwise(F.col("y.node")).alias("a"),
        F.when(swap, F.col("y.node")).otherwise(F.col("x.node")).alias("b"),
        F.when(swap, F.col("x.n")).otherwise(F.col("y.n")).alias("na"),
        F.when(swap, F.col("y.n")).otherwise(F.col("x.n")).alias("nb")).distinct()


def link_nodes(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) for every node (node, n, prefix, parts) that is linked with another."""
    parts = cut_lineage(nodes.select("node", F.posexplode("parts").alias("fragment", "grams")))
    total = max(1, nodes.count())
    first = cut_lineage(nodes.select("node", "n", F.posexplode("prefix").alias("at", "gram")))
    several = cut_lineage(first.groupBy("gram").agg(F.count("*").alias("held")).where("held > 1").select("gram"))
    groups = first.join(several, "gram")
    labels, last, turn = None, False, 0
    while not last:
        members = cut_lineage(_labelled(groups, labels))
        # One row per group: its pivot, and whether components differ.
        pivots = cut_lineage(members.groupBy("gram").agg(
            F.min(F.struct("at", "n", "node", "c")).alias("p"), F.min("c").alias("low"),
            F.max("c").alias("high")).where("low <> high").select("gram", "p"))
        if pivots.isEmpty():
            break
        last = turn >= ROUNDS and _roomy(members, percent).count() <= FEW * total
        turn += 1
        if last:
            pairs = _roomy(members, percent)
        else:
            x, y = members.alias("x"), pivots.select("gram", "p.*").alias("y")
            pairs = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.c") != F.col("y.c"))
                           & _room("x", "y", percent)).select(
                F.col("y.node").alias("a"), F.col("x.node").alias("b"),
                F.col("y.n").alias("na"), F.col("x.n").alias("nb")).distinct()
            rest = members.drop("c").join(pivots.select("gram", F.col("p.node").alias("pivot")), "gram")
            groups = rest.where("node <> pivot").drop("pivot")
        found = cut_lineage(verify(cut_lineage(pairs), parts, percent))
        if not found.isEmpty():
            known = found if labels is None else found.unionByName(
                labels.select(F.col("component").alias("a"), F.col("node").alias("b")))
            labels = components(known)
    if labels is None:
        return nodes.sparkSession.createDataFrame([], "node long, component long")
    return labels


def _components(docs: DataFrame, gram: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n and c, the key of the component (null without grams), of every document."""
    sent = describe(docs, gram, percent)
    nodes = cut_lineage(sent.where(F.col("prefix").isNotNull()).groupBy("node").agg(
        F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("parts").alias("parts")))
    labels = link_nodes(nodes, percent)
    return cut_lineage(sent.select("doc_id", "text_hash", "n", "node").join(labels, "node", "left").select(
        "doc_id", "text_hash", "n", F.coalesce("component", "node").alias("c")))


def label(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    rows = _components(docs, gram, percent)
    least = cut_lineage(rows.where(F.col("c").isNotNull()).groupBy("c").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("held")).where("held > 1").select(
            "c", "component_id"))
    return rows.join(least, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(
            F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """One row of `docs` per component: that of the smallest doc_id, unchanged.

    Rows are told apart by id and text: of equal ids the smaller hash of the text
    stays, rows without an id come last, and rows equal in both are reduced to one.
    Rows without grams are components of their own; equal ones with an id are reduced too.
    """
    cells = _components(docs, gram, percent).groupBy("c", "doc_id", "text_hash").agg(F.count("*").alias("_rows"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "_rows")).alias("k")
    linked = cells.where("c IS NOT NULL").groupBy("c").agg(best).select("k.doc_id", "k.text_hash", "k._rows")
    alone = cells.where("c IS NULL").select(
        "doc_id", "text_hash", F.when(F.col("doc_id").isNull(), 1).otherwise(F.col("_rows")).alias("_rows"))
    kept = cut_lineage(linked.unionByName(alone).select(
        F.col("doc_id").alias("_kept"), F.col("text_hash").alias("_hash"), "_rows"))
    rows = docs.select(F.struct("*").alias("_row"))
    text = F.coalesce(F.col("_row.text").cast("string"), F.lit(""))
    out = rows.join(kept, F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_kept"))
                    & (F.xxhash64(text) == F.col("_hash")))
    if kept.where("_rows > 1").isEmpty():
        return out.select("_row.*")
    # Only repeated rows are grouped.
    return out.where("_rows = 1").select("_row").unionByName(out.where("_rows > 1").groupBy(
        "_kept", "_hash").agg(F.min("_row").alias("_row")).select("_row")).select("_row.*")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+{GRAM - 1}], ' ') AS s
  FROM d, unnest(range(1, greatest(1, len(w) - {GRAM - 1}) + 1)) t(i) WHERE len(w) > 0
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)
), r AS (
  SELECT a AS doc_id, a AS seen FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(f, doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(seen) AS f FROM r GROUP BY doc_id) USING (doc_id)
"""
