"""Toxic documents by gradient-boosted trees over dense features, calibrated isotonically.

Features of a whole text: densities, greatest weights and numbers of different words of three
lexicons (a short list of insults; words, and beginnings of words, that toxic labelled
documents hold far more often), how many of these stand near a second person, capitals,
exclamation and question marks, symbols, and disguised words (digits or signs inside, letters
drawn out or spelt one by one, lexicon words once the disguise is taken off), and the length.

Learning. A sample of the labelled documents that are not held out (all toxic ones up to
`TRAIN_ROWS` / 3, the rest clean, chosen by a hash of the id; one text per id) is dealt into
`FOLDS` folds. The lexicons come from counts of documents per term and fold, added up by Spark;
at most `TERMS` terms, those with the highest lower bound of their log odds ratio, reach the
driver. A document's features in training use a lexicon counted without its own fold, and the
margins that calibrate come from trees fitted without it, so neither sees its own labels. The
dense vectors of the sample are fitted on the driver; trees split at quantiles, leaves are
Newton steps. Calibration weighs the sample back to all labels. Scoring is one pass.

Defined cases: null and empty texts have no words and are scored like any other; a null doc_id
is not held out; several labels of a document count as the highest; texts of one id count once
in training (the smallest); without labels of both kinds every score is the share of toxic
labels (0 without any); repeated rows get equal scores; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table
from tallymart.session import cut_lineage

TRAIN_ROWS = 12_000
FOLDS = 4
TERMS = 4_000
LEAST_DOCS = 3  # toxic documents that hold a term
LEAST_ODDS = 0.7
NEAR = 5  # words
BEGINNINGS = (4, 5)
ROUNDS, DEPTH, RATE, BINS, LEAST_CURVE = 60, 3, 0.15, 32, 0.3

# Common insults, as words of the four languages.
INSULTS = frozenset("""
    idiot idiots moron morons stupid dumb loser losers scum trash pathetic disgusting worthless clown
    jerk fool bastard bitch cunt dick asshole shit fuck fucking retard retarded whore slut
    arschloch dummkopf trottel scheisse scheiße hure schlampe abschaum versager widerlich wichser
    imbécile crétin connard salope merde débile ordure abruti
    idiota imbécil estúpido estúpida basura mierda puta cabrón asqueroso inútil
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer
    tu toi te ton ta tes vous votre vos tú ti tus usted ustedes vosotros os
""".split())
EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…-–—*_~#/\\|"
DISGUISE = str.maketrans("013457@$!", "oieastasi", "*._-")
INNER = re.compile(r"[^\W\d_][\d@$*#!._+-]+[^\W\d_]")
DRAWN = re.compile(r"([^\W\d_])\1{2,}")
MARKS = re.compile(r"[!?]{2,}")
CAPITALS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&|<>@^~"


def core(token: str) -> str:
    return token.strip(EDGES).lower()


def terms(text: str | None) -> set[str]:
    """Words and marked beginnings of a text; each counts once per document."""
    words = {core(t) for t in (text or "").split()} - {""}
    return words | {f"{w[:k]}-" for w in words for k in BEGINNINGS if len(w) >= k}


class Features:
    """Dense features with one lexicon; remembers tokens while there is room."""

    NAMES = ("insults", "words", "heaviest_word", "different_words", "beginnings", "heaviest_beginning",
             "different_beginnings", "disguised", "hits", "second_person", "hits_near_second_person", "capital_words",
             "capitals", "marks", "runs_of_marks", "inner_signs", "drawn_out", "spelt", "symbols", "length")
    ROOM = 1 << 18

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.number: dict[str, int] = {}
        self.table = np.zeros((self.ROOM, 8), np.float32)

    def _new(self, token: str) -> int:
        word = core(token)
        weight = self.lexicon.get(word, 0.0)
        start = max([self.lexicon.get(f"{word[:k]}-", 0.0) for k in BEGINNINGS if len(word) >= k], default=0.0)
        insult, disguised = word in INSULTS, False
        if not (insult or weight):
            plain = DRAWN.sub(r"\1", word.translate(DISGUISE))
            disguised = plain != word and (plain in INSULTS or plain in self.lexicon)
        letters = [c for c in token if c.isalpha()]
        row = (insult, weight, start, disguised, word in SECOND_PERSON, len(letters) > 1 and all(c.isupper() for c in letters),
               INNER.search(token) is not None, DRAWN.search(word) is not None)
        number = self.number[token] = len(self.number)
        self.table[number] = row
        return number

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self.number) + len(tokens) > self.ROOM:
            fresh = set(tokens).difference(self.number)
            if len(self.number) + len(fresh) > self.ROOM:
                self.number.clear()
                if len(set(tokens)) > self.ROOM:  # one text with more words than the table has room for
                    self.table = np.zeros((2 * len(tokens), 8), np.float32)
        known = self.number
        return np.array([known[t] if t in known else self._new(t) for t in tokens], np.int64)

    def of(self, text: str | None) -> np.ndarray:
        text = text or ""
        tokens = text.split()
        n = max(1, len(tokens))
        raw = text.encode()
        at = self._numbers(tokens)
        rows = self.table[at]
        hit = (rows[:, 0] > 0) | (rows[:, 1] > 0) | (rows[:, 2] > 0) | (rows[:, 3] > 0)
        hits, you = np.flatnonzero(hit), np.flatnonzero(rows[:, 4])
        near = 0.0
        if len(hits) and len(you):
            place = np.searchsorted(you, hits)
            gap = np.minimum(np.abs(you[np.minimum(place, len(you) - 1)] - hits), np.abs(hits - you[np.maximum(place - 1, 0)]))
            near = float((gap <= NEAR).mean())
        single = np.fromiter((len(t) == 1 and t.isalpha() for t in tokens), bool, len(tokens))
        spelt = (single[:-2] & single[1:-1] & single[2:]).sum() if len(tokens) > 2 else 0
        per = 100 / n
        total = rows.sum(axis=0)
        greatest = rows.max(axis=0) if len(rows) else np.zeros(8)
        return np.array([
            total[0] * per, total[1] * per, greatest[1], len(np.unique(at[rows[:, 1] > 0])), total[2] * per, greatest[2],
            len(np.unique(at[rows[:, 2] > 0])), total[3] * per, len(hits) * per, total[4] * per, near, total[5] * per,
            (len(raw) - len(raw.translate(None, CAPITALS))) / max(1, len(raw)), (text.count("!") + text.count("?")) * per,
            len(MARKS.findall(text)) * per, total[6] * per, total[7] * per, spelt * per,
            (len(raw) - len(raw.translate(None, SYMBOLS))) / max(1, len(raw)), np.log2(n)], np.float32)


# Trees and calibration ---------------------------------------------------------------------------


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Trees:
    """Boosted trees of one depth; node i has the children 2i + 1 (not above) and 2i + 2."""

    base: float = 0.0
    grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in self.grown:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, d = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1)
        cell = binned + np.arange(d) * BINS
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(n, self.base)
        for _ in range(ROUNDS):
            p = sigmoid(margin)
            gradient, curve = y - p, p * (1 - p)
            feature, threshold = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
            node = np.zeros(n, np.int64)
            for level in range(DEPTH):
                first, width = 2**level - 1, 2**level
                at = ((node - first)[:, None] * (d * BINS) + cell).ravel()
                g, h = (np.bincount(at, np.repeat(v, d), width * d * BINS).reshape(width, d, BINS).cumsum(axis=2)
                        for v in (gradient, curve))
                all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
                gain = g**2 / (h + 1) + (all_g - g)**2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                gain = np.where((h >= LEAST_CURVE) & (all_h - h >= LEAST_CURVE), gain, 0)[:, :, :-1]
                for k in range(width):
                    j, b = np.unravel_index(gain[k].argmax(), gain[k].shape)
                    if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                        feature[first + k], threshold[first + k] = j, edges[j][b]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
            leaves = node - (2**DEPTH - 1)
            g, h = (np.bincount(leaves, v, 2**DEPTH) for v in (gradient, curve))
            leaf = RATE * g / (h + 1)
            self.grown.append((feature, threshold, leaf))
            margin += leaf[leaves]
        return self


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of the weighted share of y, as points between which one interpolates."""
    blocks: list[list[float]] = []  # first and last margin, weight, sum
    points, place = np.unique(margin, return_inverse=True)
    total, hit = np.bincount(place, weight), np.bincount(place, weight * y)
    for x, w, s in zip(points, total, hit, strict=True):
        blocks.append([x, x, w, s])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, last, w2, s2 = blocks.pop()
            blocks[-1][1] = last
            blocks[-1][2] += w2
            blocks[-1][3] += s2
    x = np.array([v for b in blocks for v in b[:2]])
    return x, np.repeat([b[3] / b[2] for b in blocks], 2)


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    trees: Trees | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None
    constant: float = 0.0  # without labels of both kinds

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        return np.clip(np.interp(self.trees.margin(x), *self.steps), 0, 1)


# Learning and scoring ----------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, truth: DataFrame, rows: int, counts: dict[int, int]) -> DataFrame:
    """One row per chosen labelled document: _id, toxic, fold, text."""
    share = {1: min(1.0, rows / 3 / max(1, counts[1]))}
    share[0] = min(1.0, (rows - share[1] * counts[1]) / max(1, counts[0]))
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_003))
    # About `rows` ids, far below any broadcast limit.
    chosen = truth.where(draw < F.when(F.col("toxic") == 1, round(1_000_003 * share[1])).otherwise(
        round(1_000_003 * share[0])))
    found = docs.select(F.col("doc_id").alias("_doc"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id", "toxic").agg(F.min("text").alias("text"))
    return cut_lineage(found.withColumn("fold", F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(FOLDS)).cast("int")))


def _term_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents per term, fold and label, added up before they leave the task."""
    found: Counter = Counter()

    def rows() -> pd.DataFrame:
        return pd.DataFrame([(t, k, n) for (t, k), n in found.items()], columns=["term", "cell", "docs"])

    for frame in frames:
        for text, fold, toxic in zip(frame["text"], frame["fold"], frame["toxic"], strict=True):
            cell = 2 * fold + toxic
            found.update((t, cell) for t in terms(text))
            if len(found) > 400_000:
                yield rows()
                found.clear()
    yield rows()


def _odds(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """Lower bound of the log odds ratio of a term."""
    ratio = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    return F.when(toxic >= LEAST_DOCS, ratio - 1.645 * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))).otherwise(-9.0)


def lexicons(sample: DataFrame, sizes: dict[tuple[int, int], int]) -> list[dict[str, float]]:
    """For every fold the weights counted without it, and at the end those of all."""
    cells = [(fold, toxic) for fold in range(FOLDS) for toxic in (0, 1)]
    counted = sample.mapInPandas(_term_counts, "term string, cell int, docs long").groupBy("term").agg(
        *[F.sum(F.when(F.col("cell") == 2 * f + t, F.col("docs")).otherwise(0)).alias(f"n{f}_{t}") for f, t in cells])
    weights = []
    for without in [*range(FOLDS), None]:
        folds = [f for f in range(FOLDS) if f != without]
        n = [sum(sizes.get((f, t), 0) for f in folds) for t in (0, 1)]
        weights.append(_odds(sum(F.col(f"n{f}_1") for f in folds), sum(F.col(f"n{f}_0") for f in folds), n[1], n[0]))
    ranked = counted.select("term", F.array(*weights).alias("w")).withColumn("best", F.array_max("w")).where(
        F.col("best") > LEAST_ODDS).orderBy(F.desc("best"), "term").limit(TERMS)
    rows = ranked.collect()
    return [{r["term"]: r["w"][k] for r in rows if r["w"][k] > LEAST_ODDS} for k in range(FOLDS + 1)]


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    truth = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").alias("_id")).agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).where(
        ~held_out(F.col("_id")))
    counts = {0: 0, 1: 0} | {r["toxic"]: r["count"] for r in truth.groupBy("toxic").count().collect()}
    share = counts[1] / max(1, counts[0] + counts[1])
    if not counts[0] or not counts[1]:
        return Model(constant=share)
    sample = _sample(docs, truth, rows, counts)
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    found = {t: sum(n for (_, x), n in sizes.items() if x == t) for t in (0, 1)}
    if not found[0] or not found[1]:
        return Model(constant=share)
    by_fold = lexicons(sample, sizes)

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        makers = [Features(x) for x in by_fold]
        for frame in frames:
            yield pd.DataFrame({"id": frame["_id"], "fold": frame["fold"], "toxic": frame["toxic"], "x": [
                makers[f].of(t).tolist() for t, f in zip(frame["text"], frame["fold"], strict=True)]})

    # At most about `rows` rows of len(Features.NAMES) numbers.
    dense = sample.mapInPandas(vectors, "id long, fold int, toxic int, x array<double>").toPandas().sort_values(
        "id", kind="stable", ignore_index=True)
    x, y = np.array(dense["x"].tolist(), np.float32), dense["toxic"].to_numpy(float)
    fold = dense["fold"].to_numpy()
    margin = np.zeros(len(y))
    for f in range(FOLDS):
        own = fold == f
        rest = y[~own]
        if own.any() and len(rest):
            margin[own] = Trees().fit(x[~own], rest).margin(x[own])
    weight = np.where(y == 1, counts[1] / found[1], counts[0] / found[0])
    return Model(by_fold[-1], Trees().fit(x, y), isotonic(margin, y, weight))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TERMS terms and ROUNDS trees

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(shared.value.lexicon)
        for frame in frames:
            for a in range(0, len(frame), 512):
                part = frame.iloc[a:a + 512]
                found = shared.value.score(np.stack([features.of(t) for t in part["text"]]))
                yield part[["doc_id", "held_out"]].assign(score=found, predicted=(found >= 0.5).astype("int32"))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, held_out boolean, score double, predicted int")


def op11_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
