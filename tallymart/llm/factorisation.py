"""A factorisation machine that tells good documents from bad ones.

score = sigmoid(w0 + sum w_i x_i + sum over pairs i < j of <v_i, v_j> x_i x_j)

The pairwise part costs linear time: it is half of, summed over the factors f,
(sum v_if x_i)^2 - sum (v_if x_i)^2. Features are hashed words (share of the
document's words), structure statistics (shares of symbols, capitals, digits,
marks, repeated words, repeated lines, ...) and the length as metadata, each
statistic as one of sixteen bins. Labels, language, source and id are no inputs.

Training reads a sample of the labelled rows, `TRAIN_ROWS` expected (a hash of
the id below a threshold), held out rows excluded; features are extracted on the
executors and only sparse vectors of at most `HASHED` entries reach the driver.
Scoring is one pass over all whole texts.

Defined cases: null or empty text has no words and is scored by its statistics;
a null doc_id counts as not held out; several labels of a document count as the
lowest; without labels of both kinds the score is the share of good labels (0.5
without any); repeated rows get equal scores; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table

HASHED = 1 << 15
BINS = 16
STATS = 12
WIDTH = HASHED + STATS * BINS
FACTORS = 8
TRAIN_ROWS = 8_000
EPOCHS = 10
SEED = 5
BATCH = 64


class _Buckets(dict):
    """Word to bucket; forgets everything when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = zlib.crc32(word.lower()) & (HASHED - 1)
        return found


_BUCKETS = _Buckets()


def _bin(share: float) -> int:
    """0 for none, then one bin per halving of the share."""
    return 0 if share <= 0 else max(1, BINS - 1 - int(min(13.9, -np.log2(min(share, 1.0)))))


def _statistics(raw: bytes, words: list[bytes], counts: np.ndarray) -> list[int]:
    size, n = max(1, len(raw)), max(1, len(words))

    def without(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size

    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        _bin(without(b"#*$%&|<>")), _bin(without(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        _bin(without(b"0123456789")), _bin(without(b"!?")), _bin(without(b"|")),
        _bin(without(b".,;:")), _bin(without(bytes(range(128, 256)))),
        _bin(1 - len(counts) / n), _bin(counts.max() / n if len(counts) else 0.0),
        _bin(1 - len(set(lines)) / max(1, len(lines))),
        min(BINS - 1, int(size / n)), min(BINS - 1, int(np.log2(n + 1))),
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one document."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split at exactly space and \t to \r
    at, counts = np.unique(np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words)),
                           return_counts=True)
    stats = HASHED + np.arange(STATS) * BINS + np.array(_statistics(raw, words, counts))
    values = np.concatenate([np.sqrt(counts / max(1, len(words))), np.full(STATS, 0.5)])
    return np.concatenate([at, stats]).astype(np.int32), values.astype(np.float32)


def _sums(w: np.ndarray, v: np.ndarray, docs: list) -> tuple:
    at = np.concatenate([a for a, _ in docs])
    x = np.concatenate([x for _, x in docs])
    starts = np.cumsum([0, *[len(a) for a, _ in docs[:-1]]])
    vx = v[at] * x[:, None]
    total = np.add.reduceat(vx, starts, axis=0)
    square = np.add.reduceat(vx * vx, starts, axis=0)
    linear = np.add.reduceat(w[at] * x, starts)
    return at, x, starts, vx, total, linear + 0.5 * (total * total - square).sum(axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Machine:
    def __init__(self, prior: float = 0.0):
        rng = np.random.default_rng(SEED)
        self.w0 = prior
        self.w = np.zeros(WIDTH, np.float32)
        self.v = (rng.standard_normal((WIDTH, FACTORS)) * 0.02).astype(np.float32)
        self.constant = False

    def score(self, docs: list) -> np.ndarray:
        if self.constant:
            return np.full(len(docs), float(_sigmoid(np.array(self.w0))))
        return _sigmoid(self.w0 + _sums(self.w, self.v, docs)[-1])

    def fit(self, docs: list, good: np.ndarray, rate: float = 0.1, decay: float = 1e-4) -> Machine:
        """Logistic loss by Adagrad over seeded shuffles."""
        rng = np.random.default_rng(SEED + 1)
        gw, gv, g0 = np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, FACTORS), 1e-6, np.float32), 1e-6
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for a in range(0, len(docs), BATCH):
                rows = order[a:a + BATCH]
                at, x, starts, vx, total, z = _sums(self.w, self.v, [docs[i] for i in rows])
                error = (_sigmoid(self.w0 + z) - good[rows]).astype(np.float32)
                each = np.repeat(error, np.diff([*starts, len(at)]))
                wide = np.repeat(total, np.diff([*starts, len(at)]), axis=0)
                used, place = np.unique(at, return_inverse=True)
                dw = np.bincount(place, each * x, len(used)).astype(np.float32)
                dv = np.zeros((len(used), FACTORS), np.float32)
                np.add.at(dv, place, (each * x)[:, None] * (wide - vx))
                dw, dv = dw / len(rows) + decay * self.w[used], dv / len(rows) + decay * self.v[used]
                d0 = float(error.mean())
                gw[used] += dw * dw
                gv[used] += dv * dv
                g0 += d0 * d0
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * 0.5 * dv / np.sqrt(gv[used])
                self.w0 -= rate * d0 / g0 ** 0.5
        return self


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [features(t) for t in frame["text"]]
        yield pd.DataFrame({"doc_id": frame["doc_id"], "good": frame["good"],
                            "at": [a for a, _ in found], "x": [x for _, x in found]})


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Fits on about `rows` labelled documents that are not held out."""
    truth = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").alias("_id")).agg(F.min("quality").alias("good")).where(~held_out(F.col("_id")))
    counts = truth.agg(F.count("*").alias("n"), F.sum("good").alias("good")).first()
    n, good = counts["n"], counts["good"] or 0
    share = min(max(good / n, 1e-3), 1 - 1e-3) if n else 0.5
    machine = Machine(float(np.log(share / (1 - share))))
    if not 0 < good < n:
        machine.constant = True
        return machine
    # About `rows` ids, so this side stays far below any broadcast limit.
    chosen = truth.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < round(1_000_003 * min(1.0, rows / n)))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select(
        "doc_id", "text", F.col("good").cast("int").alias("good")).mapInPandas(
        _extract, "doc_id long, good int, at array<int>, x array<float>").toPandas()
    found = found.sort_values("doc_id", kind="stable", ignore_index=True)
    vectors = [(np.asarray(a, np.int32), np.asarray(x, np.float32))
               for a, x in zip(found["at"], found["x"], strict=True)]
    if found["good"].nunique() < 2:
        machine.constant = True
        return machine
    return machine.fit(vectors, found["good"].to_numpy(np.float32))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`."""
    model = docs.sparkSession.sparkContext.broadcast(machine)  # fixed size: WIDTH * (FACTORS + 1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), 512):
                part = frame.iloc[a:a + 512]
                found = model.value.score([features(t) for t in part["text"]]).astype(float)
                yield part[["doc_id", "held_out"]].assign(
                    score=found, predicted=(found >= 0.5).astype("int32"))

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInPandas(
        run, "doc_id long, held_out boolean, score double, predicted int")


def op2_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
