"""Toxicity: the trees and the calibration against plain versions, planted words, odd tables."""

import os
import random
import zlib

import numpy as np
import pytest

from tallymart.llm import toxicity

RNG = random.Random(21)
WORDS = ["".join(RNG.choice("aeiourstnlm") for _ in range(RNG.randint(2, 8))) for _ in range(400)]


def prose(n, *planted):
    words = [RNG.choice(WORDS) for _ in range(n)]
    for w in planted:
        words.insert(RNG.randint(0, len(words)), w)
    return " ".join(words)


def planted(n=1500):
    """Toxic documents hold words that begin with `zorq`, or an insult of the list."""
    rows, labels = [], []
    for k in range(n):
        toxic = k % 6 == 0
        words = ([f"zorq{RNG.choice(WORDS)}" for _ in range(4)] if k % 12 else ["idiot", "Moron!", "scum"]) if toxic else []
        rows.append((k, prose(RNG.randint(20, 200), *words), "xx", k))
        labels.append((k, 1, int(toxic)))
    return rows, labels


SCHEMA = "doc_id long, text string, lang string, score long"
LABELS = "doc_id long, quality int, toxic int"


def test_planted_words_are_learnt(spark):
    rows, labels = planted()
    odd = [(None, None, None, 1), (None, "idiot " * 5, "xx", 1), (9_000, "", "xx", 1), (9_001, "w " * 40_000, None, 1),
           (9_002, "unlabelled " + prose(50, "zorqnew", "zorqother", "zorqthird"), "xx", 1), rows[6], rows[6]]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(4)
    truth = spark.createDataFrame(labels + [(None, 1, 1), (7, 1, None), (8, 0, 0), (8, 1, 0)], LABELS)
    model = toxicity.train(docs, truth)
    assert "zorq-" in model.lexicon and "idiot" in model.lexicon
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) + len(odd)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    wrong = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 9_000 and r["held_out"]
             and r["predicted"] != int(r["doc_id"] % 6 == 0)]
    assert len(wrong) <= 0.02 * sum(r["held_out"] for r in found)
    by = {r["doc_id"]: r for r in found}
    assert by[9_002]["predicted"] == 1 and by[9_000]["predicted"] == 0 and by[9_001]["predicted"] == 0
    assert len({r["score"] for r in found if r["doc_id"] == rows[6][0]}) == 1
    again = toxicity.score(docs.repartition(7), toxicity.train(docs.repartition(3), truth)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_held_out_labels_are_not_read(spark):
    rows, labels = planted(600)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, two = (toxicity.score(docs, toxicity.train(docs, spark.createDataFrame(x, LABELS))).collect()
                for x in (labels, turned))
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_few_labels_and_empty_tables(spark):
    rows, labels = planted(40)
    docs, truth = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    one_kind = toxicity.score(docs, toxicity.train(docs, truth.where("toxic = 1"))).collect()
    assert {r["score"] for r in one_kind} == {1.0}
    none = toxicity.train(docs, truth.where("false"))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), toxicity.train(docs.where("false"), truth)).count() == 0
    assert len(toxicity.score(docs, toxicity.train(docs, truth)).collect()) == len(rows)


def test_sample_keeps_its_bound(spark):
    """A chosen id repeated many times is one row."""
    rows, labels = planted(300)
    docs = spark.createDataFrame(rows + [rows[12]] * 5_000, SCHEMA)
    truth = spark.createDataFrame(labels, LABELS).selectExpr("doc_id AS _id", "toxic")
    counts = {t: sum(x[2] == t for x in labels) for t in (0, 1)}
    assert toxicity._sample(docs, truth, 10_000, counts).count() == 300
    assert toxicity._sample(docs, truth, 60, counts).count() < 110


def test_features():
    made = toxicity.Features({"zork": 2.0, "vequ-": 1.5})
    names = dict(zip(made.NAMES, made.of("You IDIOT!! zork, vequmo vequmo z0rk s c a m i...d zoooork #$ plain words here too"), strict=True))
    n = 17
    assert names["insults"] == pytest.approx(100 / n)
    assert names["words"] == pytest.approx(200 / n) and names["heaviest_word"] == 2
    assert names["beginnings"] == pytest.approx(300 / n) and names["different_beginnings"] == 1
    assert names["disguised"] == pytest.approx(200 / n)  # z0rk and zoooork
    assert names["second_person"] == pytest.approx(100 / n)
    assert names["hits_near_second_person"] == pytest.approx(5 / 6, abs=0.2)
    assert names["capital_words"] == pytest.approx(100 / n)
    assert names["runs_of_marks"] == pytest.approx(100 / n) and names["spelt"] == pytest.approx(200 / n)
    assert made.of(None).tolist() == made.of("").tolist()


def test_a_text_with_more_words_than_room(monkeypatch):
    monkeypatch.setattr(toxicity.Features, "ROOM", 50)
    small, text = toxicity.Features({"w7": 1.0}), " ".join(f"w{k}" for k in range(300))
    monkeypatch.setattr(toxicity.Features, "ROOM", 5_000)
    large = toxicity.Features({"w7": 1.0})
    small.ROOM = 50
    for t in ("a b c", text, "d e", text, prose(40)):
        assert small.of(t).tolist() == large.of(t).tolist()


def plain_margin(trees, row):
    out = trees.base
    for feature, threshold, leaf in trees.grown:
        node = 0
        for _ in range(toxicity.DEPTH):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        out += leaf[node - 7]
    return out


def test_trees():
    rng = np.random.default_rng(4)
    x = rng.random((600, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.6) ^ (x[:, 3] > 0.5)).astype(float)  # no single feature tells
    trees = toxicity.Trees().fit(x, y)
    margin = trees.margin(x)
    assert margin == pytest.approx([plain_margin(trees, row) for row in x])
    assert ((margin > 0) == y).mean() > 0.97
    # The first tree's first split is the best of all single splits by its own gain.
    p = y.mean()
    g, h = y - p, np.full(len(y), p * (1 - p))
    best = max((g[x[:, j] <= e].sum()**2 / (h[x[:, j] <= e].sum() + 1) + g[x[:, j] > e].sum()**2 / (h[x[:, j] > e].sum() + 1), j, e)
               for j in range(5) for e in np.unique(np.quantile(x[:, j], np.linspace(0, 1, toxicity.BINS + 1)[1:-1])))
    feature, threshold, _ = trees.grown[0]
    assert (feature[0], threshold[0]) == (best[1], pytest.approx(best[2]))


def test_isotonic():
    rng = np.random.default_rng(5)
    margin, weight = np.round(rng.normal(size=300), 1), rng.random(300) + 0.1
    y = (rng.random(300) < 1 / (1 + np.exp(-2 * margin))).astype(float)
    x, steps = toxicity.isotonic(margin, y, weight)
    fitted = np.interp(margin, x, steps)
    assert (np.diff(steps) >= 0).all() and (np.diff(x) >= 0).all()
    # Greatest of least means, the definition.
    points = np.unique(margin)
    mean = lambda a, b: np.average(y[(margin >= a) & (margin <= b)], weights=weight[(margin >= a) & (margin <= b)])
    for m, value in list(zip(margin, fitted, strict=True))[:40]:
        assert value == pytest.approx(max(min(mean(a, b) for b in points[points >= m]) for a in points[points <= m]))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    scored = toxicity.op11_toxicity_trees(spark, folder).where("held_out")
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    assert sum(a == b for a, b in rows) >= 0.97 * len(rows)
    assert sum(a and b for a, b in rows) >= 0.8 * sum(a for a, _ in rows)
