"""The algorithms inside the tasks, against plain versions."""

import heapq
import random
from array import array

import numpy as np
import pytest

from tallymart.llm import induced, kdtree, mixture, tokens, warc
from tallymart.llm.factorisation import Machine
from tallymart.llm.hilbert_pack import hilbert_key


@pytest.mark.parametrize("few", [0, 2048])
def test_suffix_array(few, monkeypatch):
    monkeypatch.setattr(induced, "FEW_NAMES", few)
    rng = random.Random(3)
    for _ in range(300):
        letters = rng.choice([1, 2, 3, 26])
        t = [rng.randint(1, letters) for _ in range(rng.randint(0, 60))] + [0]
        expected = sorted(range(len(t)), key=lambda i: t[i:])
        assert induced.suffix_array(np.array(t)).tolist() == expected


def test_common_prefixes():
    data = b"abcabcabcabx" * 3
    t = np.append(np.frombuffer(data, np.uint8).astype(np.int64), 0)
    sa = induced.suffix_array(t)[1:]
    got = induced.common_prefixes(np.frombuffer(data + bytes(40), np.uint8), sa, 10)
    for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True):
        x, y = (data + bytes(40))[a:], (data + bytes(40))[b:]
        same = next(k for k in range(len(x)) if k == 10 or x[k] != y[k])
        assert got[b] == same


def test_loser_tree():
    rng = random.Random(4)
    for _ in range(200):
        runs = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(0, 9))]
        assert list(warc.loser_tree([iter(r) for r in runs])) == list(heapq.merge(*runs))


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_subset_sum_is_best():
    rng = random.Random(5)
    for _ in range(200):
        sizes = rng.sample(range(1, 30), rng.randint(1, 6))
        counts = [rng.randint(0, 4) for _ in sizes]
        budget = rng.randint(0, 120)
        reach = {0}
        for s, c in zip(sizes, counts, strict=True):
            reach = {r + s * k for r in reach for k in range(c + 1) if r + s * k <= budget}
        got = mixture.subset_sum(sizes, counts, budget)
        assert sum(s * k for s, k in got.items()) == max(reach)
        assert all(k <= counts[sizes.index(s)] for s, k in got.items())


def test_fit_source_above_and_below_the_programme():
    for target, off in ((0, 0), (7, 1), (999, 0), (10_000_019, 21_161)):
        sizes, counts = [3, 11, 500, 90_000], [50, 40, 30, 100]
        copies, take = mixture.fit_source(sizes, counts, target)
        whole = sum(s * c for s, c in zip(sizes, counts, strict=True))
        got = copies * whole + sum(s * t for s, t in zip(sizes, take, strict=True))
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert abs(target - got) == off


def test_tree_finds_the_best_with_ties():
    rng = np.random.default_rng(6)
    points = rng.integers(-3, 4, (700, 3)).astype(float)
    points[100:400] = points[0]
    ids = rng.permutation(700).astype(np.int64)
    tree = kdtree.Tree(ids, points, leaf=16)
    queries, own = points[:40], ids[:40]
    best = [[] for _ in own]
    tree.search(own, queries, best, 5)
    for q, i, found in zip(queries, own, best, strict=True):
        expected = sorted((-int(s), int(j)) for s, j in zip(points @ q, ids, strict=True) if j != i)[:5]
        assert found == expected


@pytest.mark.parametrize(("sizes", "counts", "target"), [
    (list(range(300_000, 300_010)), [1] * 10, 1_000_000),
    (list(range(300_000, 300_010)), [1] * 10, 1_600_000),
    ([300_000, 450_000, 2_000_000], [3, 3, 3], 2_500_000),
    ([400_000, 5_000_000], [1, 8], 9_000_000),
    ([200_000, 250_000], [2, 2], 420_000),
    ([0, 200_000, 700_000], [5, 1, 9], 1_400_000),
])
def test_fit_source_of_long_documents(sizes, counts, target):
    copies, take = mixture.fit_source(sizes, counts, target)
    assert copies == 0 and all(0 <= t <= c for t, c in zip(take, counts, strict=True))
    least = min(s for s, c, t in zip(sizes, counts, take, strict=True) if s and t < c)
    assert 2 * abs(target - sum(s * t for s, t in zip(sizes, take, strict=True))) <= least


def test_fit_source_misses_by_half_a_document_at_most():
    rng = random.Random(10)
    for _ in range(60):
        sizes = sorted(rng.sample(range(1, 10 ** rng.randint(3, 6)), rng.randint(1, 12)))
        counts = [rng.randint(1, 6) for _ in sizes]
        target = rng.randint(1, sum(s * c for s, c in zip(sizes, counts, strict=True)) - 1)
        _, take = mixture.fit_source(sizes, counts, target)
        left = [s for s, c, t in zip(sizes, counts, take, strict=True) if t < c]
        off = target - sum(s * t for s, t in zip(sizes, take, strict=True))
        assert 2 * abs(off) <= min(left, default=2 * abs(off))


def _best_of_all(ids, points):
    return [sorted((-int(s), int(j)) for s, j in zip(points @ q, ids, strict=True) if j != i)[:5]
            for q, i in zip(points, ids, strict=True)]


@pytest.mark.parametrize("n", [21, 40, 128])
def test_a_query_does_not_count_among_its_leaf(n):
    """One leaf holds all points, and a query's own score is among its highest."""
    points = np.random.default_rng(n).integers(-99, 100, (n, 8)).astype(float)
    ids = np.arange(n, dtype=np.int64)
    best = [[] for _ in ids]
    kdtree.Tree(ids, points).search(ids, points, best, 5)
    assert best == _best_of_all(ids, points)


def test_best_in_the_own_cluster():
    """Tight clusters, each within a leaf: the best five stand beside the query."""
    rng = np.random.default_rng(7)
    centres = rng.integers(-200, 201, (40, 8))
    points = (np.repeat(centres, 60, axis=0) + rng.integers(-3, 4, (2400, 8))).astype(float)
    ids = rng.permutation(2400).astype(np.int64)
    best = [[] for _ in ids]
    kdtree.Tree(ids, points).search(ids, points, best, 5)
    assert best == _best_of_all(ids, points)


def test_tokens_equal_the_whole_text():
    ids = tokens.Ids(tokens.byte_bpe_path())
    for text in ("", " ", "\n", "a\n\nb", "a  b ", " a", "it's 'll  x\t y", "x<|endoftext|> y", "a\xa0b c",
                 "a,b. c!?. don.t\nx .y", "...", "1. 2.5, 3", "a　b c", "xͅ. a", "\r\n a. b"):
        expected = ids.model.encode(text, add_special_tokens=False).ids
        assert ids.encode(text) == array("H", expected).tobytes()


def test_known_pieces_forget(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 3)
    ids = tokens.Ids(tokens.byte_bpe_path())
    text = "one two three four five six seven two one."
    assert ids.encode(text) == array("H", ids.model.encode(text, add_special_tokens=False).ids).tobytes()


def test_machine_learns_an_interaction():
    """Neither feature tells anything alone; only their product does."""
    rng = np.random.default_rng(7)
    docs, good = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        docs.append((np.array([a, 2 + b], np.int32), np.ones(2, np.float32)))
        good.append(float(a == b))
    machine = Machine()
    machine.v += rng.standard_normal(machine.v.shape).astype(np.float32) * 0.1
    found = machine.fit(docs, np.array(good, np.float32)).score(docs)
    assert ((found >= 0.5) == (np.array(good) == 1)).mean() > 0.95
