"""The two-level exchange against the plain one, and its number of rows."""

import random

import pytest

from tallymart.llm import blocks, exchange, ngram_join


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(31)
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(400)] + [(None, "w1 " * 9)]
    return spark.createDataFrame(rows + rows[:50], "doc_id long, text string")


@pytest.mark.parametrize(("n_blocks", "ranges"), [(1, 1), (3, 7), (50, 40)])
def test_equal_to_one_row_per_block_and_range(docs, n_blocks, ranges, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 400)
    spread, layout = blocks.write_blocks(docs)
    layout = blocks.Layout(layout.blocks, layout.total, layout.parts)
    anchors = lambda block: ngram_join._sets(block, 3)[1]
    one = blocks.find_shared(spread, anchors, ranges, ngram_join.LEVELS).toArrow()
    two = exchange.find_shared(spread, anchors, layout, ranges, ngram_join.LEVELS).toArrow()
    for block in sorted(set(one.column("block").to_pylist())):
        a, b = (t.filter(blocks.pc.equal(t.column("block"), block)) for t in (one, two))
        for kind in (blocks.SHARED, *ngram_join.LEVELS):
            assert (blocks.bits_of(a, kind) == blocks.bits_of(b, kind)).all()
    assert set(one.column("block").to_pylist()) == set(two.column("block").to_pylist())
    kinds = 1 + len(ngram_join.LEVELS)
    assert len(two) <= layout.blocks * kinds * (exchange.groups(ranges) + 2)


def test_rows_grow_with_the_root(docs, monkeypatch, spark):
    """Four times the parts, eight times the rows at most, not sixteen."""
    rows = {}
    for parts in (16, 64):
        monkeypatch.setattr(blocks, "BLOCK_BYTES", 10**9)
        with_parts = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            spread, layout = blocks.write_blocks(docs)
            rows[parts] = exchange.find_shared(
                spread, lambda block: ngram_join._sets(block, 3)[1], layout, parts, ngram_join.LEVELS).count()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", with_parts)
    assert rows[64] <= 8 * rows[16]
