"""Op8: which segments enter the suffix arrays, and the same rows however anchors are settled."""

import hashlib
import random

import pyarrow as pa
import pytest

from tallymart.llm import blocks, suffix_arrays

RNG = random.Random(21)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 8))) for _ in range(300)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def rows_of():
    copy, passage = prose(200), prose(40)
    near = copy.split(" ")
    out = [copy, copy, " ".join([*near[:100], "changed", *near[101:]]), None, "", "x" * 300, "y" + "x" * 400, "\x00" * 120]
    out += [f"{prose(10)} {passage} {prose(10)}" for _ in range(12)]
    return [(k - 3 if k else None, t) for k, t in enumerate(out)] + [(4, prose(30)), (4, passage)]


def described(texts, number):
    """Segments of a block whose anchors all count as shared."""
    rows = pa.table({"block": pa.array([number] * len(texts), pa.int64()), "doc_id": list(texts), "text": list(texts.values())})
    block = blocks.Block(rows)
    runs = suffix_arrays._anchors(block, 50)
    n = len(set(runs.hash.tolist()))
    marks = suffix_arrays._rows([(number, blocks.SHARED, 0, n, b"\xff" * n, None), (number, blocks.HOT, 0, n, bytes(n), None)],
                                suffix_arrays.ALONE_ARROW)
    return suffix_arrays._Segments(block, marks, 50), marks


def test_only_anchors_with_several_texts_are_sorted():
    copy, other = prose(400), prose(400)
    words = copy.split(" ")
    near = " ".join([*words[:200], "changed", *words[201:]])
    found = [described({7: copy, 9: other}, 0), described({3: copy, 5: other, 8: near}, 1)]
    rows = [(0, k, blocks.shortened(s.hash, 0, 1).tobytes(), s.digests().tobytes(), blocks.planes(s.least))
            for k, (s, _) in enumerate(found)]
    answers = suffix_arrays._alone(suffix_arrays._rows(rows, suffix_arrays.SEGMENT_ROWS), 4096)
    for k, (segments, marks) in enumerate(found):
        mine = pa.concat_tables([marks, answers.filter(pa.array([b == k for b in answers.column("block").to_pylist()]))])
        sent = segments.shipped(mine, 1)
        # Only around the changed word do two texts share an anchor: far less than the documents.
        assert 0 < sum(map(len, sent.contents)) < 400
        lower = blocks.bits_of(mine, suffix_arrays.LOWER)
        assert lower.any() == (k == 0)  # the copies with smaller ids lie in the other block


@pytest.mark.parametrize(("hot", "wide"), [(2048, 4096), (2048, 1), (3, 2), (0, 0)])
def test_rows_are_the_same_for_all_limits(spark, hot, wide, monkeypatch):
    monkeypatch.setattr(blocks, "HOT_BLOCKS", hot)
    monkeypatch.setattr(suffix_arrays, "WIDE_TEXTS", wide)
    rows = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"])
                   for r in suffix_arrays.remove_repeats(docs).collect())
    expected = []
    for i, t in rows:
        units, mine = (t or "").encode(), blocks.NO_ID if i is None else i
        smaller = b"\n\n".join((u or "").encode() for k, u in rows if (blocks.NO_ID if k is None else k) < mine)
        gone = {b for k in range(len(units) - 49) if units[k:k + 50] in smaller for b in range(k, k + 50)}
        kept = bytes(b for k, b in enumerate(units) if k not in gone)
        expected.append((-1 if i is None else i, len(units), len(gone), hashlib.sha256(kept).hexdigest()))
    assert found == sorted(expected)
