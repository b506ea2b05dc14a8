"""Aligned tokenizers against a plain version with tokenizers loaded anew."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallymart.llm import alignment

RNG = random.Random(13)
SIGNS = [*"abcXYZ .,!?'’\n\t éüß½ﬁ1234567890-_@#$%&|<>/\"()[]▁\x00\x1c\x85\xa0 　日本🙂́ا", " the", " and", "\n\n",
         "  ", "'s", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "ing "]


def texts():
    words = ["".join(RNG.choice("aeioustnrh") for _ in range(RNG.randint(1, 9))) for _ in range(300)]
    out = [None, "", " ", "\n", "one", "▁", "a ▁ b", " x", "x ", "a\n", "\nb", "x" * 4_000, "word " * 3_000]
    out += [" ".join(RNG.choice(words) for _ in range(60)).capitalize() + ".\n" + " ".join(words[:9]) for _ in range(80)]
    out += ["".join(RNG.choice(SIGNS) for _ in range(RNG.randint(1, 70))) for _ in range(400)]
    return out + out[3:40]


ROWS = [(None if k % 97 == 5 else k, t, "x") for k, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, n_a string").repartition(5)


@pytest.fixture(scope="module")
def expected():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders

    a_model = Tokenizer.from_file(alignment.byte_bpe_path())
    a_model.encode_special_tokens = True
    b_model = SentencePieceProcessor(model_file=alignment.piece_bpe_path())
    letters = alignment.byte_characters()
    assert decoders.ByteLevel().decode([c for c, b in letters.items() if b < 128]) == "".join(
        chr(b) for b in letters.values() if b < 128)

    def tokens(text):
        raw = (" " + text).encode()
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
                   else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return [], [], "", []
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            u, v = a_ends.index(end) + 1, b_ends.index(end) + 1
            groups.append(",".join(map(str, a[i:u])) + "|" + ",".join(map(str, b[j:v])))
            links.append((a[u - 1], b[v - 1]))
            i, j = u, v
        return a, b, ";".join(groups), links

    each = [tokens(t or "") for _, t, _ in ROWS]
    counts = Counter(x for *_, links in each for x in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = [(i, len(a), len(b), len(links), len(links), sum(counts[x] == highest[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
           for (i, _, _), (a, b, g, links) in zip(ROWS, each, strict=True)]
    return out, counts, [g for *_, g, _ in each]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("lookup", [alignment.LOOKUP_PAIRS, 0])
def test_against_plain_alignment(docs, expected, lookup):
    assert ordered(alignment.report(docs, lookup_pairs=lookup).collect()) == ordered(expected[0])


def test_small_memory_and_deep_trees(docs, expected, monkeypatch):
    """Units forgotten again and again, and trees of several levels."""
    monkeypatch.setattr(alignment, "FAN", 2)
    aligned = alignment.Aligned.at((alignment.byte_bpe_path(), alignment.piece_bpe_path()))
    monkeypatch.setattr(alignment, "UNITS", 200)
    monkeypatch.setattr(alignment, "CHUNK", 500)
    numbers = list(alignment._documents(iter(t for _, t, _ in ROWS), aligned))
    assert [x is None for x in numbers] == [not r[1] for r in expected[0]]
    assert ordered(alignment.report(docs.repartition(7)).collect()) == ordered(expected[0])


def test_groups_and_pairs(docs, expected):
    paths = alignment.byte_bpe_path(), alignment.piece_bpe_path()
    found = alignment.align(docs)
    assert ordered(r["groups"] for r in found.collect()) == ordered(expected[2])
    rows = alignment.pair_counts(alignment.count_pairs(docs, paths)).collect()
    assert {(r["a"], r["b"]): r["links"] for r in rows} == dict(expected[1])
    assert len(rows) == len(expected[1])


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 50_000).astype(np.uint64))
    made = alignment.PerfectHash.build(keys)
    assert sorted(made.numbers(keys).tolist()) == list(range(len(keys)))
    again = alignment.PerfectHash(made.sizes, made.words)
    assert (again.numbers(keys) == made.numbers(keys)).all()
    assert len(alignment.PerfectHash.build(keys[:0]).numbers(keys[:0])) == 0


def test_strange_pairs_are_noticed():
    keys = np.arange(10, dtype=np.uint64)
    made = alignment.PerfectHash.build(keys)
    ordered_keys = np.zeros_like(keys)
    ordered_keys[made.numbers(keys)] = keys
    row = {"sizes": made.sizes, "words": made.words.tobytes(), "keys": ordered_keys.tobytes(),
           "counts": np.ones(10, np.int64).tobytes(), "best": np.ones(10, bool).tobytes()}
    counts = alignment.Counts(row)
    assert (counts.keys[counts.find(keys)] == keys).all()
    found = counts.find(np.array([3, 99], np.uint64))
    assert counts.keys[found[0]] == 3 and found[1] == -1


def test_empty_table(docs):
    none = docs.where("false")
    assert alignment.report(none).count() == 0
    assert alignment.report(docs.where("text is null")).where("n_a <> 0 or groups_sha256 <> ''").count() == 0
