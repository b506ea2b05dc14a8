"""Every operator on a small table of odd rows, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from tallymart.llm import (blocks, doubling, factorisation, hilbert_pack, kdtree, mixture, ngram_join, pii,
                           quality_rules, suffix_arrays, tokens, warc)

RNG = random.Random(8)
WORDS = ["".join(RNG.choice("abcdefgäß") for _ in range(RNG.randint(1, 7))) for _ in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, n_words string, c int"


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts():
    passage, base = prose(60), prose(120).split(" ")
    out = [None, "", " \n\t", "one", "two words", prose(4), "Mixed CASE words here are five", "mixed case words here are five"]
    out += [prose(30) for _ in range(5)]
    out += [" ".join(base)] * 4
    for k in range(12):  # near copies, each with an own change
        own = list(base)
        own[10 * k % 120] = f"new{k}"
        out.append(" ".join(own))
    out += [f"{prose(20)} {passage}\n{prose(25)}" for _ in range(12)]  # a passage in a third of all
    out += [passage, passage + " end", "x" * 60_000, "9" * 30_000, "a. " * 9_000, prose(9_000)]
    out += ["line one is here\n" * 30, "THE !! LOUD " * 20, "a*** b### c%%% " * 30, "\x00" * 120, "\x00" * 130]
    out += [f"write to user{k}@mail.example.org or 10.0.0.{k} or +49 (30) 123-4567{k}, 4111 1111 1111 1111 now" for k in range(3)]
    out += ["a@b.co_x@y.z 1.2.3.4.5.6.7.8 999.1.1.1 +1 22 4111-1111-1111-1112", "é ü 0001.2.3.4, ß x@y.zz"]
    return out


ROWS = [(i * 3 - 6, t, [None, "en", "de"][i % 3], [None, "b", "a", "a", "a"][i % 5], None, "r", "w", i)
        for i, t in enumerate(texts())]
DOCS = [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(r[0], k % 2, 0) for k, r in enumerate(ROWS)] + [(None, 1, 0), (0, None, 0), (3, 0, 0), (3, 1, 1)],
        "doc_id long, quality int, toxic int")


def twice(docs):
    """The table with every row repeated and some rows without id."""
    return docs.unionByName(docs).unionByName(docs.selectExpr(
        "CAST(NULL AS BIGINT) AS doc_id", *[c for c in docs.columns if c != "doc_id"]).limit(40))


# 1 -----------------------------------------------------------------------------------------


def test_quality_counts(docs, labels):
    found = {r["doc_id"]: r for r in quality_rules.rate_documents(docs, labels).collect()}
    assert len(found) == len(DOCS)
    for i, text in DOCS:
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.base_counts(text)
        assert r["base_failed"] == brute.base_failed(text)
        assert not (r["base_failed"] and r["kept"])


def test_binomial_bound(spark):
    from math import comb

    from pyspark.sql import functions as F

    cases = [(n, k) for n in (1, 5, 80, 900) for k in (0, 1, 3, 7) if k <= n]
    rows = spark.createDataFrame(cases, "n long, k long")
    for r in rows.withColumn("p", quality_rules.binomial_cdf(F.col("n"), F.col("k"), 0.01)).collect():
        exact = sum(comb(r["n"], i) * 0.01**i * 0.99 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert r["p"] == pytest.approx(1.0 if r["k"] >= r["n"] * 0.01 else exact, rel=1e-9)


def test_cutoffs_keep_their_promise(spark):
    """Bad documents have high symbol shares, good ones low; few labels give no cutoff."""
    from pyspark.sql import functions as F

    def rows(n, stratum):
        zero = {c: 0 for c in quality_rules.COUNTS} | {"n_words": 100, "word_chars": 1000, "n_lines": 5}
        return [(stratum, True, zero | {"n_symbols": 2 + (k == 7) * 300}) for k in range(n)] + [
            (stratum, False, zero | {"n_symbols": 400}) for k in range(50)]

    schema = "stratum string, good boolean, m map<string, long>"
    frame = spark.createDataFrame(rows(5000, "en") + rows(60, "de"), schema)
    frame = frame.select("stratum", "good", F.struct(*[F.col("m")[c].alias(c) for c in quality_rules.COUNTS]).alias("_m"))
    found = {(r["stratum"], r["rule"]): r["cutoff"] for r in quality_rules.choose_cutoffs(frame).collect()}
    # All cutoffs up to 0.3 catch the 50 bad ones; 0.3 is the most lenient of them.
    assert found == {("en", "symbols"): 0.3}


def test_quality_filter(docs, labels):
    kept = quality_rules.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in DOCS if not brute.base_failed(t)}


# 2 -----------------------------------------------------------------------------------------


def test_machine_scores_all(spark, docs, labels):
    machine = factorisation.train(docs, labels)
    rows = factorisation.score(twice(docs), machine).collect()
    assert len(rows) == 2 * len(DOCS) + 40
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    one_kind = labels.where("quality = 1")
    scores = factorisation.score(docs, factorisation.train(docs, one_kind)).collect()
    assert all(r["score"] == pytest.approx(0.999) for r in scores)
    none = factorisation.train(docs, labels.where("false"))
    assert factorisation.score(docs, none).first()["score"] == 0.5


def test_held_out_accuracy(spark):
    import os

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    scored = factorisation.op2_factorisation_machine(spark, folder).where("held_out")
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.join(truth, "doc_id").select("quality", "predicted").collect()
    assert sum(r[0] == r[1] for r in rows) >= 0.95 * len(rows)


# 3 -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("few", [0, 4])
def test_components(docs, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW", few)  # 0: pivots until nothing is left
    monkeypatch.setattr(ngram_join, "ROUNDS", few // 4)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.label(docs).collect()}
    assert found == brute.components(DOCS)


def test_components_of_chains(spark):
    rng = random.Random(10)
    links = [(k, k + 1) for k in range(100, 160)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    rng.shuffle(links)
    found = ngram_join.components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in found} == {x: root[x] for x in linked}


def test_components_of_repeated_rows(docs):
    expected = brute.components(DOCS)
    rows = ngram_join.label(twice(docs)).collect()
    assert len(rows) == 2 * len(DOCS) + 40
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]


def test_keep_one(docs):
    expected = sorted(i for i, (_, c) in brute.components(DOCS).items() if i == c)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == expected
    again = ngram_join.keep_one(docs.unionByName(docs))
    assert sorted(r["doc_id"] for r in again.collect()) == expected


def test_keep_one_of_null_and_repeated_ids(spark):
    rng = random.Random(12)
    a, b, c, d, e = (prose(100, rng) for _ in range(5))
    rows = [(None, a), (1, a + " end"), (2, b), (2, b + " end"), (2, c), (3, c), (None, d), (None, d + " end"),
            (None, d), (None, e), (4, " "), (4, " "), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs).collect())
    for i, text in ((2, b), (None, d)):
        assert kept.pop((i, text), 0) + kept.pop((i, text + " end"), 0) == 1
    assert kept == Counter({(1, a + " end"): 1, (2, c): 1, (None, e): 1, (4, " "): 1, (None, None): 1, (None, ""): 1})


# 4, 8 ---------------------------------------------------------------------------------------


def test_doubling(docs):
    found = {r["doc_id"]: r for r in doubling.remove_repeats(docs, texts=True).collect()}
    for i, units, gone in brute.without_repeats([(i, brute.words(t)) for i, t in DOCS], 13):
        kept = b" ".join(w for k, w in enumerate(units) if k not in gone)
        r = found[i]
        assert (r["n_words"], r["n_removed"], r["kept"]) == (len(units), len(gone), kept.decode())
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_longest_levels(docs):
    found = {r["window"]: r["documents"] for r in doubling.longest_levels(docs).collect()}
    for window in (13, 26, 52, 104, 208):
        expected = sum(1 for *_, gone in brute.without_repeats(
            [(i, brute.words(t)) for i, t in DOCS], window) if gone)
        assert found.get(window, 0) == expected


@pytest.mark.parametrize("hot", [0, 64])
def test_suffix_arrays(docs, hot, monkeypatch):
    monkeypatch.setattr(blocks, "HOT_BLOCKS", hot)
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    found = {r["doc_id"]: r for r in suffix_arrays.remove_repeats(docs).collect()}
    for i, units, gone in brute.without_repeats([(i, (t or "").encode()) for i, t in DOCS], 50):
        kept = bytes(b for k, b in enumerate(units) if k not in gone)
        r = found[i]
        spans = sum(1 for k in gone if k - 1 not in gone)
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(units), len(gone), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("operator", [doubling, suffix_arrays])
def test_repeated_rows_keep_each_other(docs, operator):
    plain = {r["doc_id"]: r["n_removed"] for r in operator.remove_repeats(docs).collect()}
    rows = operator.remove_repeats(twice(docs)).collect()
    assert len(rows) == 2 * len(DOCS) + 40
    assert all(r["n_removed"] == plain[r["doc_id"]] for r in rows if r["doc_id"] is not None)


# 5 -----------------------------------------------------------------------------------------


def test_mixture(docs):
    rows = mixture.mix_report(docs).collect()
    sizes = {i: len(brute.words(t)) for i, t in DOCS}
    whole = {}
    for r in ROWS:
        whole[r[3]] = whole.get(r[3], 0) + sizes[r[0]]
    order = ["a", "b", None]
    weight = dict(zip(order, (5, 2, 1), strict=True))
    aim, free, capped = {}, sum(whole.values()), set()
    while True:
        level = free / sum(weight[s] for s in order if s not in capped)
        over = [s for s in order if s not in capped and level * weight[s] > 3 * whole[s]]
        if not over:
            break
        capped |= set(over)
        free = sum(whole.values()) - sum(3 * whole[s] for s in capped)
    aim = {s: 3 * whole[s] if s in capped else level * weight[s] for s in order}
    taken = dict.fromkeys(order, 0)
    for r in rows:
        assert (r["size"], r["source_size"]) == (sizes[r["doc_id"]], whole[r["source"]])
        assert r["target"] == pytest.approx(aim[r["source"]])
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    assert len(rows) == len(DOCS)
    for s in order:
        own = [sizes[r[0]] for r in ROWS if r[3] == s]
        reach = {0}
        for size in own:
            reach |= {x + size for x in reach}
        copies = int(aim[s] // whole[s])
        nearest = min(abs(copies * whole[s] + x - aim[s]) for x in reach)
        assert abs(taken[s] - aim[s]) <= nearest + 5
    assert sorted(map(repr, rows)) == sorted(map(repr, mixture.mix_report(docs.repartition(5)).collect()))
    mixed = mixture.mix_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]} == {
        i: n for i, n in counts.items() if sizes[i]}


# 6 -----------------------------------------------------------------------------------------


def check_packing(rows, expected):
    """expected: (doc_id, text) rows; every copy must come back piece by piece."""
    model = Tokenizer.from_file(tokens.byte_bpe_path())  # loaded anew, as the file says
    ids = {(i, t): model.encode(t or "", add_special_tokens=False).ids + [1] for i, t in set(expected)}
    want, got = {}, {}
    for key in expected:
        flat = np.array(ids[key], "<u4")
        want[key[0]] = want.get(key[0], 0) + len(flat)
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert any(len(v) == r["doc_tokens"] and zlib.crc32(np.array(
            v[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
            for (i, _), v in ids.items() if i == r["doc_id"])
    assert got == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0


def test_packing(docs):
    check_packing(hilbert_pack.pack(docs).collect(), DOCS)


def test_packing_of_special_tokens(spark):
    """The file's special token is found in texts; marks and white space around it are kept."""
    rows = [(k, t) for k, t in enumerate((
        "a<|endoftext|>b", "x <|endoftext|> y.", "<|endoftext|>", "word <|endoftext|>, <|endoftext|>word.\n<|endoftext|> z",
        "<|endoftext|><|endoftext|> \n", "<|endoftext|", " <|endoftext|>  end", "a\n<|endoftext|>!?"))]
    found = hilbert_pack.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_packing(found, rows)
    assert tokens.Ids.at(tokens.byte_bpe_path()).encode("a<|endoftext|>b") == np.array([64, 50256, 65], "<u2").tobytes()


def test_pieces_are_encoded_as_in_place(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 100)
    signs = [*"ab Z.,!?;:'\n\t 1é日\u00a0", " the", "\n\n", "  ", "'s", "<|endoftext|>", "..."]
    texts = [t or "" for _, t in DOCS] + ["".join(RNG.choice(signs) for _ in range(RNG.randint(1, 40))) for _ in range(3000)]
    model, own = Tokenizer.from_file(tokens.byte_bpe_path()), tokens.Ids(tokens.byte_bpe_path())
    for at in range(0, len(texts), 50):
        for text, found in zip(texts[at:at + 50], own.encode_all(texts[at:at + 50]), strict=True):
            assert np.frombuffer(found, "<u2").tolist() == model.encode(text, add_special_tokens=False).ids


# 7 -----------------------------------------------------------------------------------------


def test_archives(spark, tmp_path):
    html = ["<p>x</p>", None, "", "a\r\n\r\nWARC/1.1\r\n", "<p>x</p>", "ü" * 50_000, "<p>x</p>"]
    pages = [(k, u, h, 1) for k, (u, h) in enumerate(zip(
        ["http://www.b.org/x", None, "https://a.org", "http://b.org/a\r\nX: y", "http://b.org", "q", "http://b.org/x"],
        html, strict=True))]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, record int")
    warc.write_archives(frame.repartition(3), str(tmp_path / "w"), records=2)
    rows = warc.merge_runs(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    first = {}
    for k, h in enumerate(html):
        first.setdefault(h or "", k)
    assert len(rows) == len(pages) and all(r["intact"] for r in rows)
    for r in rows:
        payload = (html[r["page_id"]] or "").encode()
        origin = first[payload.decode()]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), brute.digest(payload))
        assert (r["record_type"], r["refers_to"]) == (
            ("response", None) if origin == r["page_id"] else ("revisit", origin))
    order = [(r["url_key"].encode(), r["captured_at"]) for r in sorted(rows, key=lambda r: r["history_order"])]
    assert order == sorted(order)
    none = spark.createDataFrame([], frame.schema)
    warc.write_archives(none, str(tmp_path / "e"))
    assert warc.merge_runs(warc.read_archives(spark, str(tmp_path / "e"))).count() == 0


def test_archives_of_large_ids(spark, tmp_path):
    """Ids that are hashes: every capture has a time, and the histories stay in order."""
    ids = [10**13, 3 * 10**11, -5, 2**63 - 1, -(2**63), 7, 3 * 10**9 + 7, None]
    frame = spark.createDataFrame([(i, "http://a.org", f"page {k % 5}") for k, i in enumerate(ids)],
                                  "page_id long, url string, html string")
    warc.write_archives(frame.repartition(2), str(tmp_path / "w"))
    rows = sorted(warc.merge_runs(warc.read_archives(spark, str(tmp_path / "w"))).collect(), key=lambda r: r["history_order"])
    assert sorted(map(str, ids)) == sorted(str(r["page_id"]) for r in rows) and all(r["intact"] for r in rows)
    assert all(len(r["captured_at"]) == 20 for r in rows)
    assert [r["captured_at"] for r in rows] == sorted(r["captured_at"] for r in rows)
    assert [r["page_id"] for r in rows if r["page_id"] in (7, 3 * 10**9 + 7)] == [7, 3 * 10**9 + 7]


# 9 -----------------------------------------------------------------------------------------


def test_personal_data(docs):
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for i, text in DOCS:
        r, expected = found[i], brute.spans(text)
        base = ",".join(f"{k}:{a}:{z}" for k, a, z in expected)
        assert r["spans"] == base
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in brute.PATTERNS] == [sum(x[0] == k for x in expected) for k in brute.PATTERNS]


def test_disclosing_terms(spark):
    """"zork" stands near one address only, "common" near everything."""
    rows = [(k, f"{prose(8)} common zork mail boss@corp.example today {prose(5)}") for k in range(4)]
    rows += [(10 + k, f"{prose(8)} common mail user{k}@corp.example today {prose(5)}") for k in range(30)]
    rows += [(50 + k, f"common words {prose(30)}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    for i, text in rows:
        terms = [s.split(":")[1:] for s in found[i].split(",") if s.startswith("term")]
        expected = ["zork"] if i < 4 else []
        assert [text[int(a):int(z)] for a, z in terms] == expected
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert all("zork" not in t and "@" not in t for t in clean.values())
    assert clean[60] == dict(rows)[60]


def test_terms_come_from_the_whole_document(spark):
    """Names far from the mention, behind a refused match, and between two addresses."""
    rng = random.Random(11)
    far = prose(60, rng)
    rows = [(k, f"Zorkan Rilke {prose(2, rng)}\n{far} {k}\nmail boss@corp.example") for k in range(4)]
    rows += [(10 + k, f"{prose(3, rng)} Quorvin paid 2024 with 4111 1111 1111 1111") for k in range(4)]
    rows += [(20 + k, f"Vexlor {prose(3, rng)}: a@x.example, b@x.example") for k in range(4)]
    rows += [(30, None), (31, ""), (32, rows[0][1]), (0, rows[0][1])]
    rows += [(40 + k, f"Mirv {prose(3, rng)} rilke p@q.example") for k in range(3)]
    rows += [(50 + k, f"{prose(40, rng)} {far}" + " mirv" * (k < 3)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, entities = [], []
    for _, t in rows:
        words.append({w.lower() for w in re.findall(r"[^\W\d_]{3,}", re.sub(brute.PATTERNS["email"], " ", t or ""))})
        entities.append({(k, t[a:z].lower()) for k, a, z in brute.spans(t)})
    with_term, gone = Counter(w for x in words for w in x), {}
    for e in set().union(*entities):
        at = [i for i, x in enumerate(entities) if e in x]
        for w, n in Counter(w for i in at for w in words[i]).items():
            posterior = n / with_term[w]
            if (len({rows[i][1] for i in at if w in words[i]}) >= 3 and posterior > 0.5
                    and posterior * len(rows) / len(at) > 64):
                for i in at:
                    gone.setdefault(i, set()).update({w} & words[i])
    assert set().union(*gone.values()) >= {"zorkan", "rilke", "quorvin", "paid", "vexlor"}
    assert "mirv" not in set().union(*gone.values())
    found = {(r["doc_id"], r["n_email"]): r["spans"] for r in pii.find(docs).collect()}
    clean = {(r["doc_id"], r["text"]) for r in pii.sanitise(docs).collect()}
    for i, (k, t) in enumerate(rows):
        spans = found[k, sum(x[0] == "email" for x in brute.spans(t))].split(",")
        got = {t[int(a):int(z)].lower() for kind, a, z in (s.split(":") for s in spans if s) if kind == "term"}
        assert got == gone.get(i, set())
    assert not any(w in (t or "").lower() for k, t in clean for w in ("zorkan", "quorvin", "vexlor"))


def test_sanitise(docs):
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    for i, text in DOCS:
        assert rows[i]["text"] == (None if text is None else brute.masked(text))


# 10 ----------------------------------------------------------------------------------------


def test_top_k(spark):
    rng = random.Random(9)
    data = [(k, [rng.uniform(-1, 1) for _ in range(4)]) for k in range(300)]
    data += [(300 + k, [0.5, 0.5, 0.5, 0.5]) for k in range(100)]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0]), (902, [float("nan")] * 4), (903, [float("inf")] * 4),
           (None, [1.0] * 4), (950, [1.0, 2.0]), (1000, [1.0, 1.0]), (1050, [])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in data + odd + data[:5]], "vec_id long, embedding array<float>, v int")
    points = kdtree.vectors(frame).cache()
    rows = kdtree.top_k(points, points.where("vec_id % 50 = 0"), shard=64, block=3).collect()
    ints = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in data + [odd[5], odd[6], odd[7]]}
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    for q in [i for i in ints if i % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i)
                        for i, v in ints.items() if i != q and len(v) == len(ints[q]))[:5]
        assert got.get(q, []) == [(i, -s) for s, i in scores]


# all ---------------------------------------------------------------------------------------


def test_empty_tables(spark, docs, labels):
    none = docs.where("false")
    assert quality_rules.rate_documents(none, labels).count() == 0
    assert quality_rules.filter_documents(none, labels).count() == 0
    assert factorisation.score(none, factorisation.train(none, labels)).count() == 0
    assert ngram_join.label(none).count() == 0
    assert ngram_join.keep_one(none).count() == 0
    assert doubling.remove_repeats(none).count() == 0
    assert mixture.mix_report(none).count() == 0
    assert hilbert_pack.pack(none).count() == 0
    assert suffix_arrays.remove_repeats(none).count() == 0
    assert pii.find(none).count() == 0
    assert pii.sanitise(none).count() == 0
    empty = kdtree.vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).cache()
    assert kdtree.top_k(empty, empty).count() == 0


def test_pipeline(spark, docs, labels, tmp_path):
    """Stage by stage: exact rows for the filters, invariants and a round trip for the rest."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    good = [(i, t) for i, t in DOCS if not brute.base_failed(t)]
    one = [(i, t) for i, t in good if brute.components(good)[i][1] == i]
    clean = sorted((i, brute.masked(t)) for i, t in one)
    now = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        assert now.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in now.collect()) == clean
    mixed = corpus_pipeline.STAGES[3][1](spark, now, str(tmp_path)).collect()
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixture.mix_report(now).collect() if r["taken"]}
    assert Counter(r["doc_id"] for r in mixed) == Counter(taken)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_packing(packed, [(r["doc_id"], r["text"]) for r in mixed])
