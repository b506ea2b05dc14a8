"""Conversation repair against plain search over all edits, and on odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tallymart.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, n int"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 4:
            role = "user"
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        yield from [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)


def plain(rows):
    """Dynamic programme over (output roles so far as a state), all edits spelled out."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(),
                                       hashlib.md5(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen
                      else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    new = {"u": "user", "a": "assistant"}

    def filled(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for x in set(follows[state]) & {"u", "a"}:
                    option = (cost + 3, audit + "I", (*out, new[x] + ":"))
                    best[x] = min(best.get(x, option), option)
        return best

    best = filled({"": (0, "", ())})
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, out) in best.items():
            options = [(state, (cost + 4, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] in follows[state] and role:
                    options.append((follows[state][role[0]], (cost + more, audit + "K", (*out, f"{role}:{text}"))))
                options += [(x, (cost + 3 + more, audit + "R", (*out, f"{new[x]}:{text}")))
                            for x in set(follows[state]) & {"u", "a"}]
            for x, option in options:
                after[x] = min(after.get(x, option), option)
        best = filled(after)
    cost, audit, out = min(best[x] for x in ("", "a") if x in best)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = Counter(faults)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def expected(rows):
    kept = {}
    for r in rows:
        kept.setdefault(r[0], [])
    for r in plain_damage(rows):
        kept[r[0]].append(r)
    return {i: plain(v) for i, v in kept.items()}


def conversations():
    rng, rows = random.Random(12), []
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "Ursula", "ulrich", "tool", "ä"]
    texts = ["Yes.", "yes", "No!", "Why? \n", " ", "", None, "a. b", "ü?", "\x0b", "x ", "Done."]
    for conv in [None, *range(150)]:
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3, 1]), rng.choice(roles[:rng.choice([3, 5, 11])]),
                         rng.choice(texts)))
    rows += [(900, t, "user" if t % 2 else "assistant", f"row {t % 700}" + "." * (t % 3)) for t in range(3000)]
    rows += [(901, 5, "user", "same.")] * 2000  # equal rows
    rows += [(902, -(1 << 63), "user", "first."), (902, (1 << 63) - 1, "assistant", "last.")]
    rows += [(903, 1, "user", "long " * 300_000)]
    return rows


def found(frame):
    rows = frame.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}


def test_against_all_edits(spark):
    rows = conversations()
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    want = expected(rows)
    assert len({v[6] for v in want.values()}) > 60
    if 902 in want and want[902][0] > (1 << 63) - 1:
        want[902] = ((1 << 63) - 1, *want[902][1:])
    assert found(repair.report(repair.damage(frame.withColumnRenamed("n", "fault")))) == want


def test_repaired_rows(spark):
    rows = [r for r in conversations() if r[0] is None or r[0] < 150]
    frame = repair.undamaged(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA))
    digests = {i: v[-1] for i, v in found(repair.report(frame)).items()}
    out = {}
    for r in sorted(repair.repaired(frame).collect(), key=lambda r: r["position"]):
        out.setdefault(r["conv_id"], []).append(r)
    for conv, kept in out.items():
        assert [r["position"] for r in kept] == list(range(len(kept)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept))
    for conv, digest in digests.items():
        lines = "\n".join(f"{r['role']}:{r['text']}" for r in out.get(conv, []))
        assert hashlib.sha256(lines.encode()).hexdigest() == digest


@pytest.mark.parametrize("length", [6])
def test_search_of_all_short_forms(length):
    rng = random.Random(3)
    for _ in range(400):
        rows = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, length))]
        bounds = repair.suffix_bounds(rows)
        cost, audit = repair.search(rows)
        assert cost == bounds[0][repair.START]
        least = None
        for n in range(len(rows) + 7):  # no cheapest audit inserts more
            for letters in itertools.product("DIKR", repeat=n) if n <= 5 and len(rows) <= 3 else ():
                value = priced(rows, letters)
                if value is not None and (least is None or (value, "".join(letters)) < least):
                    least = (value, "".join(letters))
        if least is not None and least[0] <= cost:
            assert least == (cost, audit)
        assert priced(rows, audit) == cost


def priced(rows, letters):
    """Cost of an audit, or None where it does not fit."""
    state, cost, at = repair.START, 0, 0
    for x in letters:
        if x == "I":
            state, cost = repair.FILL[state], cost + 3
            continue
        if at == len(rows):
            return None
        initial, fault = rows[at]
        at += 1
        if x == "D":
            cost += 4
            continue
        if fault in (1, 2) or (x == "K" and (state, initial) not in repair.KEEP):
            return None
        cost += 3 * (fault == 3) + 3 * (x == "R")
        state = repair.KEEP[state, initial] if x == "K" else repair.FILL[state]
    return cost if at == len(rows) and state in (repair.START, repair.ASSISTANT) else None


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.report(repair.damage(none)).count() == 0
    assert repair.repaired(repair.damage(none)).count() == 0
