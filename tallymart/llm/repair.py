"""Conversations put back into the form system? (user assistant)+ at the least cost.

Every row is kept (0), given the other role (3) or deleted (4), and empty user or
assistant rows are inserted (3). Blank and repeated rows must go; a row that breaks off
(its last character is no full stop, ! or ?) costs 3 more unless it goes. Of all cheapest
edits those whose initials, read in order, are the ASCII-least are taken (the audit).

The search per conversation is depth-first branch and bound: an explicit stack of prefixes,
for each suffix a lower bound of its cost per state of the form, the incumbent (cost,
audit), and per node (row, state) the least cost that reached it. Children are tried in the
order of their letters, so of two prefixes that reach a node at one cost the first is the
better one, and every later one is dominated. The search ends when the stack is empty.

How it is spread. Rows are reduced to narrow facts (role, digest of the text, fault, count);
equal rows are counted before any shuffle and first mentions are found by a grouping, so
neither repeated rows nor repeated texts meet in one task. A task then streams the facts of
its conversations in order and keeps some bytes per distinct row of one conversation, as
the audit that is asked for does. In a second stream the texts of a conversation pass in
the same order, one batch at a time, behind its edits. Both streams are sorted by Spark and
spill; a conversation is sequential there because its digest is.

Defined cases: null roles and texts are read as one space; rows of one turn are ordered by
role, then by the digest of the text; null turns come first and do not count for gaps; null
conversation ids are one conversation; roles whose first letter is not s, u or a fit nowhere,
an empty role neither; gaps beyond a long are the largest long; conversations without rows
have zeros, an empty audit and the digest of an empty string; repeated rows are duplicates;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table
from tallymart.session import cut_lineage

SPACE = " \t\n\x0b\x0c\r"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)  # states of the form, by the last role
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FILL = (USER, USER, ASSISTANT, USER)  # the state after an inserted or changed row
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
DELETE, CHANGE, INSERT, BREAK = 4, 3, 3, 3
LONGEST = (1 << 63) - 1


# One conversation ----------------------------------------------------------------------------


def suffix_bounds(rows: list[tuple[str, int]]) -> list[list[int]]:
    """bounds[i][state]: what the rows from i on cost at least, whatever the audit."""
    after = [0, 2 * INSERT, INSERT, 0]
    out = [after]
    for initial, fault in reversed(rows):
        each = [DELETE + x for x in after]
        if fault not in (BLANK, DUPLICATE):
            more = BREAK if fault == TRUNCATED else 0
            for state in range(4):
                each[state] = min(each[state], CHANGE + more + after[FILL[state]])
                kept = KEEP.get((state, initial))
                if kept is not None:
                    each[state] = min(each[state], more + after[kept])
        once = [min(each[s], INSERT + each[FILL[s]]) for s in range(4)]
        after = [min(each[s], INSERT + once[FILL[s]]) for s in range(4)]
        out.append(after)
    return out[::-1]


def search(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of (initial, fault) rows."""
    bounds = suffix_bounds(rows)
    best_cost, best = bounds[0][START] + 1, None  # the incumbent; any real one is cheaper
    reached = [[LONGEST] * 4 for _ in range(len(rows) + 1)]
    stack = [(0, START, 0, None)]  # row, state, cost, letters so far as (letter, earlier letters)
    while stack:
        i, state, cost, letters = stack.pop()
        if cost + bounds[i][state] >= best_cost or cost >= reached[i][state]:
            continue
        reached[i][state] = cost
        if i == len(rows) and state in (START, ASSISTANT):
            best_cost, best = cost, letters
            continue
        children = []
        if i < len(rows):
            initial, fault = rows[i]
            children.append((i + 1, state, cost + DELETE, ("D", letters)))
        children.append((i, FILL[state], cost + INSERT, ("I", letters)))
        if i < len(rows) and fault not in (BLANK, DUPLICATE):
            more = BREAK if fault == TRUNCATED else 0
            kept = KEEP.get((state, initial))
            if kept is not None:
                children.append((i + 1, kept, cost + more, ("K", letters)))
            children.append((i + 1, FILL[state], cost + CHANGE + more, ("R", letters)))
        stack.extend(reversed(children))
    out = []
    while best:
        out.append(best[0])
        best = best[1]
    return best_cost, "".join(reversed(out))


@lru_cache(maxsize=50_000)
def _known(initials: str, faults: bytes) -> tuple[int, str]:
    return search(list(zip(initials, faults, strict=True)))


def cheapest(initials: list[str], faults: bytearray) -> tuple[int, str]:
    """Short conversations repeat each other's form, so their answers are remembered."""
    initials = [x if x in "sua" and x else "-" for x in initials]
    if len(initials) <= 32:
        return _known("".join(initials), bytes(faults))
    return search(list(zip(initials, faults, strict=True)))


class _Conversation:
    """Facts of one conversation as they arrive in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.faults = bytearray()
        self.copies: dict[int, int] = {}  # of rows found more than once
        self.count = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, n: int, fault: int) -> None:
        if self.initials and self.initials[-1] + initial not in LEGAL:
            self.illegal += 1
        if turn is not None:
            if turn != self.last:
                self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        if n > 1:
            self.copies[len(self.initials)] = n
            self.illegal += n - 1  # a role next to itself
        self.count[fault] += 1
        self.count[BLANK if fault == BLANK else DUPLICATE] += n - 1
        self.initials.append(initial)
        self.faults.append(fault)

    def result(self) -> tuple:
        cost, edits = cheapest(self.initials, self.faults)
        audit = edits
        if self.copies:
            cost += DELETE * sum(n - 1 for n in self.copies.values())
            row, parts = 0, []
            for letter in edits:
                parts.append(letter)
                if letter != "I":
                    parts.append("D" * (self.copies.get(row, 1) - 1))
                    row += 1
            audit = "".join(parts)
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, LONGEST)
        return (self.conv_id, gaps, self.count[BLANK], self.count[DUPLICATE], self.count[TRUNCATED],
                self.illegal, cost, audit, edits)


EDITS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
         "cost long, audit string, edits string")
_LONGS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
EDITS_ARROW = pa.schema([(c, pa.int64()) for c in _LONGS] + [("audit", pa.string()), ("edits", pa.string())])
REPORT = EDITS.replace("edits string", "repaired_sha256 string")
REPORT_ARROW = pa.schema([*list(EDITS_ARROW)[:-1], ("repaired_sha256", pa.string())])


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some megabytes, counting text only."""
    out, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        out.append(row)
        size += 64 + sum(len(x) for x in row[-2:] if isinstance(x, str))
        if size >= limit:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        now = None
        for batch in batches:
            for conv_id, turn, initial, n, fault in zip(
                    *(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "n", "fault")), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        yield now.result()
                    now = _Conversation(conv_id)
                if n:
                    now.add(turn, initial, n, fault)
        if now is not None:
            yield now.result()

    return _batches(rows(), EDITS_ARROW)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int, str, str]]:
    """(facts of the conversation, position, role, text) of every repaired row, in order;
    position -1 opens a conversation."""
    facts, edits, at, state, position, seen = None, "", 0, START, 0, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, state, position
        while at < len(edits) and edits[at] == "I":
            state, at, position = FILL[state], at + 1, position + 1
            yield facts, position - 1, ROLE[state], ""

    for batch in batches:
        for row in batch.to_pylist():
            if row["edits"] is not None:
                if facts is not None:
                    yield from inserted()
                facts, edits, at, state, position, seen = row, row["edits"], 0, START, 0, None
                yield facts, -1, "", ""
                continue
            if seen == (key := (row["turn"], row["role"], row["digest"])):
                continue  # the further copies of a row go
            seen = key
            yield from inserted()
            letter, at = edits[at], at + 1
            if letter == "D":
                continue
            if letter == "R":
                state, role = FILL[state], ROLE[FILL[state]]
            else:
                role = row["role"]
                state = KEEP[state, role[0]]
            yield facts, position, role, row["text"]
            position += 1
    if facts is not None:
        yield from inserted()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        now, digest = None, None
        for facts, position, role, text in _apply(batches):
            if position < 0:
                if now is not None:
                    yield (*(now[f.name] for f in REPORT_ARROW if f.name in now), digest.hexdigest())
                now, digest = facts, hashlib.sha256()
                continue
            digest.update(("\n" * (position > 0) + role + ":").encode())
            digest.update(text.encode())
        if now is not None:
            yield (*(now[f.name] for f in REPORT_ARROW if f.name in now), digest.hexdigest())

    return _batches(rows(), REPORT_ARROW)


REPAIRED = "conv_id long, position long, role string, text string"
REPAIRED_ARROW = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(((facts["conv_id"], position, role, text)
                     for facts, position, role, text in _apply(batches) if position >= 0), REPAIRED_ARROW)


# All conversations ---------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): n is 0 for a dropped row and 2 for a repeated one."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    code = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("n"))


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form that `damage` gives."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(1).alias("n"))


def _fault(text: Column) -> Column:
    end = F.rtrim(text, F.lit(SPACE))
    return F.when(end == "", BLANK).when(F.substring(end, -1, 1).isin(".", "!", "?"), OK).otherwise(TRUNCATED)


def decide(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, the cost, the audit, and the edits of its distinct rows."""
    there = F.col("n") > 0
    # A dropped row still names its conversation; it sorts first and counts as nothing.
    facts = cut_lineage(rows.select(
        "conv_id", F.when(there, F.col("turn")).alias("turn"), F.when(there, F.col("role")).otherwise("").alias("role"),
        F.when(there, F.md5("text")).otherwise("").alias("digest"), "n",
        F.when(there, _fault(F.col("text"))).otherwise(OK).alias("fault"),
    ).groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("n").alias("n")))
    # Only texts that come at several turns have a later mention to look for.
    again = facts.where((F.col("n") > 0) & (F.col("fault") != BLANK)).groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("_first"), F.bool_or(F.col("turn").isNull()).alias("_null"),
        F.count("*").alias("_turns")).where("_turns > 1").select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "_first", "_null")
    later = F.col("_digest").isNotNull() & F.col("turn").isNotNull() & (F.col("_null") | (F.col("turn") > F.col("_first")))
    marked = facts.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) &
                        (F.col("digest") == F.col("_digest")), "left").select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "n",
        F.when(later, DUPLICATE).otherwise(F.col("fault")).alias("fault"))
    return marked.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "digest").drop("role", "digest").mapInArrow(_decide, EDITS)


def _stream(rows: DataFrame) -> DataFrame:
    """Edits of a conversation, then its rows in order."""
    edits = decide(rows)
    texts = rows.where("n > 0").select("conv_id", "turn", "role", F.md5("text").alias("digest"), "text")
    both = edits.unionByName(texts, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_last("edits"), F.asc_nulls_first("turn"), "role", "digest")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position from 0, role, text."""
    return _stream(rows).mapInArrow(_rows, REPAIRED)


def report(rows: DataFrame) -> DataFrame:
    """Per conversation the faults, cost, audit and the digest of its repaired rows."""
    return _stream(rows).mapInArrow(_digests, REPORT)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(damage(table(spark, sf_dir, "conversations")))


# The same by a step per row over all prefixes: the least (cost, audit) per state is carried on.
ORACLE = r"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
             lambda y, k: xor(y >> 1, (y & 1) * 3988292384))), 4294967295)) % 20 AS code
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, range(CASE code WHEN 3 THEN 2 ELSE 1 END) WHERE code <> 0),
ids AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
numbered AS (
  SELECT conv, d.*, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER w AS i,
         lag(left(role, 1)) OVER w AS before
  FROM damaged d JOIN ids ON ids.conv_id IS NOT DISTINCT FROM d.conv_id
  WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text))),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
steps AS (SELECT * FROM (VALUES (0, 0, ''), (1, 3, 'I'), (2, 6, 'II')) t(inserts, paid, letters)),
filled AS (
  SELECT * FROM (VALUES (0, 0, 0, ''), (1, 0, 1, ''), (2, 0, 2, ''), (3, 0, 3, ''),
    (0, 1, 2, chr(10) || 'user:'), (1, 1, 2, chr(10) || 'user:'), (2, 1, 3, chr(10) || 'assistant:'), (3, 1, 2, chr(10) || 'user:'),
    (0, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'),
    (2, 2, 2, chr(10) || 'assistant:' || chr(10) || 'user:'), (3, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:')
  ) t(state, inserts, next, lines)),
walk AS (
  SELECT conv, 0::BIGINT AS i, f.next AS state, {'cost': s.paid::BIGINT, 'audit': s.letters, 'lines': f.lines} AS best
  FROM ids, steps s JOIN filled f USING (inserts) WHERE f.state = 0
  UNION ALL
  SELECT e.conv, e.i, f.next, min({'cost': e.best.cost + e.pay + s.paid, 'audit': e.best.audit || e.letter || s.letters,
                                   'lines': e.best.lines || e.line || f.lines})
  FROM (
    SELECT w.conv, r.i, w.best, x.letter,
           CASE x.letter WHEN 'D' THEN w.state
             WHEN 'R' THEN CASE w.state WHEN 2 THEN 3 ELSE 2 END
             ELSE CASE WHEN w.state = 0 AND initial = 's' THEN 1 WHEN w.state <> 2 AND initial = 'u' THEN 2
                       WHEN w.state = 2 AND initial = 'a' THEN 3 END END AS state,
           CASE x.letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN x.letter <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS pay,
           CASE x.letter WHEN 'D' THEN '' WHEN 'R' THEN chr(10) || CASE w.state WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || text
             ELSE chr(10) || role || ':' || text END AS line
    FROM walk w JOIN judged r ON r.conv = w.conv AND r.i = w.i + 1, (VALUES ('D'), ('K'), ('R')) x(letter)
    WHERE x.letter = 'D' OR fault NOT IN ('blank', 'duplicate')) e
  JOIN filled f ON f.state = e.state JOIN steps s USING (inserts)
  GROUP BY e.conv, e.i, f.next),
facts AS (
  SELECT conv, count(*) AS rows_, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv),
chosen AS (
  SELECT w.conv, min(best) AS best FROM walk w LEFT JOIN facts f ON f.conv = w.conv
  WHERE w.state IN (0, 3) AND w.i = coalesce(f.rows_, 0) GROUP BY w.conv)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(substr(best.lines, 2)) AS repaired_sha256
FROM ids JOIN chosen ON chosen.conv = ids.conv LEFT JOIN facts ON facts.conv = ids.conv
"""
