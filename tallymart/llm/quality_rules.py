"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Every rule rejects a document when one share (symbols, capitals, ...) exceeds a
cutoff. Cutoffs are picked per stratum (language) from a fixed grid on labelled
documents: a cutoff counts as safe when the exact binomial test rejects "more
than `risk` of the good documents fail it". With n good documents of which k
fail, its p-value is P(Bin(n, risk) <= k). Each (stratum, rule) family gets an
equal part of `delta` (Bonferroni); inside a family cutoffs are tested from the
most lenient on and the first failure ends the family (fixed sequence), which
needs no further correction. `risk` is itself divided by the number of rules, so
that with probability 1 - delta no stratum loses more than `risk` of its good
documents to all rules together. Among the safe cutoffs the most lenient one
that catches the most labelled bad documents is used, and none where there is
nothing to catch.

Defined cases: null or empty text has no words and fails the base rule (fewer
than ten words); strata without enough labels get no cutoff, so only the base
rule judges them; null language is a stratum of its own; labels are reduced to
one row per document (the lowest quality wins) and labels without a quality or
document are ignored; repeated rows are judged alike, each on its own; an empty
table gives an empty result; further columns of the input are never read, and
`filter_documents` returns them as they were whatever their names.

Only column functions run here. Equal 5-word windows are found by a 64-bit hash
within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table, words
from tallymart.operators.once import with_columns_once
from tallymart.session import cut_lineage

WINDOW = 5
RISK = 0.05
DELTA = 0.05
GRID = (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02)
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "marks": ("n_marks", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_capitals", "n_marks", "n_lines")


def _left(text: Column, pattern: str) -> Column:
    """Characters that remain once all runs of `pattern` are gone."""
    return F.length(F.regexp_replace(text, pattern, ""))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds a struct `_m` of counts to each row of `docs`; other columns stay."""
    body = F.coalesce(F.col(f"_row.{text}").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"))
    rows = with_columns_once(rows, {"_w": words(body)})
    n = F.size("_w")
    at = [f"xxhash64({', '.join(f'get(_w, i + {k})' for k in range(WINDOW))})"]
    rows = with_columns_once(rows, {"_h": F.when(n >= WINDOW, F.expr(
        f"transform(sequence(0, size(_w) - {WINDOW}), i -> {at[0]})"))})
    rows = with_columns_once(rows, {"_p": F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.expr("sort_array(transform(_h, (x, i) -> struct(x AS h, i AS i)))"))})
    covered = F.expr(f"""
        aggregate(
          sort_array(transform(
            filter(_p, (e, k) -> coalesce(get(_p, k - 1).h = e.h, false)
                              OR coalesce(get(_p, k + 1).h = e.h, false)),
            e -> e.i)),
          struct(0L AS n, -{WINDOW} AS last),
          (a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last),
          a -> a.n)""")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = with_columns_once(rows, {"_l": lines})
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": _left(body, "[^#*$%&|<>]+"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_capitals": _left(body, "[^A-ZÀ-Þ]+"),
        "n_marks": _left(body, "[^!?]+"),
        "n_lines": F.size("_l"),
    }
    return with_columns_once(
        rows.select("_row", "_w", "_p", "_l"),
        {"_m": F.struct(*[counts[c].cast("long").alias(c) for c in COUNTS])},
    ).select("_row", "_m")


def base_failed(m: str = "_m") -> Column:
    return (F.col(f"{m}.n_words") < 10) | (
        100 * F.col(f"{m}.n_repeat_words") > 20 * F.col(f"{m}.n_words"))


def share(rule: str, m: str = "_m") -> Column:
    top, bottom = (F.col(f"{m}.{c}") for c in RULES[rule])
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def binomial_cdf(n: Column, k: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed in logarithms; 1 from the mean on, where no test passes."""
    return F.when(k >= n * risk, 1.0).otherwise(F.exp(F.aggregate(
        F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(
            F.array().cast("array<bigint>")),
        F.struct((n * F.log1p(F.lit(-risk))).alias("term"), (n * F.log1p(F.lit(-risk))).alias("all")),
        lambda a, i: _step(a, i, n, risk),
        lambda a: a["all"],
    )))


def _step(a: Column, i: Column, n: Column, risk: float) -> Column:
    term = a["term"] + F.log((n - i + 1) / i) + F.log(F.lit(risk / (1 - risk)))
    high, low = F.greatest(a["all"], term), F.least(a["all"], term)
    return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("all"))


def choose_cutoffs(judged: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff) from rows (stratum, good boolean, _m); one row per used rule."""
    each = risk / len(RULES)
    grid = F.array(*[F.lit(c) for c in GRID])
    # One row per stratum and truth value: counts above every cutoff of every rule.
    above = [F.count_if(share(r) > c).alias(f"{r}_{i}") for r in RULES for i, c in enumerate(GRID)]
    counts = judged.groupBy("stratum", "good").agg(F.count("*").alias("n"), *above)
    long = counts.select("stratum", "good", "n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.col(f"{r}_{i}").alias("k"))
        for r in RULES for i in range(len(GRID))])).alias("c")).select("stratum", "good", "n", "c.*")
    families = counts.agg((F.count_distinct("stratum") * len(RULES)).alias("families"))
    steps = long.groupBy("stratum", "rule", "step").agg(
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("good"), F.col("k")).otherwise(0)).alias("k"),
        F.sum(F.when(F.col("good"), 0).otherwise(F.col("k"))).alias("caught"),
    ).join(F.broadcast(families))  # one row
    tested = with_columns_once(steps, {"p": binomial_cdf(F.col("n"), F.col("k"), each)})
    # k only grows along the grid, so the safe cutoffs of a family are a prefix of it.
    safe = tested.where((F.col("p") <= delta / F.col("families")) & (F.col("caught") > 0))
    best = safe.groupBy("stratum", "rule").agg(
        F.max(F.struct(F.col("caught"), -F.col("step"))).alias("best"))
    return best.select("stratum", "rule", F.element_at(grid, 1 - F.col("best.col2")).alias("cutoff"))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: Column) -> DataFrame:
    """Adds `_base`, `_failed` (names of failed rules) and `_kept` to measured rows."""
    wide = cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut"))
    rows = measured.withColumn("_s", stratum).join(wide, F.col("_s") == F.col("_stratum"), "left")
    failed = F.array_compact(F.array(*[
        F.when(share(r) > F.try_element_at("_cut", F.lit(r)), F.lit(r)) for r in RULES]))
    return rows.withColumn("_base", base_failed()).withColumn("_failed", F.array_join(failed, ",")) \
        .withColumn("_kept", ~F.col("_base") & (F.col("_failed") == "")) \
        .drop("_s", "_stratum", "_cut")


def _stratum(prefix: str) -> Column:
    return F.coalesce(F.col(f"{prefix}.lang").cast("string"), F.lit(""))


def _calibration(measured: DataFrame, labels: DataFrame) -> DataFrame:
    truth = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL") \
        .groupBy(F.col("doc_id").alias("_id")).agg((F.min("quality") == 1).alias("good"))
    return measured.where(~base_failed()).select(
        F.col("_row.doc_id").alias("_doc"), _stratum("_row").alias("stratum"), "_m"
    ).join(truth, F.col("_doc") == F.col("_id")).select("stratum", "good", "_m")


def rate_documents(docs: DataFrame, labels: DataFrame, risk: float = RISK,
                   delta: float = DELTA) -> DataFrame:
    """One narrow row per document: doc_id, counts, base_failed, failed_rules, kept."""
    measured = measure(docs.select("doc_id", "text", "lang"))
    narrow = cut_lineage(measured.select(F.struct(
        F.col("_row.doc_id").alias("doc_id"), F.col("_row.lang").alias("lang")).alias("_row"), "_m"))
    cutoffs = choose_cutoffs(_calibration(narrow, labels), risk, delta)
    return judge(narrow, cutoffs, _stratum("_row")).select(
        "_row.doc_id", *[f"_m.{c}" for c in COUNTS[:5]],
        F.col("_base").alias("base_failed"), F.col("_failed").alias("failed_rules"),
        F.col("_kept").alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame, risk: float = RISK,
                     delta: float = DELTA) -> DataFrame:
    """The rows of `docs` that all rules keep, unchanged.

    Cutoffs come from a first reading; the second one applies them where the
    text is, so no text is shuffled or written twice.
    """
    first = cut_lineage(_calibration(measure(docs.select("doc_id", "text", "lang")), labels))
    cutoffs = cut_lineage(choose_cutoffs(first, risk, delta))
    return judge(measure(docs), cutoffs, _stratum("_row")).where("_kept").select("_row.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), win AS (
  SELECT r, i, array_to_string(w[i:i+4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) t(i)
), dup AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM (
    SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT r, sum(least(5, i - coalesce(p, i - 5))) AS n FROM dup GROUP BY r
), ln AS (
  SELECT r, count(*) AS n, count(DISTINCT l) AS u
  FROM d, unnest(string_split(text, chr(10))) t(l)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r
), m AS (
  SELECT d.r, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(ln.n - u, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-ZÀ-Þ]+', '', 'g'))::BIGINT AS n_capitals,
    length(regexp_replace(text, '[^!?]+', '', 'g'))::BIGINT AS n_marks, coalesce(ln.n, 0) AS n_lines
  FROM d LEFT JOIN ln USING (r) LEFT JOIN rep USING (r)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
), s AS (
  SELECT r, lang, base_failed, doc_id, t.rule, coalesce(t.v, 0) AS v FROM f, unnest([
    {', '.join(f"{{'rule': '{r}', 'v': {a}::DOUBLE / nullif({b}, 0)}}" for r, (a, b) in RULES.items())}]) u(t)
), truth AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), fam AS (
  SELECT count(DISTINCT lang) * {len(RULES)} AS families FROM f JOIN truth USING (doc_id) WHERE NOT base_failed
), k AS (
  SELECT lang, rule, c, count(*) FILTER (good) AS n, count(*) FILTER (good AND v > c) AS k,
    count(*) FILTER (NOT good AND v > c) AS caught
  FROM s JOIN truth USING (doc_id), unnest([{', '.join(map(str, GRID))}]) t(c)
  WHERE NOT base_failed GROUP BY ALL
), p AS (
  SELECT lang, rule, c, caught, families, CASE WHEN k >= n * {RISK / len(RULES)!r}::DOUBLE THEN 1.0 ELSE (
    SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({RISK / len(RULES)!r}::DOUBLE) + (n - i) * ln({1 - RISK / len(RULES)!r}::DOUBLE)))
    FROM unnest(range(0, k + 1)) t(i)) END AS p
  FROM k, fam
), cut AS (
  SELECT lang, rule, arg_max(c, (caught, c)) AS cutoff FROM p
  WHERE p <= {DELTA} / families AND caught > 0 GROUP BY 1, 2
), bad AS (
  SELECT r, string_agg(s.rule, ',' ORDER BY list_position([{', '.join(repr(r) for r in RULES)}], s.rule)) AS failed
  FROM s JOIN cut USING (lang, rule) WHERE v > cutoff GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(failed, '') AS failed_rules, NOT base_failed AND failed IS NULL AS kept
FROM f LEFT JOIN bad USING (r)
"""
