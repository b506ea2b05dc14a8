"""Personal data, and the words that give it away.

Four kinds are found by fixed patterns and checks: e-mail addresses, IPv4
addresses, card numbers (Luhn) and phone numbers. Each distinct value is a
protected entity. All words of the documents that mention it are candidate
terms, however far away, and the corpus says how much each of them discloses:

    posterior = documents with term and entity / documents with the term
    gain      = log2(posterior * all documents / documents with the entity)

Words have `SHORTEST` letters at least and stand outside e-mail addresses. A term
that occurs with an entity in at least `SUPPORT` different texts is
generalised ("[TERM]") in documents that mention the entity when posterior and
gain exceed their thresholds, and removed when the posterior exceeds `REMOVE`.
Words of the language, and words that occur with many entities, stay.

Positions are code points. A pattern's matches and the gaps between them are two
arrays of the same row, so positions are running sums of their lengths. The
patterns are written so that very long runs take linear time and no deep stack:
possessive repetition where nothing follows, and starts only at the beginning of
a run or at the end of the previous match, where the plain pattern starts too.

Defined cases: null text is empty; documents without findings keep their text;
copies of one text count as one for the support; repeated rows count one by one and are judged alike;
an empty table gives an empty result; only doc_id and text are read, and
`sanitise` returns every other column as it was, whatever its name. Only column
functions run here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table
from tallymart.operators.once import with_columns_once
from tallymart.session import cut_lineage

KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"\p{L}++"
SHORTEST = 3
SUPPORT = 3
POSTERIOR = 0.5
REMOVE = 0.8
GAIN = 6.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (
            F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _split_once(df: DataFrame, text: Column, patterns: dict[str, str]) -> DataFrame:
    """Adds `_m_x` (matches) and `_g_x` (gaps, null without matches) for each pattern x."""
    df = with_columns_once(df, {
        f"_m_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    return with_columns_once(df, {
        f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(text, p, -1)) for k, p in patterns.items()})


def _placed(kind: str) -> Column:
    """Matches of one pattern as (kind, start, end, i); null where there is none."""
    return F.expr(f"""
        aggregate(sequence(0, size(_m_{kind}) - 1),
          struct(0L AS at, CAST(array() AS array<struct<s: bigint, e: bigint, i: int>>) AS out),
          (a, i) -> struct(
            a.at + length(get(_g_{kind}, i)) + length(get(_m_{kind}, i)) AS at,
            array_append(a.out, named_struct(
              's', a.at + length(get(_g_{kind}, i)),
              'e', a.at + length(get(_g_{kind}, i)) + length(get(_m_{kind}, i)),
              'i', i)) AS out),
          a -> a.out)""")


def _spans(kind: str) -> Column:
    found = F.filter(_placed(kind), lambda x: _valid(kind, F.get(F.col(f"_m_{kind}"), x["i"])))
    return F.when(F.size(f"_m_{kind}") > 0, found)


def _mentioned(kind: str) -> Column:
    """The entities of one kind's valid mentions."""
    return F.coalesce(F.transform(f"_s_{kind}", lambda x: F.xxhash64(
        F.lit(kind), F.lower(F.get(F.col(f"_m_{kind}"), x["i"])))), F.array().cast("array<bigint>"))


def _words(text: Column) -> Column:
    """The distinct lower-case words outside e-mail addresses; no other mention holds letters."""
    outside = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, KINDS["email"], " ")).otherwise(text)
    every = F.transform(F.regexp_extract_all(outside, F.lit(WORD), F.lit(0)), lambda w: F.lower(w))
    return F.filter(F.array_distinct(every), lambda w: F.length(w) >= SHORTEST)


def _text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, `_h` (hash of the text), `_s_<kind>` spans, `_entities` and `_words` per document.

    `_words` is null without entities.
    """
    rows = docs.select("doc_id", _text().alias("_t"), F.xxhash64(_text()).alias("_h"))
    rows = _split_once(rows, F.col("_t"), KINDS)
    rows = with_columns_once(rows, {f"_s_{k}": _spans(k) for k in KINDS})
    rows = with_columns_once(rows, {"_entities": F.array_distinct(F.concat(*[_mentioned(k) for k in KINDS]))})
    return rows.select("doc_id", "_h", *[
        F.coalesce(F.transform(f"_s_{k}", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))),
                   F.array().cast("array<struct<s: bigint, e: bigint>>")).alias(f"_s_{k}")
        for k in KINDS], "_entities", F.when(F.size("_entities") > 0, _words(F.col("_t"))).alias("_words"))


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(_h, entity, term, removed): the terms of a text that give away an entity it mentions.

    `found` is what `detect` returned, written. Counts cover all of `docs`. What cannot
    pass goes early: both <= with_entity, so a term needs with_term < with_entity / POSTERIOR,
    and posterior <= 1, so an entity needs with_entity < total / 2^GAIN.
    """
    total, least = found.count(), 2.0 ** GAIN
    mentions = found.where(F.size("_entities") > 0)
    held = cut_lineage(mentions.select("_h", F.explode("_entities").alias("entity")).groupBy(
        "_h", "entity").agg(F.count("*").alias("n")))
    entities = held.groupBy("entity").agg(
        F.sum("n").alias("with_entity"), F.count("*").alias("texts")).where(
        (F.col("texts") >= SUPPORT) & (F.col("with_entity") * least < total)).drop("texts")
    held = cut_lineage(held.join(entities, "entity"))
    terms = cut_lineage(docs.select(F.explode(_words(_text())).alias("term")).groupBy("term").agg(
        F.count("*").alias("with_term")).where(F.col("with_term") >= SUPPORT))
    rare = F.col("with_term") * POSTERIOR * least < total
    # At most 2^GAIN * POSTERIOR times the distinct words of an average document.
    frequent = F.broadcast(terms.where(~rare).select("term"))
    most = held.groupBy("_h").agg(F.max("with_entity").alias("_most"))
    each = mentions.groupBy("_h").agg(F.first("_words").alias("_words")).join(most, "_h").select(
        "_h", "_most", F.explode("_words").alias("term"))
    each = each.join(frequent, "term", "left_anti").join(terms.where(rare), "term").where(
        F.col("with_term") * POSTERIOR < F.col("_most")).drop("_most")
    both = cut_lineage(each.join(held, "_h").where(F.col("with_term") * POSTERIOR < F.col("with_entity")))
    posterior = F.col("both") / F.col("with_term")
    pairs = both.groupBy("entity", "term").agg(
        F.sum("n").alias("both"), F.count("*").alias("texts"), F.first("with_term").alias("with_term"),
        F.first("with_entity").alias("with_entity")).where(F.col("texts") >= SUPPORT).select(
        "entity", "term", (posterior > REMOVE).alias("removed"), posterior.alias("posterior"),
        F.log2(posterior * total / F.col("with_entity")).alias("gain"),
    ).where((F.col("posterior") > POSTERIOR) & (F.col("gain") > GAIN)).select("entity", "term", "removed")
    return both.select("_h", "entity", "term").join(pairs, ["entity", "term"])


def document_terms(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document with such terms: `_id`, `_th` and the terms to remove and to generalise."""
    # At most the distinct words of one document.
    own = pairs.groupBy("_h").agg(
        F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("_drop"),
        F.collect_set(F.when(~F.col("removed"), F.col("term"))).alias("_mask"))
    return found.where(F.size("_entities") > 0).select("doc_id", "_h").distinct().join(own, "_h").select(
        F.col("doc_id").alias("_id"), F.col("_h").alias("_th"), "_drop", "_mask")


def _with_terms(rows: DataFrame, terms: DataFrame, how: str) -> DataFrame:
    return rows.join(terms, rows["doc_id"].eqNullSafe(terms["_id"]) & (rows["_h"] == terms["_th"]), how)


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, `_h` and `_s_term`: where the disclosing terms of a document stand."""
    rows = docs.select("doc_id", _text().alias("_t"), F.xxhash64(_text()).alias("_h"))
    rows = _with_terms(rows, terms, "inner").select(
        "doc_id", "_h", "_t", F.concat("_drop", "_mask").alias("_terms"))
    rows = _split_once(rows, F.col("_t"), {"email": KINDS["email"]})
    blank = F.concat(F.transform("_m_email", lambda m: F.repeat(F.lit(" "), F.length(m))), F.array(F.lit("")))
    rows = with_columns_once(rows, {"_b": F.when(F.size("_m_email") > 0, F.array_join(F.zip_with(
        "_g_email", blank, lambda g, m: F.concat(g, m)), "")).otherwise(F.col("_t"))})
    rows = _split_once(rows, F.col("_b"), {"term": WORD})
    rows = with_columns_once(rows, {"_s": F.filter(_placed("term"), lambda x: F.array_contains(
        F.col("_terms"), F.lower(F.get(F.col("_m_term"), x["i"]))))})
    return rows.select("doc_id", "_h", F.transform("_s", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"))).alias("_s_term")).groupBy("doc_id", "_h").agg(
        F.first("_s_term").alias("_s_term"))


def _named(kind: str) -> Column:
    return F.transform(f"_s_{kind}", lambda x: F.concat_ws(
        ":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def find(docs: DataFrame) -> DataFrame:
    """One row per document: counts and spans of the four kinds, and the spans of all kinds."""
    found = cut_lineage(detect(docs))
    terms = cut_lineage(document_terms(found, disclosing(docs, found)))
    spans = cut_lineage(term_spans(docs, terms)).select(
        F.col("doc_id").alias("_id"), F.col("_h").alias("_th"), "_s_term")
    base = F.concat(*[_named(k) for k in KINDS])
    return _with_terms(found, spans, "left").withColumn(
        "_s_term", F.coalesce("_s_term", F.array().cast("array<struct<s: bigint, e: bigint>>"))).select(
        "doc_id", *[F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _named("term")), ",").alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with personal data replaced in `text`; `n_chars` follows the text.

    Kinds are replaced one after the other ("[EMAIL]", ...), then terms.
    """
    found = cut_lineage(detect(docs))
    terms = cut_lineage(document_terms(found, disclosing(docs, found)))
    rows = docs.select(F.struct("*").alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), _text("_row.text").alias("_t"),
                       F.xxhash64(_text("_row.text")).alias("_h"))
    rows = _with_terms(rows, terms, "left").select("_row", "_t", "_drop", "_mask")
    for kind, pattern in KINDS.items():
        rows = _split_once(rows, F.col("_t"), {"x": pattern})
        rows = _woven(rows, F.transform("_m_x", _masked(kind)))
    rows = _split_once(rows, F.when(F.col("_drop").isNotNull(), F.col("_t")), {"x": WORD})
    new = F.transform("_m_x", lambda v: F.when(F.array_contains("_drop", F.lower(v)), "")
                      .when(F.array_contains("_mask", F.lower(v)), "[TERM]").otherwise(v))
    rows = _woven(rows, new)
    text = F.when(F.col("_row.text").isNotNull(), F.col("_t"))
    out = F.col("_row").withField("text", text)
    if "n_chars" in docs.columns:
        out = out.withField("n_chars", F.coalesce(
            F.length(text).cast("long"), F.col("_row.n_chars").cast("long")))
    return rows.select(out.alias("_row")).select("_row.*")


def _masked(kind: str) -> Callable[[Column], Column]:
    return lambda value: F.when(_valid(kind, value), f"[{kind.upper()}]").otherwise(value)


def _woven(rows: DataFrame, new: Column) -> DataFrame:
    """`_t` with its matches replaced by `new`, put between the gaps again."""
    rows = with_columns_once(rows, {"_n": F.when(F.size("_m_x") > 0, F.concat(new, F.array(F.lit(""))))})
    text = F.when(F.col("_n").isNull(), F.col("_t")).otherwise(F.array_join(F.zip_with(
        "_g_x", "_n", lambda g, m: F.concat(g, m)), ""))
    return with_columns_once(rows, {"_u": text}).select(
        "_row", F.col("_u").alias("_t"), "_drop", "_mask")


def op9_disclosing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
