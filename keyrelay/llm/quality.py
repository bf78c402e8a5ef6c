"""Quality rules as a bitmask ledger: every rule is evaluated once and sets one bit; policies are masks over the bits.

DataFrame functions only. All measurements come from one pass over each row; nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: ASCII white space that separates words.
GAP = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Rule name -> condition on the measurements under which it fails; a rule's place is its bit, so only ever append.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "capitals": "2 * n_capitals > word_chars",
    "exclamations": "4 * n_exclamations > n_words",
}
BASE = ("few_words", "repeated_windows")
#: Versioned policies: the rules that a document must pass. A new version is added, old ones stay as they are.
POLICIES: dict[str, tuple[str, ...]] = {"v1-base": BASE, "v2": tuple(RULES)}
POLICY = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(map(bit, POLICIES[policy]))


def _repeat_words(words: Column, h: Column, n: Column) -> Column:
    """Words covered by 3-word windows (digests ``h``) that occur twice or more.

    The windows are sorted by digest, equal neighbours give the starts, and each start covers up to 3 words before the
    next one. Texts whose digests are all different need no sort.
    """
    by_digest = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    # a one-element transform binds the sorted array, so that it is sorted once
    starts = F.flatten(F.transform(F.array(by_digest), lambda s: F.transform(
        F.filter(s, lambda e, k: (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"])), lambda e: e["i"])))
    covered = F.transform(F.array(F.array_sort(starts)), lambda s: F.aggregate(
        F.transform(s, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x))
    return F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0).cast("long")).otherwise(covered[0])


def measure(docs: DataFrame, text_col: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct column of measurements and the ledger's failure bits (long).

    Null, empty and wordless texts have no words: all counts are zero and ``few_words`` fails. Repeated rows are measured
    alike, other columns pass through untouched (one named as the new column is replaced), an empty table stays empty.
    """
    text = F.coalesce(F.col("_row._text"), F.lit(""))
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()])
    df = docs.select(F.struct(F.col(text_col).cast("string").alias("_text"), others.alias("_all")).alias("_row"))
    df = df.withColumn("words", F.filter(F.split(text, GAP + "+"), lambda w: w != ""))
    df = df.withColumn("n", F.size("words").cast("long"))
    windows = F.slice(F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))),
                      F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))
    df = df.withColumn("h", windows)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    df = df.select("_row", F.struct(
        F.col("n").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words"), F.col("h"), F.col("n")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), count("[A-Z]").alias("n_capitals"),
        count("!").alias("n_exclamations")).alias("m"))
    failures = " + ".join(f"if({_qualified(c)}, {bit(r)}L, 0L)" for r, c in RULES.items())
    df = df.withColumn("bits", F.expr(failures))
    # the row number (never negative) keeps the optimiser from copying the measurements into later filters, once per use
    ledger = F.when(F.monotonically_increasing_id() >= 0, F.struct("m.*", F.col("bits").alias("fail_bits")))
    return df.select("_row._all.*", ledger.alias(into))


def _qualified(condition: str) -> str:
    return re.sub(r"\b(n_\w+|word_chars)\b", r"m.\1", condition)


def passes(policy: str = POLICY, ledger: str = "quality") -> Column:
    """Whether a row of the ledger passes all rules of a policy."""
    return F.col(f"{ledger}.fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(ledger: DataFrame, policy: str = POLICY, column: str = "quality") -> DataFrame:
    """Per rule of a policy: rows that fail it, and rows that would pass the policy without it.

    The ledger is first reduced to one row per failure pattern (at most 2^rules, combined before the shuffle).
    """
    patterns = ledger.groupBy(F.col(f"{column}.fail_bits").alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    in_policy = F.col("bits").bitwiseAND(F.lit(mask(policy)))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("b"))
                                for r in POLICIES[policy]]))
    each = patterns.withColumn("r", rules).withColumn("bits", in_policy)
    return each.groupBy(F.lit(policy).alias("policy"), F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.b")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.b"), F.col("n")).otherwise(0)).alias("n_regained"))


def passing_documents(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The rows of ``docs``, all columns, that pass a policy."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    return measure(rows).filter(passes(policy)).select("row.*")


def op2_quality(spark, sf_dir):
    """Registered query: the ledger of the whole ``documents`` table under the current policy."""
    q = measure(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("quality.fail_bits").bitwiseAND(F.lit(mask("v1-base"))) != 0
    return q.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                         "n_repeat_words")],
                    base.alias("base_failed"), passes().alias("kept"), "quality.fail_bits")


_FAILS = " + ".join(f"CASE WHEN {c} THEN {bit(r)} ELSE 0 END" for r, c in RULES.items())
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i + 2], ' ') AS g
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
f AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
n AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 3)) AS j FROM f) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(ls) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
             len(regexp_extract_all(text, '!')) AS n_exclamations FROM w LEFT JOIN n USING (r)),
b AS (SELECT *, CAST({_FAILS} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {mask("v1-base")}) <> 0 AS base_failed,
       (fail_bits & {mask(POLICY)}) = 0 AS kept, fail_bits FROM b
"""
