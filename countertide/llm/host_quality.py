"""Quality rules judged with the host's record (operator 2), in DataFrame operations only.

Every document is measured and tested against rules. The failures of each rule are summed by host, the failure rate
of a host is shrunk towards that of all hosts by a beta prior fitted to the hosts themselves, and the host's verdict
is joined back: documents of a strict host meet narrower limits, documents of a blocked host all go.

Defined results: a null or empty text has no words and fails the base rules; documents without host form one host of
their own; repeated rows are measured and counted each; an empty table gives an empty result; columns that the input
has besides stay untouched unless they bear the name of a measure, which then wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import sized, table
from countertide.llm.registry import query
from countertide.plans.shared import freeze

#: The characters that count as symbols, and those that separate words.
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Shares above which a rule fails: ``*_hard`` anywhere, ``*_strict`` at strict hosts."""

    symbols_hard: float = 0.10  # symbols per word
    symbols_strict: float = 0.05
    dup_lines_hard: float = 0.30  # of the lines that hold a word
    dup_lines_strict: float = 0.15
    repeat_strict: float = 0.30  # of the words; 0.5 is a base rule
    strict_rate: float = 0.30  # shrunk share of failing documents from which a host is strict
    blocked_rate: float = 0.90  # and from which it is blocked


RULES = ("short", "repeat", "symbols", "dup_lines", "any")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of the whole text and a boolean ``fails_*`` for each rule's hard limit."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    blank = F.translate(whole, SEPARATORS[1:], " " * (len(SEPARATORS) - 1))
    inner = docs.withColumn("_words", F.array_remove(F.split(blank, " "), "")).withColumn(
        "_lines", F.filter(F.split(whole, "\n"), lambda x: F.length(F.translate(x, SEPARATORS, "")) > 0)
    )
    n = F.size("_words")
    # A window is known by a 64-bit hash: within one text of a million windows two differ with the same hash
    # about once in 40 million texts.
    windows = F.transform(
        F.slice("_words", F.lit(1), F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")
        ),
    )
    inner = inner.withColumn("_sorted", F.sort_array(windows))
    again = F.filter(
        "_sorted",
        lambda x, i: (x["h"] == F.get("_sorted", i - 1)["h"]) | (x["h"] == F.get("_sorted", i + 1)["h"]),
    )
    inner = inner.withColumn("_places", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda p, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), p - F.get("_places", i - 1))),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    measured = inner.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.translate(whole, SEPARATORS, "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered,
        }
    ).drop("_words", "_lines", "_sorted", "_places")
    return measured


def failing(limits: Limits) -> dict[str, Column]:
    n = F.col("n_words")
    out = {
        "fails_short": n < 50,
        "fails_repeat": 100 * F.col("n_repeat_words") > 50 * n,
        "fails_symbols": F.col("n_symbols") > limits.symbols_hard * n,
        "fails_dup_lines": F.col("n_dup_lines") > limits.dup_lines_hard * F.col("n_lines"),
    }
    any_of = None
    for c in out.values():
        any_of = c if any_of is None else any_of | c
    return out | {"fails_any": any_of}


def host_verdicts(measured: DataFrame, limits: Limits, host: str = "source") -> DataFrame:
    """Failures of each rule by host, shrunk rates, and ``strict`` and ``blocked``: one row for each host.

    Prior of a rule: mean m is the share of all documents that fail, v the variance of the hosts' rates; a + b =
    m (1 - m) / v - 1, at least 1 (and 1 if all hosts have the same rate), a = m (a + b).
    """
    flags = measured.select(F.col(f"`{host}`").alias("host"), *[c.alias(k) for k, c in failing(limits).items()])
    hosts = freeze(
        flags.groupBy("host").agg(
            F.count(F.lit(1)).alias("n_docs"), *[F.count_if(f"fails_{r}").alias(f"k_{r}") for r in RULES]
        ),
        "hosts",
    )
    over = hosts.agg(
        F.sum("n_docs").alias("n"),
        *[F.sum(f"k_{r}").alias(f"k_{r}") for r in RULES],
        *[F.var_pop(F.col(f"k_{r}") / F.col("n_docs")).alias(f"v_{r}") for r in RULES],
    ).first()
    for r in RULES:
        m = over[f"k_{r}"] / over["n"] if over["n"] else 0.0
        v = over[f"v_{r}"] or 0.0
        weight = max(m * (1 - m) / v - 1, 1.0) if v > 1e-12 else 1.0
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"k_{r}") + m * weight) / (F.col("n_docs") + weight))
    return hosts.withColumn("strict", F.col("rate_any") >= limits.strict_rate).withColumn(
        "blocked", F.col("rate_any") >= limits.blocked_rate
    )


def judge(measured: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """``measured`` (a written table) with ``base_failed`` and ``kept``.

    Only strict and blocked hosts are joined back. They are broadcast if few; else both sides are shuffled by host and
    the adaptive skew join splits a host that holds many rows.
    """
    verdicts = host_verdicts(measured, limits, host)
    named = freeze(verdicts.filter("strict").select(F.col("host").alias("_host"), F.col("blocked").alias("_blocked")), "strict_hosts")
    joined = measured.join(sized(named), F.col(f"`{host}`").eqNullSafe(F.col("_host")), "left")
    strict, n = F.col("_blocked").isNotNull(), F.col("n_words")
    narrow = (
        (F.col("n_symbols") > limits.symbols_strict * n)
        | (F.col("n_dup_lines") > limits.dup_lines_strict * F.col("n_lines"))
        | (F.col("n_repeat_words") > limits.repeat_strict * n)
    )
    fails = failing(limits)
    base = fails["fails_short"] | fails["fails_repeat"]
    gone = base | fails["fails_symbols"] | fails["fails_dup_lines"] | (strict & narrow) | F.coalesce("_blocked", F.lit(False))
    return joined.withColumns({"base_failed": base, "kept": ~gone}).drop("_host", "_blocked")


def keep_good(docs: DataFrame, limits: Limits = Limits(), host: str = "source", text: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with.

    Documents and measures are written once, to be aggregated by host and then judged: nested measures in a filter would
    be spelled out again for each of their uses.
    """
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{text}`").alias("_text"), F.col(f"`{host}`").alias("_source"))
    measured = freeze(measure(row, "_text").drop("_text"), "measured")
    kept = judge(measured, limits, "_source").filter("kept")
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in names])


_W = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_W}') AS ws FROM documents
), g AS (
  SELECT r, i, ws[i] || chr(31) || ws[i + 1] || chr(31) || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), d AS (
  SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), p AS (
  SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM d, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r
), l AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM w) WHERE regexp_matches(x, '{_W}') GROUP BY r
), m AS (
  SELECT w.r, doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN p ON p.r = w.r LEFT JOIN l ON l.r = w.r
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols > CAST(0.1 AS DOUBLE) * n_words OR n_dup_lines > CAST(0.3 AS DOUBLE) * n_lines AS hard FROM m
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR hard) AS k FROM f GROUP BY source
), o AS (
  SELECT sum(k) / sum(n) AS m, var_pop(k / n) AS v FROM h
), s AS (
  SELECT m, CASE WHEN v > 1e-12 THEN greatest(m * (1 - m) / v - 1, 1) ELSE 1 END AS weight FROM o
), q AS (
  SELECT source, (k + m * weight) / (n + weight) AS rate FROM h, s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR hard OR rate >= 0.9 OR (rate >= 0.3 AND (
         n_symbols > CAST(0.05 AS DOUBLE) * n_words OR n_dup_lines > CAST(0.15 AS DOUBLE) * n_lines
         OR n_repeat_words > CAST(0.3 AS DOUBLE) * n_words))) AS kept
FROM f JOIN q ON f.source IS NOT DISTINCT FROM q.source
"""


@query("op2_host_quality", ORACLE)
def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = freeze(measure(docs).drop("text"), "measured")
    return judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
