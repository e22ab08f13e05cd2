"""Quality rules whose failures are pooled by host: DataFrame functions only.

Each document is measured against base rules. Failures are counted by host (domain, source), each host's rate is shrunk
towards an empirical beta prior fitted to all hosts by moments, and the host's verdict is joined back to its documents:
a host over `max_rate` loses all of them, and one that fails more often than all hosts together has its documents held to
limits that are stricter in proportion (twice the rate: twice the words, half the repeats).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SPACE, WORD, staged


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words of an array that lie in a window of `window` words found twice or more in it, first ones included (null-free input)."""
    n = F.size(words)
    none = F.lit(0).cast("long")

    def cover(h: Column) -> Column:
        """h: the windows' hashes. Positions of repeated ones, in order, then the length of the union of their windows."""
        at = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        twice = F.transform(
            F.array(F.array_sort(at)),
            lambda s: F.array_sort(F.transform(F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])), lambda x: x["i"])),
        )
        zero = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("sum"))
        fold = F.aggregate(twice[0], zero, lambda acc, p: F.struct(p.alias("last"), (acc["sum"] + F.least(F.lit(window), p - acc["last"])).cast("long").alias("sum")))
        return fold["sum"]

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(cover(h))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - F.lit(window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))

    # transform over a one-element array evaluates each step once
    hashed = F.transform(F.array(F.transform(words, lambda x: F.xxhash64(x))), windows)
    return F.when(n < window + 1, none).otherwise(F.transform(hashed, count)[0])


def measure(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) for each row; null texts count as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), text.alias("text"))
    rows = rows.select("id", "host", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    lines = F.transform(F.array(F.filter(F.split("text", "\n", -1), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)), lambda a: F.size(a) - F.size(F.array_distinct(a)))[0]
    return rows.select(
        "id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def base_failed(min_words: int = 20, repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


#: The prior counts as so many documents at most, so that a host's own record always weighs.
MOST_STRENGTH = 100.0
#: A host is stricter only from here on; below that its rate is the pooled one but for rounding.
ABOVE = 1 + 1e-6


def host_rates(measured: DataFrame) -> DataFrame:
    """(host, docs, failed, rate, pooled): the posterior mean failure rate under a beta prior fitted to the hosts' rates, and the rate of all documents.

    Moments over hosts, weighted by documents: m the pooled rate, v the weighted variance of the hosts' rates less what
    sampling alone makes; strength m(1 - m)/v - 1, between 1 and MOST_STRENGTH (that where the hosts don't differ).
    """
    by = measured.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("failed").cast("long")).alias("failed"))
    raw = F.col("failed") / F.col("docs")
    pool = by.agg(F.sum("docs").alias("D"), F.sum("failed").alias("K"), F.count(F.lit(1)).alias("H"), F.sum(F.col("failed") * raw).alias("S"))
    m = F.col("K") / F.col("D")
    v = F.col("S") / F.col("D") - m * m - m * (1 - m) * F.col("H") / F.col("D")
    strength = F.when(v > 0, F.least(F.lit(MOST_STRENGTH), F.greatest(F.lit(1.0), m * (1 - m) / v - 1))).otherwise(F.lit(MOST_STRENGTH))
    prior = pool.select(F.struct(m.alias("m"), strength.alias("k")).alias("prior"))  # one row, a scalar subquery
    told = by.withColumn("prior", prior.scalar())
    m, k = F.col("prior.m"), F.col("prior.k")
    return told.select("host", "docs", "failed", ((F.col("failed") + m * k) / (F.col("docs") + k)).alias("rate"), m.alias("pooled"))


def judge(docs: DataFrame, max_rate: float = 0.5, min_words: int = 20, repeat_percent: int = 30, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    """measure() with base_failed, host_rate, host_strict (by how much the host's limits are stricter, at least 1) and kept.

    kept: not base_failed, the host's rate is at most max_rate, and the document also meets the host's limits of min_words
    times host_strict words and repeat_percent / host_strict percent of repeats. A null host is a host of its own.
    Repeated rows count each. An empty table gives no rows; further columns aren't read.
    """
    measured = staged(measure(docs, text_col, id_col, host_col).withColumn("failed", base_failed(min_words, repeat_percent)), "measures")
    rates = host_rates(measured).select(F.col("host").alias("of"), "rate", "pooled")
    both = measured.join(rates, F.col("host").eqNullSafe(F.col("of")), "left")
    strict = F.when(F.col("rate") > F.col("pooled") * ABOVE, F.col("rate") / F.col("pooled")).otherwise(F.lit(1.0))
    both = both.withColumn("host_strict", strict)
    short = F.col("n_words") < min_words * F.col("host_strict")
    same = 100 * F.col("n_repeat_words") * F.col("host_strict") > repeat_percent * F.col("n_words")
    kept = ~F.col("failed") & (F.col("rate") <= max_rate) & ~short & ~same
    return both.select("id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("failed").alias("base_failed"), F.col("rate").alias("host_rate"), "host_strict", kept.alias("kept"))
