"""Quality rules by document and host, in DataFrame expressions only.

Every document is measured where it is read; hosts are judged on pre-aggregated
counts: a host's failure rate is shrunk towards a beta prior that is fitted to
the hosts (method of moments), and hosts whose shrunk rate is above a limit have
all their documents rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import table, unused

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
HOST_LIMIT = 0.8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more.

    Each window becomes one long: its hash, with the low bits (as many as the
    text's length needs) replaced by its position.  Sorted, equal windows are
    neighbours, whatever the length, without comparing all pairs; neighbours with
    one hash count as equal where their words are.
    """
    shift = lambda kind, x, n: F.call_function(f"shift{kind}", x, n)
    one = F.lit(1).cast("long")

    def covered(w: Column, n: Column, bits: Column) -> Column:
        window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        mark = lambda i: shift("left", shift("right", window(i), bits), bits).bitwiseOR(i.cast("long"))
        at = lambda x: x.bitwiseAND(shift("left", one, bits) - one).cast("int")
        equal = lambda p, q: (F.get(w, p) == F.get(w, q)) & (F.get(w, p + 1) == F.get(w, q + 1)) & (F.get(w, p + 2) == F.get(w, q + 2))
        same = lambda x, y: (shift("right", x, bits) == shift("right", y, bits)) & equal(at(x), at(y))
        twice = lambda s: F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
        place = lambda x: _let(x.bitwiseAND(shift("left", one, bits) - one), lambda p: F.array(p, p + 1, p + 2))
        marks = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), mark))
        return F.size(F.array_distinct(F.flatten(F.transform(_let(marks, twice), place))))

    return _let(
        F.size(words), lambda n: F.when(n < 3, F.lit(0)).otherwise(_let(F.length(F.bin(n)), lambda bits: covered(words, n, bits)))
    ).cast("long")


def measures(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of a text, as a struct."""
    text = F.coalesce(text, F.lit(""))
    count = lambda drop: F.length(F.translate(text, drop, "")).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = _let(
        words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words")),
    )
    return _let(
        base,
        lambda b: F.struct(
            b.n_words.alias("n_words"),
            count(SPACE).alias("word_chars"),
            (F.length(text) - count(SYMBOLS)).cast("long").alias("n_symbols"),
            _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            b.n_repeat_words.alias("n_repeat_words"),
            ((b.n_words < 50) | (100 * b.n_repeat_words > 50 * b.n_words)).alias("base_failed"),
        ),
    )


def rejected_hosts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, rate) of the hosts in (host, base_failed) whose shrunk failure rate is above ``limit``.

    Prior: beta with the mean and variance of the hosts' rates; where they don't
    vary, every host has their mean.  The driver sees two numbers.
    """
    hosts = table(
        measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f"))
    )
    rate = F.col("f") / F.col("n")
    mean, spread = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    if not spread:
        shrunk = F.lit(mean)
    else:
        strength = max(mean * (1 - mean) / spread - 1, 1e-6)
        shrunk = (F.col("f") + mean * strength) / (F.col("n") + strength)
    return hosts.withColumn("rate", shrunk).where(F.col("rate") > limit).select("host", "rate")


def quality_rules(
    docs: DataFrame, limit: float = HOST_LIMIT, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Measures of every document and whether it is kept.

    Returns one row per input row: doc_id, the columns of :func:`measures` and
    kept: not base_failed, and the host's failure rate, shrunk by an empirical beta
    prior, not above ``limit``.  A null text has no words; a null host is a host of
    its own; repeated rows count as often as they occur; other columns are ignored;
    an empty table gives no rows.
    """
    measured = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), measures(F.col(text_col)).alias("m")
    )
    measured = table(measured.select("doc_id", "host", "m.*"))
    bad = table(rejected_hosts(measured, limit)).select(F.col("host").alias("bad"), F.lit(True).alias("is_bad"))
    return measured.join(bad, F.col("host").eqNullSafe(F.col("bad")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("is_bad").isNull()).alias("kept"),
    )


def keep_quality(
    docs: DataFrame, limit: float = HOST_LIMIT, text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns; texts are not shuffled."""
    failed, host, bad = unused(docs, "failed"), F.col(host_col).cast("string"), unused(docs, "bad_host")
    # measured once: the flag is written with the rows, and hosts are judged on what was written
    judged = table(docs.withColumn(failed, measures(F.col(text_col)).base_failed))
    hosts = table(rejected_hosts(judged.select(host.alias("host"), F.col(failed).alias("base_failed")), limit))
    kept = judged.where(~F.col(failed)).join(hosts.select(F.col("host").alias(bad)), host.eqNullSafe(F.col(bad)), "left_anti")
    return kept.select(*docs.columns)
