"""Quality rules as a ledger of bits.

Every rule is evaluated once. The ledger keeps the measurements and one bit for
each rule that a document fails. Policies are versioned sets of bits; applying
one, or asking what a rule alone removes, reads the ledger and no text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrocohort.llm.texts import words

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Failing conditions by name, in the order of their bits.
RULES: dict[str, Callable[[], Column]] = {
    "short": lambda: F.col("n_words") < 20,
    "repeated_words": lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
    "symbols": lambda: 100 * F.col("n_symbols") > 30 * F.col("n_words"),
    "repeated_lines": lambda: 2 * F.col("n_dup_lines") > F.col("n_lines"),
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words"))
    | (F.col("word_chars") > 20 * F.col("n_words")),
}

BASE = ("short", "repeated_words")

#: Rules that count, by version.
POLICIES: dict[int, tuple[str, ...]] = {1: BASE, 2: tuple(RULES)}
LATEST = max(POLICIES)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(rules: tuple[str, ...]) -> int:
    return reduce(int.__or__, map(bit, rules), 0)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(tokens: Column, width: int = WINDOW) -> Column:
    """Words in windows of ``width`` words that occur twice or more, the first included.

    Windows are compared by 64-bit hashes. Only if some are equal are they
    sorted with their places; the places of equal neighbours, in order, then
    tell how many words they cover.
    """

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - width + 1), lambda i: F.xxhash64(F.slice(h, i, width)))

    def places(s: Column) -> Column:
        equal = lambda e, i: (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"])
        return F.array_sort(F.transform(F.filter(s, lambda e, i: F.coalesce(equal(e, i), F.lit(False))), lambda e: e["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(w: Column) -> Column:
        ranked = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
            _bound(_bound(ranked, places), covered)
        )

    return F.when(F.size(tokens) < width, F.lit(0)).otherwise(
        _bound(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: _bound(windows(h), count))
    )


def measured(docs: DataFrame, *carried: str | Column) -> DataFrame:
    """The ``carried`` columns and the measurements of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    prepared = docs.select(
        F.struct(*carried).alias("row"), text.alias("text"), words(text).alias("words"), lines.alias("lines")
    )
    chars = lambda gone: F.char_length(F.translate("text", gone, ""))
    return prepared.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        chars(" \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (F.char_length("text") - chars(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def _failed() -> Column:
    return reduce(
        lambda a, b: a.bitwiseOR(b), [F.when(rule(), F.lit(bit(n))).otherwise(F.lit(0)) for n, rule in RULES.items()]
    ).cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements and ``failed``, the bits of the rules a row fails.

    NULL text counts as empty, which fails ``short`` only. Repeated rows and
    rows without doc_id are rows like others. Other columns are not read.
    """
    entries = measured(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return entries.select("row.*", *MEASURES, _failed().alias("failed"))


def passes(failed: Column, version: int = LATEST) -> Column:
    """Whether a policy keeps a document."""
    return failed.bitwiseAND(F.lit(mask(POLICIES[version]))) == 0


def ablation(entries: DataFrame, version: int = LATEST) -> DataFrame:
    """rule, n_failed, n_only: documents that fail a rule, and that would stay without it.

    The ledger is first counted by its bits, so that one row per combination is left.
    """
    counts = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))).alias("failed")).count()
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(bit(n)).cast("long").alias("bit")) for n in POLICIES[version]])
    hit = F.when(F.col("failed").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)
    only = F.when(F.col("failed") == F.col("r.bit"), F.col("count")).otherwise(0)
    return (
        counts.select("failed", "count", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(F.sum(hit).alias("n_failed"), F.sum(only).alias("n_only"))
    )


def drop_rejected(docs: DataFrame, version: int = LATEST) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, all columns; evaluated row by row, without a shuffle."""
    return measured(docs, *docs.columns).where(passes(_failed(), version)).select("row.*")
