"""Mixing sources to target weights.

Targets are word budgets by source. A source first gives as many complete
epochs as fit its target. The rest is an Efraimidis-Spirakis sample: each
document draws an exponential key scaled by its quality weight, and the
smallest keys are taken up to the budget. The key at which the budget is spent
is found from sums over pieces of the keys, cut again until few rows are left,
so that only one narrow range of each source is ever put in order; every row
then decides by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retrocohort.llm.texts import unused, word_count
from retrocohort.staging import stage

SYMBOLS = "#*$%&|<>"

# Pieces into which a range of keys is cut.
PIECES = 64


@dataclass(frozen=True)
class Mix:
    """``weights`` go to the sources by code point, NULL last, again and again.

    All targets together are ``percent`` of all words; none is above ``limit``
    times its source. At most ``range_rows`` documents of a source are put in order.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    percent: int = 150
    limit: int = 2
    seed: str = "mix"
    range_rows: int = 20_000


def quality(text: Column, size: Column) -> Column:
    """Share of words among words and symbols, never 0."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
    return (1 + size) / (1 + size + symbols)


def sampling_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """An exponential draw of rate ``weight`` that depends on the doc_id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.ln(uniform) / weight


def targets(by_source: DataFrame, mix: Mix) -> DataFrame:
    """Adds weight, cap and target to one row per source (source, source_size).

    A source is at its cap if its cap per weight is not above what remains per
    weight once all smaller ones are at theirs; the others share that rest by
    weight. One task, one row per source.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(order) - 1, F.lit(len(mix.weights))) + 1
    ranked = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in mix.weights]), nth)).withColumn(
        "cap", mix.limit * F.col("source_size")
    )
    every = Window.partitionBy(F.lit(0))
    by_cap = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_cap.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * mix.percent / F.lit(100.0)
    left = ranked.withColumn("left", total - F.coalesce(F.sum("cap").over(below), F.lit(0))).withColumn(
        "weight_left", F.sum("weight").over(from_here)
    )
    capped = left.withColumn("capped", F.col("cap") * F.col("weight_left") <= F.col("left") * F.col("weight"))
    shared = capped.withColumn(
        "level",
        F.max_by(
            F.when(~F.col("capped"), F.col("left") / F.col("weight_left")),
            F.when(~F.col("capped"), F.col("weight_left")),
        ).over(every),
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return shared.select("source", "source_size", "weight", target.alias("target"))


def _measured(docs: DataFrame, mix: Mix) -> DataFrame:
    text, size = F.col("text").cast("string"), word_count(F.col("text").cast("string"))
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        size.alias("size"),
        sampling_key(F.col("doc_id"), quality(text, size), mix.seed).alias("key"),
    )


def _within(measured: DataFrame, at: DataFrame) -> DataFrame:
    """Rows whose key lies between the ends (low, high) of their source."""
    return measured.join(at, F.col("source").eqNullSafe(F.col("s")) & F.col("key").between(F.col("low"), F.col("high")))


def edges(measured: DataFrame, planned: DataFrame, mix: Mix, n_rows: int) -> DataFrame:
    """(s, low, high, rest): the keys between which each source's budget ends, and the words left for them.

    ``n_rows`` are those of the largest source. While more than ``range_rows``
    rows lie between the ends, they are cut at approximate quantiles of their own
    keys, whatever the keys' distribution, and the piece that the budget ends in
    goes on. A key that is a cut is a piece of its own, so pieces always shrink;
    one key is not cut, as equal rows of it are counted together afterwards.
    """
    ends = F.lit(0.0).alias("low"), F.lit(float("inf")).alias("high")
    at = planned.where("budget > 0").select(F.col("source").alias("s"), *ends, F.col("budget").alias("rest"))
    at = stage(at, "edges")
    fractions = [i / PIECES for i in range(1, PIECES)]
    upto = F.sum("words").over(Window.partitionBy("s").orderBy("piece"))
    while n_rows > mix.range_rows:
        cuts = _within(measured, at).groupBy("s", "low", "high", "rest").agg(
            F.percentile_approx("key", fractions, 100 * PIECES).alias("cuts")
        )
        below = F.size(F.filter("cuts", lambda cut: cut < F.col("key")))
        piece = 2 * below + F.array_contains("cuts", F.col("key")).cast("int")
        found = (
            _within(measured, stage(cuts, "cuts"))
            .withColumn("piece", piece)
            .groupBy("s", "piece", "rest")
            .agg(
                F.sum("size").alias("words"),
                F.count(F.lit(1)).alias("n"),
                F.min("key").alias("low"),
                F.max("key").alias("high"),
            )
            .withColumn("upto", upto)
            .where("upto - words < rest and rest <= upto")
            .select("s", "low", "high", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"), "n")
        )
        found = stage(found, "edges")
        n_rows = found.where("low < high").agg(F.max("n")).first()[0] or 0
        at = found.drop("n")
    return at


def spending_plan(measured: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: source_size, target, epochs, and where the rest of the budget is spent.

    ``last`` is the (key, doc_id, size) that the budget ends in and ``part``
    the words it still gives; smaller ones are taken whole.
    """
    by_source = measured.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_source = stage(by_source, "sources")
    most = by_source.agg(F.max("n_docs")).first()[0] or 0
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    planned = stage(
        targets(by_source.drop("n_docs"), mix)
        .withColumn("epochs", whole)
        .withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")),
        "budgets",
    )
    edge = edges(measured, planned, mix, most)
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    last = (
        _within(measured, edge)
        .groupBy("source", "key", "doc_id", "size", "rest")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum(F.col("size") * F.col("n")).over(inside))
        .where("upto - size * n < rest and rest <= upto")
        .select(
            F.col("source").alias("s"),
            F.struct("key", "doc_id", "size").alias("last"),
            F.floor((F.col("rest") - F.col("upto") + F.col("size") * F.col("n")) / F.col("n")).alias("part"),
        )
    )
    return planned.join(last, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _taken() -> Column:
    """Words a row gives, from its own columns and its source's plan."""
    own = F.struct("key", "doc_id", "size")
    rest = (
        F.when(F.col("last").isNull(), 0).when(own < F.col("last"), F.col("size")).when(own == F.col("last"), F.col("part"))
    )
    return (F.col("epochs") * F.col("size") + F.coalesce(rest, F.lit(0))).cast("long")


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs`` (doc_id, text, source).

    ``taken`` are the words the mix takes of a document, repeats counted; the
    document in which a budget ends gives its first words. NULL text has no
    words, NULL is a source of its own. Rows that share doc_id, size and quality
    draw the same key and give the same number of words. Other columns are not
    read.
    """
    measured = stage(_measured(docs, mix), "measured")
    plan = stage(spending_plan(measured, mix).withColumnRenamed("source", "s"), "plan")
    return measured.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", _taken().alias("taken")
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    The document in which a budget ends is taken whole. Texts are not shuffled:
    the plan has one row per source.
    """
    plan = stage(spending_plan(stage(_measured(docs, mix), "measured"), mix).withColumnRenamed("source", "s"), "plan")
    names = {c: unused(f"mix_{c}", docs) for c in ("s", "epochs", "last")}
    plan = plan.select(*[F.col(c).alias(name) for c, name in names.items()])
    size = word_count(F.col("text").cast("string"))
    key = sampling_key(F.col("doc_id"), quality(F.col("text").cast("string"), size), mix.seed)
    own = F.struct(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"))
    once_more = F.coalesce((own <= F.col(names["last"])).cast("int"), F.lit(0))
    copies = F.array_repeat(F.lit(0), (F.col(names["epochs"]) + once_more).cast("int"))
    copy = unused("mix_copy", docs, plan)
    return (
        docs.join(plan, F.col("source").cast("string").eqNullSafe(F.col(names["s"])))
        .select(*[docs[c] for c in docs.columns], F.explode(copies).alias(copy))
        .drop(copy)
    )
