"""Exact quantiles, descriptive tables and stage counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retrocohort.staging import stage

# Parts of a group in the join with its cuts, so that a hot group is not met in one task.
_PARTS = 16
# Cuts of one narrowing, and the accuracy with which they are found.
_CUTS = 100
_ACCURACY = 2000
# Distinct values that one task puts in order at most.
ORDERED_ROWS = 10_000

_PIECE = ["_group", "_piece"]


def _counted(df: DataFrame, by: Sequence[str], value: str) -> tuple[DataFrame, int]:
    """Distinct values per group with their numbers, written, and how many rows that are.

    A struct groups and joins NULL keys like any other value.
    """
    size = Observation()
    counts = (
        df.where(F.col(value).isNotNull())
        .select(F.struct(*by).alias("_group"), F.col(value).cast("double").alias("_value"))
        .groupBy("_group", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .observe(size, F.count(F.lit(1)).alias("rows"))
    )
    return stage(counts, "value_counts"), size.get["rows"]


def _narrowed(pieces: DataFrame, wanted: Callable[[Column, Column], Column]) -> DataFrame:
    """Pieces cut at approximate quantiles of their distinct values; only those that ``wanted`` wants are left.

    A cut is a value that occurs. NaN, the greatest value, has a piece of its own.
    """
    shares = [i / (_CUTS + 1) for i in range(1, _CUTS + 1)]
    number = F.when(~F.isnan("_value"), F.col("_value"))
    cuts = (
        pieces.groupBy(*_PIECE)
        .agg(F.percentile_approx(number, shares, _ACCURACY).alias("_cuts"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
    )
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_value")))
    place = F.when(F.isnan("_value"), _CUTS + 1).otherwise(F.coalesce(below, F.lit(0)))
    cut = (
        pieces.withColumn("_part", F.pmod(F.hash("_value"), F.lit(_PARTS)))
        .join(cuts, [*_PIECE, "_part"])
        .withColumn("_cut", place)
        .drop("_part", "_cuts")
    )
    order = W.partitionBy(*_PIECE).orderBy("_cut")
    totals = (
        cut.groupBy(*_PIECE, "_before", "_total", "_cut")
        .agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_last", F.col("_before") + F.sum("_n").over(order))
        .withColumn("_before", F.col("_last") - F.col("_n"))
        .where(wanted(F.col("_before"), F.col("_last")))
        .select(*_PIECE, "_cut", F.col("_before").alias("_begin"), F.col("_rows").alias("_piece_rows"))
    )
    kept = cut.drop("_before", "_piece_rows").join(totals, [*_PIECE, "_cut"])
    piece = F.concat_ws(".", "_piece", F.col("_cut").cast("string"))
    return kept.select("_group", "_value", "_n", "_total", piece.alias("_piece"), F.col("_begin").alias("_before"), "_piece_rows")


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], ordered_rows: int = ORDERED_ROWS
) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of ``probs``.

    Equal values collapse to counts before the first shuffle. While a piece of
    a group that holds a wanted rank has more than ``ordered_rows`` distinct
    values, it is cut at approximate quantiles of these, and only the pieces
    with wanted ranks go on; so however the values cluster, a cut leaves about
    a hundredth. Then each piece is put in order. NaN is the greatest value,
    NULL values do not count, and a group without others is absent.
    """
    counts, n_rows = _counted(df, by, value)

    # Zero-based rank of each quantile among the sorted values, and its neighbours.
    rank = {name: (F.col("_total") - 1) * F.lit(float(p)) for name, p in probs.items()}
    low = {name: F.floor(r) for name, r in rank.items()}
    high = {name: F.ceil(r) for name, r in rank.items()}

    def wanted(first: Column, last: Column) -> Column:
        ranks = [p for name in probs for p in (low[name], high[name])]
        return reduce(lambda a, b: a | b, [(p >= first) & (p < last) for p in ranks])

    if n_rows <= ordered_rows:
        total = F.sum("_n").over(W.partitionBy("_group"))
        pieces = counts.select("*", F.lit("").alias("_piece"), F.lit(0).alias("_before"), total.alias("_total"))
    else:
        sizes = counts.groupBy("_group").agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_piece_rows"))
        spread = sizes.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
        parted = counts.withColumn("_part", F.pmod(F.hash("_value"), F.lit(_PARTS)))
        whole = parted.join(spread, ["_group", "_part"])
        columns = [F.lit("").alias("_piece"), F.lit(0).cast("long").alias("_before"), "_piece_rows"]
        pieces = whole.select("_group", "_value", "_n", "_total", *columns)
        ready = []
        while True:
            largest = Observation()
            pieces = stage(pieces.observe(largest, F.max("_piece_rows").alias("rows")), "pieces")
            ready.append(pieces.where(F.col("_piece_rows") <= ordered_rows))
            if (largest.get["rows"] or 0) <= ordered_rows:
                break
            pieces = _narrowed(pieces.where(F.col("_piece_rows") > ordered_rows), wanted)
        pieces = reduce(DataFrame.unionByName, ready)

    ordered = pieces.withColumn(
        "_last", F.col("_before") + F.sum("_n").over(W.partitionBy(*_PIECE).orderBy("_value"))
    ).withColumn("_first", F.col("_last") - F.col("_n"))

    def at(position: Column) -> Column:
        return F.max(F.when((position >= F.col("_first")) & (position < F.col("_last")), F.col("_value")))

    picked = ordered.groupBy("_group").agg(
        F.max("_total").alias("_total"),
        *[at(low[name]).alias(f"_low_{name}") for name in probs],
        *[at(high[name]).alias(f"_high_{name}") for name in probs],
    )

    def between(name: str) -> Column:
        below, above = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        share_above = rank[name] - low[name]
        return F.when(below == above, below).otherwise((1 - share_above) * below + share_above * above)

    return picked.select("_group.*", *[between(name).alias(name) for name in probs])


def _long(df: DataFrame, strata: Sequence[str], columns: Sequence[str], kind: str, name: str) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("variable"), F.col(c).cast(kind).alias(name)) for c in columns]
    )
    return df.select(*strata, F.inline(pairs))


def _stats_rows(wide: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in stats]
    )
    return wide.select(*keys, F.inline(pairs))


def categorical_summary(df: DataFrame, strata: str, columns: Sequence[str]) -> DataFrame:
    """Count and percent of every level per stratum; NULL is a level of its own."""
    counts = _long(df, [strata], columns, "string", "level").groupBy(strata, "variable", "level").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(W.partitionBy(strata, "variable"))
    wide = counts.withColumn("pct", F.lit(100.0) * F.col("n") / total)
    return _stats_rows(wide, [strata, "variable", "level"], ["n", "pct"])


def continuous_summary(df: DataFrame, strata: str, columns: Sequence[str]) -> DataFrame:
    """Mean, sample standard deviation, median, minimum, maximum and number of missing values per stratum.

    A variable without values in a stratum has all its rows, with NULL.
    """
    keys = [strata, "variable"]
    measures = _long(df, [strata], columns, "double", "measure")
    moments = measures.groupBy(*keys).agg(
        F.avg("measure").alias("mean"),
        F.stddev_samp("measure").alias("sd"),
        F.min("measure").alias("min"),
        F.max("measure").alias("max"),
        F.count_if(F.col("measure").isNull()).alias("missing"),
    )
    medians = exact_quantiles(measures, keys, "measure", {"median": 0.5}).select(
        F.struct(*keys).alias("_key"), "median"
    )
    wide = moments.withColumn("_key", F.struct(*keys)).join(medians, "_key", "left")
    return _stats_rows(wide, keys, ["mean", "sd", "median", "min", "max", "missing"])


def table_one(
    df: DataFrame, strata: str, categorical: Sequence[str], continuous: Sequence[str]
) -> DataFrame:
    """Demographics summary in long form: stratum, variable, level, stat, value.

    Every stratum also has its number of rows as variable ``N``.
    """
    size = df.groupBy(strata).agg(F.count(F.lit(1)).cast("double").alias("value"))
    size = size.select(
        strata,
        F.lit("N").alias("variable"),
        F.lit(None).cast("string").alias("level"),
        F.lit("n").alias("stat"),
        "value",
    )
    numbers = continuous_summary(df, strata, continuous).withColumn(
        "level", F.lit(None).cast("string")
    )
    return size.unionByName(categorical_summary(df, strata, categorical)).unionByName(numbers)


def describe_lengths(df: DataFrame, column: str) -> DataFrame:
    """One row: minimum, quartiles, mean and maximum of a column."""
    everything = df.select(F.lit(1).alias("_all"), F.col(column).cast("double").alias("_x"))
    quartiles = exact_quantiles(everything, ["_all"], "_x", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    moments = everything.agg(
        F.min("_x").alias("min"), F.avg("_x").alias("mean"), F.max("_x").alias("max")
    )
    stats = _stats_rows(quartiles, [], ["q1", "median", "q3"]).unionByName(
        _stats_rows(moments, [], ["min", "mean", "max"])
    )
    return stats.agg(
        *[
            F.max(F.when(F.col("stat") == name, F.col("value"))).alias(name)
            for name in ("min", "q1", "median", "mean", "q3", "max")
        ]
    )


def step_counts(steps: DataFrame, names: Sequence[str], bits: str = "_seen") -> DataFrame:
    """One row with the exact number of distinct persons of every step.

    ``steps`` has person_id and a number whose bit ``i`` says that the person
    is in step ``names[i]``. Repeats of a person collapse before they leave the
    task that read them, and one row a person is shuffled, however many steps
    there are. A NULL person does not count.
    """
    seen = steps.where(F.col("person_id").isNotNull()).groupBy("person_id").agg(F.bit_or(bits).alias("_seen"))
    return seen.agg(*[F.count_if(F.col("_seen").bitwiseAND(1 << i) != 0).alias(name) for i, name in enumerate(names)])


def stage_counts(**stages: DataFrame) -> DataFrame:
    """One row with the exact number of distinct persons of every stage."""
    tagged = [df.select("person_id", F.lit(1 << i).cast("long").alias("_seen")) for i, df in enumerate(stages.values())]
    return step_counts(reduce(DataFrame.unionByName, tagged), list(stages))
