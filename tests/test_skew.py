"""One person, one day or one repeated row holds a third of all events."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from retrocohort.operators import events as E
from retrocohort.operators.persons import persons_in_all
from retrocohort.operators.summaries import exact_quantiles
from retrocohort.staging import Lookup, stage

N = 60_000
HOT = N // 3


@pytest.fixture(scope="module")
def skewed(spark):
    """Events of 2,000 persons; person 0 has a third of them, all on one day."""
    number = F.col("id")
    hot = number < HOT
    return stage(
        spark.range(N).select(
            F.when(hot, 0).otherwise(number % 2000).cast("long").alias("person_id"),
            F.when(hot, F.lit("2020-01-01").cast("date"))
            .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (number % 90).cast("int")))
            .alias("event_date"),
            (number % 500).cast("double").alias("value"),
            F.sha2(number.cast("string"), 256).alias("note"),
        ),
        "skewed_events",
    )


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which this little data counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("keep_duplicates", [True, False])
def test_a_hot_day_is_split_and_nothing_is_lost(spark, skewed, small_partitions, keep_duplicates):
    visits = stage(
        skewed.select("person_id", F.col("event_date").alias("visit_start_date"))
        .distinct()
        .withColumn("n_visits", F.lit(2).cast("long")),
        "skewed_days",
    )
    found = E.at_outpatient_visit(skewed, Lookup(visits, False), "event_date", keep_duplicates)
    rows = found.collect()
    assert len(rows) == N * (2 if keep_duplicates else 1)
    assert sum(r["person_id"] == 0 for r in rows) == (HOT + N * 2 // 3 // 2000) * (2 if keep_duplicates else 1)
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_a_hot_person_is_spread_over_months(skewed, small_partitions):
    windows = skewed.select("person_id").distinct().select(
        "person_id",
        F.lit("2020-01-01").cast("date").alias("start_date"),
        F.lit("2020-02-15").cast("date").alias("end_date"),
    )
    found = E.in_window(skewed, Lookup(stage(windows, "skewed_windows"), False), "event_date")
    assert found.count() == skewed.where("event_date <= '2020-02-15'").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_month" in plan and "CartesianProduct" not in plan


def test_repeats_collapse_before_the_shuffle(skewed):
    assert persons_in_all(skewed, skewed).count() == 2000
    plan = persons_in_all(skewed, skewed)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan


def test_median_of_a_hot_person(skewed):
    got = {r["person_id"]: r["m"] for r in exact_quantiles(skewed, ["person_id"], "value", {"m": 0.5}).collect()}
    assert len(got) == 2000
    hot = sorted(r["value"] for r in skewed.where("person_id = 0").select("value").collect())
    middle = len(hot) // 2
    want = hot[middle] if len(hot) % 2 else (hot[middle - 1] + hot[middle]) / 2
    assert got[0] == want


def test_quantiles_count_their_input_once(skewed):
    found = exact_quantiles(skewed, ["person_id"], "value", {"m": 0.5})
    found.collect()
    scans = [s for s in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Relation" in s]
    assert scans and all("_value" in s and "note" not in s for s in scans)  # only the staged counts are read
