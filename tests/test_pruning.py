"""Bloom filters, listed values and pruned partitions: what they drop, and that they lose nothing."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from retrocohort.operators import events as E
from retrocohort.plans import extracts as EX
from retrocohort.staging import Lookup, bloom, lookup
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n_keys", [0, 1, 1000, 20_000])
def test_bloom_filter_keeps_every_key_and_few_others(spark, n_keys):
    keys = lookup(spark.range(n_keys).select((F.col("id") * 7919 + 5).alias("person_id")), "keys")
    found = bloom(keys, "person_id")
    events = spark.range(200_000).select((F.col("id") * 7919 + 5).alias("person_id"))
    events = events.unionByName(spark.createDataFrame([(None,)], "person_id long"))
    kept = found.keep(events, "person_id").cache()
    assert kept.join(keys.table, "person_id", "left_semi").count() == n_keys
    assert kept.count() - n_keys <= 0.05 * 200_000
    assert kept.columns == ["person_id"]


def test_bloom_filter_has_a_bound(spark):
    keys = lookup(spark.range(10_000).withColumnRenamed("id", "person_id"), "keys")
    assert bloom(keys, "person_id", broadcast_bytes=0) is None
    assert bloom(keys, "person_id", broadcast_bytes=1000) is None  # a few words for so many keys would let all pass
    assert bloom(keys, "person_id", broadcast_bytes=200_000).words.count() <= 200_000 // 104


def _study(spark, broadcast_bytes):
    return entry_point.Study(spark, FOLDER, replace(entry_point.PARAMS, broadcast_bytes=broadcast_bytes))


EXTRACTS = {
    "drugs": lambda s: EX.drugs_extract(s.cdm, s.params, s.cohort),
    "biomarkers": lambda s: EX.biomarkers_extract(s.cdm, s.params, s.cohort),
    "conditions": lambda s: EX.conditions_extract(s.cdm, s.params, s.cohort),
}


@pytest.fixture(scope="module")
def studies(spark):
    """With all lookups broadcast, with the Bloom filter of the persons only, and without any broadcast."""
    return {size: _study(spark, size) for size in (1 << 26, 60_000, 0)}


@pytest.mark.parametrize("kind", EXTRACTS)
def test_extracts_are_equal_however_the_events_are_filtered(studies, kind):
    found = [rows(EXTRACTS[kind](s)) for s in studies.values()]
    assert found[0] and found[0] == found[1] == found[2]


def test_bloom_filter_drops_events_below_the_shuffle(spark, studies):
    study = studies[60_000]
    cohort = study.cohort
    assert not cohort.persons.small and not cohort.window.small and cohort.person_filter is not None
    events = E.mapped_exposures(study.get("drug_exposure"))
    kept = cohort._of_persons(events)
    wanted = events.join(cohort.persons.table, "person_id", "left_semi").count()
    assert wanted <= kept.count() <= wanted + 0.05 * events.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(EXTRACTS["biomarkers"](study))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # in the text of a plan inputs stand below: the filter is an input of the exchange on person and date
    assert plan.index("hashpartitioning(person_id") < plan.index("_bits")
    assert studies[1 << 26].cohort.person_filter is None and studies[0].cohort.person_filter is None


def test_short_concept_sets_are_lists_at_the_scan(spark, tmp_path):
    events = spark.range(1000).select(F.col("id").alias("person_id"), (F.col("id") % 100).alias("drug_concept_id"))
    events.write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    few = lookup(spark.createDataFrame([(3,), (90,), (None,)], "concept_id long"), "few")
    found = E.of_concepts(events, "drug_concept_id", few)
    assert "drug_concept_id IN (3,90)" in found._jdf.queryExecution().optimizedPlan().toString() or "IN (3,90)" in _plan(found)
    assert "Join" not in _plan(found)
    assert found.count() == 20
    assert E.of_concepts(events, "drug_concept_id", lookup(few.table.limit(0), "none")).count() == 0
    many = lookup(spark.range(2000).withColumnRenamed("id", "concept_id"), "many")
    assert many.values("concept_id") is None and "Join" in _plan(E.of_concepts(events, "drug_concept_id", many))
    assert E.of_concepts(events, "drug_concept_id", many).count() == 1000
    assert E.of_concepts(events, "drug_concept_id", Lookup(few.table, False)).count() == 20


@pytest.mark.parametrize("small", [True, False])
def test_partitions_by_date_are_pruned(spark, tmp_path, small):
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 50).cast("int"))
    events = spark.range(1000).select((F.col("id") % 20).alias("person_id"), F.col("id").alias("value"), day.alias("measurement_date"))
    events.write.partitionBy("measurement_date").parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    days = spark.createDataFrame([(1, "2000-01-02", 2), (2, "2000-02-11", 1)], "person_id long, visit_start_date string, n_visits long")
    days = lookup(days.withColumn("visit_start_date", F.col("visit_start_date").cast("date")), "days")
    if small:
        found = E.at_outpatient_visit(events, days, "measurement_date", keep_duplicates=False)
    else:
        cohort = EX.Cohort(None, entry_point.PARAMS)
        ranges = days.table.selectExpr("person_id", "visit_start_date AS start_date", "visit_start_date AS end_date")
        cohort.__dict__ |= {"days": Lookup(days.table, False, days.ends, days.n_rows), "ranges": Lookup(ranges, True)}
        found = cohort.at_days(events, "measurement_date", once=False)
    assert "dynamicpruning" in _plan(found).lower()
    want = events.join(days.table.withColumnRenamed("visit_start_date", "measurement_date"), ["person_id", "measurement_date"])
    copies = 1 if small else 2
    assert found.count() == sum(r.n_visits if copies == 2 else 1 for r in want.collect()) > 0


def test_ledger_equals_the_steps_one_by_one(spark):
    study = entry_point.Study(spark, FOLDER)
    from retrocohort.operators import periods as P

    one = study.analysis
    flagged = P.flag_exposure(one.indication_exposures, one.adults)
    assert rows(one.flagged.table) == rows(flagged)
    values = P.period_values(one.biomarkers, one.flagged, one.params.concept_id_exclusions)
    both = values.groupBy("person_id").agg(F.count_distinct("period").alias("n")).where("n = 2")
    free = one.flagged.table.where("drug_exposed = 0").join(both, "person_id", "left_semi")
    assert rows(one.unexposed) == rows(free)
