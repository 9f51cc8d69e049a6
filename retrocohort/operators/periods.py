"""Baseline and treatment periods, exposures inside them, biomarker change.

The thresholds of these steps are keyword arguments; their defaults are the
documented choices listed in the README.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.functions.scalars import age_years, days_between
from retrocohort.operators.concepts import exclude_concepts
from retrocohort.operators.events import in_window
from retrocohort.staging import Lookup, join_side

MIN_EXPOSURE_DAYS = 30
MIN_AGE = 18
BASELINE, TREATMENT = "baseline", "treatment"


def window_with_span(drugs: DataFrame, covariates: DataFrame) -> DataFrame:
    """Each person's window (from the drugs) next to their exposure span."""
    windows = drugs.select("person_id", "start_date", "end_date").distinct()
    spans = covariates.select(
        "person_id", "drug_concept_id", "first_drug_exposure", "last_drug_exposure"
    ).distinct()
    return windows.join(join_side(spans, False), "person_id")


def _exposure_days():
    return days_between("first_drug_exposure", "last_drug_exposure")


def short_exposures(spans: DataFrame, min_days: int = MIN_EXPOSURE_DAYS) -> DataFrame:
    """Spans of fewer than ``min_days`` days, with their length."""
    return spans.withColumn("drug_length", _exposure_days()).where(F.col("drug_length") < min_days)


def observation_periods(spans: DataFrame, min_days: int = MIN_EXPOSURE_DAYS) -> DataFrame:
    """Spans of at least ``min_days`` days, ended at the window's end at the latest."""
    return spans.where(_exposure_days() >= min_days).withColumn(
        "final_end_date", F.least("last_drug_exposure", "end_date")
    )


def to_ingredients(drugs: DataFrame, mapping: Lookup) -> DataFrame:
    """Distinct drug exposures with their ingredient; unmapped drugs drop out.

    The map comes first, so a short map leaves little to deduplicate.
    """
    return (
        drugs.select("person_id", "drug_exposure_start_date", "drug_concept_id")
        .join(mapping.side, "drug_concept_id")
        .select("person_id", "drug_exposure_start_date", "drug_concept_id", "rxcui_ingr")
        .distinct()
    )


def process_covariates(
    covariates: DataFrame,
    periods: DataFrame,
    min_age: float = MIN_AGE,
    race_ids: tuple[int, ...] | None = None,
) -> DataFrame:
    """Persons with a period who are old enough at its start, with their age.

    ``race_ids`` keeps only those races; ``None`` keeps everyone.
    """
    persons = covariates.select(
        "person_id", "dob", "gender_concept_id", "race_concept_id"
    ).distinct()
    if race_ids is not None:
        persons = persons.where(F.col("race_concept_id").isin(list(race_ids)))
    spans = periods.select("person_id", "start_date", "first_drug_exposure", "final_end_date")
    return (
        persons.join(spans, "person_id")
        .withColumn("age", age_years("dob", "start_date"))
        .where(F.col("age") >= min_age)
    )


def _period_label(day: str):
    """Baseline before the first exposure, treatment from it on."""
    return F.when(F.col(day) < F.col("first_drug_exposure"), BASELINE).otherwise(TREATMENT)


def period_exposures(periods: Lookup, ingredients: DataFrame) -> DataFrame:
    """Ingredient exposures inside a person's observation period, labelled by part."""
    spans = Lookup(
        periods.table.select("person_id", "start_date", "first_drug_exposure", "final_end_date"),
        periods.small,
    )
    day = "drug_exposure_start_date"
    return in_window(ingredients, spans, day, end="final_end_date").select(
        "person_id", day, "drug_concept_id", "rxcui_ingr", _period_label(day).alias("period")
    )


def flag_exposure(exposed: DataFrame, covariates: DataFrame) -> DataFrame:
    """Covariates with two 0/1 flags from the indication-drug exposures.

    ``drug_exposed``: any exposure. ``treatment_new_exposed``: exposed during
    treatment and not during baseline.
    """
    in_baseline = F.max((F.col("period") == BASELINE).cast("int"))
    in_treatment = F.max((F.col("period") == TREATMENT).cast("int"))
    flags = exposed.groupBy("person_id").agg(
        F.lit(1).alias("drug_exposed"),
        (in_treatment * (1 - in_baseline)).alias("treatment_new_exposed"),
    )
    return covariates.join(flags, "person_id", "left").fillna(
        0, ["drug_exposed", "treatment_new_exposed"]
    )


def period_values(
    biomarkers: DataFrame, flagged: Lookup, exclude: tuple[int, ...] | list[int] = ()
) -> DataFrame:
    """Values of the flagged persons inside their observation period, labelled by part."""
    spans = Lookup(
        flagged.table.select("person_id", "start_date", "first_drug_exposure", "final_end_date"),
        flagged.small,
    )
    values = (
        exclude_concepts(biomarkers, "measurement_concept_id", exclude)
        .where(F.col("value_as_number").isNotNull())
        .select("person_id", "measurement_date", "value_as_number")
    )
    return in_window(values, spans, "measurement_date", end="final_end_date").select(
        "person_id", _period_label("measurement_date").alias("period"), "value_as_number"
    )


def step_flags(exposed: DataFrame, values: DataFrame) -> DataFrame:
    """Per person whether there are exposures and values in the two parts of the period, from one shuffle.

    ``drug_exposed`` and ``treatment_new_exposed`` are those of
    :func:`flag_exposure`; ``has_change``: a value in both parts.
    """
    baseline = F.col("period") == BASELINE

    def marked(df: DataFrame, first: int, second: int) -> DataFrame:
        return df.select("person_id", F.when(baseline, first).otherwise(second).alias("_seen"))

    seen = marked(exposed, 1, 2).unionByName(marked(values, 4, 8)).groupBy("person_id").agg(F.bit_or("_seen").alias("_seen"))

    def flag(mask: int, wanted: tuple[int, ...]):
        return F.col("_seen").bitwiseAND(mask).isin(*wanted).cast("int")

    return seen.select(
        "person_id",
        flag(3, (1, 2, 3)).alias("drug_exposed"),
        flag(3, (2,)).alias("treatment_new_exposed"),
        flag(12, (12,)).alias("has_change"),
    )


def biomarker_change(
    biomarkers: DataFrame, flagged: Lookup, exclude: tuple[int, ...] | list[int] = ()
) -> DataFrame:
    """Median value in baseline and treatment and their difference, per person.

    Only persons with values in both parts are kept. Equal values are counted
    first, so a person with very many events is one row per distinct value.
    """
    counted = (
        period_values(biomarkers, flagged, exclude)
        .groupBy("person_id", "period", "value_as_number")
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def median(part):
        value = F.when(F.col("period") == part, F.col("value_as_number").cast("double"))
        return F.percentile(value, 0.5, F.col("_n"))

    return (
        counted.groupBy("person_id")
        .agg(median(BASELINE).alias("baseline_value"), median(TREATMENT).alias("treatment_value"))
        .where(F.col("baseline_value").isNotNull() & F.col("treatment_value").isNotNull())
        .withColumn("value_change", F.col("treatment_value") - F.col("baseline_value"))
    )
