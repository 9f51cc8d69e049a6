"""Event tables: filters, outpatient visits and per-person date ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.staging import Lookup, join_side

OUTPATIENT_VISIT = 9202

# Copies of one row made per step of repeat_rows.
_COPIES_PER_STEP = 4096


def mapped_exposures(exposures: DataFrame) -> DataFrame:
    """Drug exposures with a mapped drug: neither 0 nor NULL."""
    return exposures.where(F.col("drug_concept_id") != 0).select(
        "person_id", "drug_concept_id", "drug_exposure_start_date"
    )


def of_concepts(events: DataFrame, column: str, concepts: Lookup) -> DataFrame:
    """Events whose ``column`` is in the concept set, repeats kept.

    The ids of a short set are a list in a filter. A longer one is a semi join:
    the optimiser moves it below other joins, next to the scan. Either way the
    least and greatest id of the set reach the scan as a filter.
    """
    events = concepts.within(events, column, "concept_id")
    listed = concepts.values("concept_id")
    if listed:
        return events.where(F.col(column).isin(listed))
    side = concepts.table.select(F.col("concept_id").alias(column))
    return events.join(join_side(side, concepts.small), column, "left_semi")


def bounded_values(measurements: DataFrame, upper: float, lower: float = 0) -> DataFrame:
    """Measurements with lower < value <= upper; NULL values are dropped."""
    value = F.col("value_as_number")
    return measurements.where((value > F.lit(lower)) & (value <= F.lit(upper)))


def outpatient_visits(visits: DataFrame, concept_id: int = OUTPATIENT_VISIT) -> DataFrame:
    """Person and date of every outpatient visit, repeats kept."""
    return visits.where(F.col("visit_concept_id") == F.lit(concept_id)).select(
        "person_id", "visit_start_date"
    )


def visit_days(outpatient: DataFrame, *carried: str) -> DataFrame:
    """One row per person and visit date, with the number of visits on it."""
    return outpatient.groupBy("person_id", "visit_start_date", *carried).agg(
        F.count(F.lit(1)).alias("n_visits")
    )


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times. Two steps keep the generated arrays short."""
    steps = F.floor((F.col(times) - 1) / F.lit(_COPIES_PER_STEP)).cast("long")
    left = F.col(times) - F.col("_step") * F.lit(_COPIES_PER_STEP)
    return (
        df.where(F.col(times) > 0)
        .withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), steps)))
        .withColumn(
            "_copy",
            F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(_COPIES_PER_STEP).cast("long"), left))),
        )
        .drop("_step", "_copy", times)
    )


def at_outpatient_visit(
    events: DataFrame, days: Lookup, date_column: str, keep_duplicates: bool
) -> DataFrame:
    """Events that fall on an outpatient day of the same person.

    ``days`` holds the distinct days from :func:`visit_days`. With
    ``keep_duplicates`` an event appears once per visit on its day, otherwise
    once. The two-part key spreads a person with many rows over their dates.
    The columns that the days carry are added to the events. A table of events
    that is partitioned by date is only read on the days' dates.
    """
    # every day has a visit; a filter on the side lets the optimiser prune partitions by its dates
    side = days.table.where(F.col("n_visits") > 0).withColumnRenamed("visit_start_date", date_column)
    side = join_side(side, days.small)
    keys = ["person_id", date_column]
    events = days.within(events, date_column, "visit_start_date")
    if keep_duplicates:
        return repeat_rows(events.join(side, keys), "n_visits")
    side = side.drop("n_visits")
    return events.join(side, keys, "inner" if len(side.columns) > len(keys) else "left_semi")


def in_window(
    events: DataFrame,
    windows: Lookup,
    date_column: str,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Events inside their person's date range, both ends included, with its columns.

    Ranges that fit a broadcast filter the events where they are read. Beyond
    the bound the ranges are listed by calendar month and joined on person and
    month, which spreads a person with many rows and compares only events
    near a range. Either way the ends of all ranges, where measured, filter the
    scan of the events.
    """
    ranges = windows.table.where(F.col(start) <= F.col(end))
    events = windows.within(events, date_column, start, end)
    inside = F.col(date_column).between(F.col(start), F.col(end))
    if windows.small:
        return events.join(F.broadcast(ranges), "person_id").where(inside)
    months = F.sequence(
        F.trunc(F.col(start), "month"), F.trunc(F.col(end), "month"), F.expr("interval 1 month")
    )
    by_month = ranges.withColumn("_month", F.explode(months))
    return (
        events.withColumn("_month", F.trunc(F.col(date_column), "month"))
        .join(join_side(by_month, False), ["person_id", "_month"])
        .where(inside)
        .drop("_month")
    )


def with_codes(conditions: DataFrame, codes: Lookup) -> DataFrame:
    """Conditions whose source concept is on the code list, repeats kept."""
    side = codes.table.withColumnRenamed("concept_id", "condition_source_concept_id")
    side = join_side(side, codes.small)
    conditions = codes.within(conditions, "condition_source_concept_id", "concept_id")
    return conditions.join(side, "condition_source_concept_id").select(
        "person_id",
        "concept_code",
        F.col("condition_start_date").alias("condition_date"),
        "vocabulary_id",
    )


def coded_conditions(conditions: DataFrame, codes: Lookup) -> DataFrame:
    """Conditions whose source concept is on the code list, without repeats."""
    return with_codes(conditions, codes).distinct()
