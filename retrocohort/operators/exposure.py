"""Target-drug exposure: index events, first/last date, the window around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.operators.events import of_concepts
from retrocohort.staging import Lookup


def index_exposures(exposures: DataFrame, drug_set: Lookup, target_id: int) -> DataFrame:
    """Exposures to any drug of the set, labelled with the target drug's id."""
    return of_concepts(exposures, "drug_concept_id", drug_set).select(
        "person_id",
        F.lit(int(target_id)).cast("long").alias("drug_concept_id"),
        "drug_exposure_start_date",
    )


def exposure_span(index_at_visits: DataFrame) -> DataFrame:
    """First and last index exposure per person; partial min/max before the shuffle."""
    day = F.col("drug_exposure_start_date")
    return index_at_visits.groupBy("person_id", "drug_concept_id").agg(
        F.min(day).alias("first_drug_exposure"), F.max(day).alias("last_drug_exposure")
    )


def with_window(span: DataFrame, months: int = 12) -> DataFrame:
    """The span with the dates ``months`` before to ``months`` after the first exposure of each person."""
    first = F.col("first_drug_exposure")
    dates = {"start_date": F.add_months(first, -months), "end_date": F.add_months(first, months)}
    return span.withColumns(dates)


def cohort_window(span: DataFrame, months: int = 12) -> DataFrame:
    """``months`` before to ``months`` after the first exposure of each person."""
    return with_window(span, months).select("person_id", "drug_concept_id", "start_date", "end_date")


def wanted_drugs(indication: DataFrame, drug_set: DataFrame) -> DataFrame:
    """Concept ids of the indication list and of the target set."""
    return (
        indication.select(F.col("descendant_concept_id").alias("concept_id"))
        .union(drug_set.select("concept_id"))
        .distinct()
    )


def select_drugs(drugs: DataFrame, wanted: Lookup) -> DataFrame:
    """Distinct drug rows whose drug is wanted."""
    return of_concepts(drugs, "drug_concept_id", wanted).select(*drugs.columns).distinct()
