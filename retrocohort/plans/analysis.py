"""From the three extracts to the analysis cohort, its attrition and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retrocohort.functions.scalars import (
    age_years,
    binary_flag,
    binary_flag_null,
    days_between,
)
from retrocohort.operators import periods as P
from retrocohort.operators.concepts import exclude_by_regex, indication_list
from retrocohort.operators.persons import persons_in_all, restrict_to
from retrocohort.operators.summaries import step_counts, table_one
from retrocohort.sources.delimited import read_cohort_covariates
from retrocohort.staging import BROADCAST_BYTES, Lookup, lookup, stage, stored

# OMOP concept ids and the labels of the cohort slices.
FEMALE_CONCEPTS = (8532, 45878463)
WHITE_CONCEPTS = (8527,)
EXCLUDED_MEASUREMENTS = (2212451,)
COHORT_LABELS = {
    "cohort1": "entire_cohort",
    "cohort2": "subgroup3",
    "cohort3": "subgroup1",
    "cohort4": "subgroup2",
}


@dataclass(frozen=True)
class AnalysisParams:
    """Labels and thresholds of the analysis; see the README for the defaults."""

    drug: str
    phenotype: str
    concept_id_exclusions: tuple[int, ...] = EXCLUDED_MEASUREMENTS
    min_exposure_days: int = P.MIN_EXPOSURE_DAYS
    min_age: float = P.MIN_AGE
    race_ids: tuple[int, ...] | None = None
    broadcast_bytes: int = BROADCAST_BYTES


def _short(params: AnalysisParams) -> Column:
    return days_between("first_drug_exposure", "last_drug_exposure") < params.min_exposure_days


class CohortAnalysis:
    """Stages of the analysis; those used more than once are written once.

    The extracts are read several times, so they should be saved tables.
    Restricting an extract to the persons found in all three is left out where
    a later inner join with the periods does it anyway.
    """

    def __init__(
        self,
        covariates: DataFrame,
        drugs: DataFrame,
        biomarkers: DataFrame,
        indication_drugs: DataFrame,
        ingredients: DataFrame,
        params: AnalysisParams,
    ):
        self.covariates = covariates
        self.drugs = drugs
        self.biomarkers = biomarkers
        self.indication_drugs = indication_drugs
        self.ingredients = ingredients
        self.params = params

    @cached_property
    def overlap(self) -> DataFrame:
        """Persons in all three extracts."""
        return persons_in_all(self.biomarkers, self.drugs, self.covariates)

    @cached_property
    def spans(self) -> Lookup:
        """Window and exposure span of exactly the overlapping persons.

        Each of them is in the drugs and in the covariates, so none is lost.
        """
        spans = P.window_with_span(self.drugs, self.covariates)
        return lookup(
            restrict_to(spans, self.overlap), "spans", self.params.broadcast_bytes
        )

    @property
    def periods(self) -> Lookup:
        """Observation periods, a filter on the written spans."""
        kept = P.observation_periods(self.spans.table, self.params.min_exposure_days)
        return Lookup(kept, self.spans.small)

    @cached_property
    def adults(self) -> DataFrame:
        return P.process_covariates(
            self.covariates, self.periods.side, self.params.min_age, self.params.race_ids
        )

    @cached_property
    def exposures(self) -> DataFrame:
        """Ingredient exposures inside the observation periods."""
        mapping = stored(self.ingredients, self.params.broadcast_bytes)
        return P.period_exposures(self.periods, P.to_ingredients(self.drugs, mapping))

    @cached_property
    def indication_exposures(self) -> DataFrame:
        """Exposures to indication drugs other than the studied drug.

        The list shortens the ingredient map first, so only drugs that count
        leave the scan.
        """
        others = exclude_by_regex(self.indication_drugs, "drug_desc", self.params.drug)
        ids = others.select(F.col("rxcui_in").alias("rxcui_ingr")).distinct()
        mapping = lookup(
            self.ingredients.join(ids, "rxcui_ingr", "left_semi"),
            "indication_ingredients",
            self.params.broadcast_bytes,
        )
        return P.period_exposures(self.periods, P.to_ingredients(self.drugs, mapping))

    @cached_property
    def ledger(self) -> Lookup:
        """The adults with a flag for each later selection step, written once.

        Exposures and values only say here whether there are any, so both are
        folded into one number a person before they are shuffled.
        """
        values = P.period_values(self.biomarkers, self.periods, self.params.concept_id_exclusions)
        flags = P.step_flags(self.indication_exposures, values)
        steps = ["drug_exposed", "treatment_new_exposed", "has_change"]
        return lookup(self.adults.join(flags, "person_id", "left").fillna(0, steps), "ledger", self.params.broadcast_bytes)

    @property
    def flagged(self) -> Lookup:
        """The adults with their exposure flags."""
        ledger = self.ledger
        return Lookup(ledger.table.drop("has_change"), ledger.small, ledger.ends, ledger.n_rows)

    @cached_property
    def change(self) -> DataFrame:
        return P.biomarker_change(
            self.biomarkers, self.flagged, self.params.concept_id_exclusions
        )

    @property
    def unexposed(self) -> DataFrame:
        """Flagged persons without indication drugs who have both biomarker values."""
        return self.ledger.table.where((F.col("drug_exposed") == 0) & (F.col("has_change") == 1)).drop("has_change")

    def demographics(self) -> DataFrame:
        return self.unexposed.select(
            "person_id",
            F.lit(self.params.phenotype).alias("phenotype"),
            F.lit(self.params.drug).alias("drug"),
            binary_flag("gender_concept_id", FEMALE_CONCEPTS).alias("is_f"),
            binary_flag("race_concept_id", WHITE_CONCEPTS).alias("is_w"),
            "age",
            days_between("start_date", "final_end_date").alias("observation_period_length_days"),
            days_between("first_drug_exposure", "final_end_date").alias(
                "treatment_period_length_days"
            ),
        ).distinct()

    def attrition(self, outpatient_exposed: bool = False) -> DataFrame:
        short = F.when(_short(self.params), 2).otherwise(4)
        steps = self.spans.table.select("person_id", (F.lit(1) + short).cast("long").alias("_seen"))
        exposed = F.when(F.col("drug_exposed") == 1, 16).when(F.col("has_change") == 1, 32).otherwise(0)
        steps = steps.unionByName(self.ledger.table.select("person_id", (F.lit(8) + exposed).cast("long").alias("_seen")))
        names = [
            "n_overlapping_patients", "less_30_exposure", "n_periods", "n_adults",
            "indication_drug_exposed", "final_cohort_number",
        ]
        if outpatient_exposed:
            names.append("outpatient_exposed")
            steps = steps.unionByName(self.drugs.select("person_id", F.lit(64).cast("long").alias("_seen")))
        row = step_counts(steps, names).withColumn(
            "age_num_removed", F.col("n_periods") - F.col("n_adults")
        )
        kept = ["outpatient_exposed"] if outpatient_exposed else []
        return row.select(
            F.lit(self.params.drug).alias("drug"),
            F.lit(self.params.phenotype).alias("phenotype"),
            *kept,
            "n_overlapping_patients",
            "less_30_exposure",
            "age_num_removed",
            (
                F.col("n_overlapping_patients")
                - F.col("less_30_exposure")
                - F.col("age_num_removed")
                - F.col("indication_drug_exposed")
                - F.col("final_cohort_number")
            ).alias("biomarker_filter"),
            "indication_drug_exposed",
            "final_cohort_number",
        )


def demographics(
    covariates: DataFrame,
    drugs: DataFrame,
    biomarkers: DataFrame,
    indication_drugs: DataFrame,
    ingredients: DataFrame,
    params: AnalysisParams,
) -> DataFrame:
    """One row per person of the unexposed sub-cohort."""
    return CohortAnalysis(
        covariates, drugs, biomarkers, indication_drugs, ingredients, params
    ).demographics()


def cohort_attrition(
    covariates: DataFrame,
    drugs: DataFrame,
    biomarkers: DataFrame,
    indication_drugs: DataFrame,
    ingredients: DataFrame,
    params: AnalysisParams,
    outpatient_exposed: bool = False,
) -> DataFrame:
    """One row: how many persons each selection step removed."""
    return CohortAnalysis(
        covariates, drugs, biomarkers, indication_drugs, ingredients, params
    ).attrition(outpatient_exposed)


TABLE_ONE_CATEGORICAL = ("is_f", "is_w", "drug")
TABLE_ONE_CONTINUOUS = (
    "age",
    "observation_period_length_days",
    "treatment_period_length_days",
)


def demographics_summary(
    covariates: DataFrame,
    drugs: DataFrame,
    biomarkers: DataFrame,
    all_indication_lists: DataFrame,
    ingredients: DataFrame,
    params: AnalysisParams,
) -> DataFrame:
    """Table 1 of the unexposed sub-cohort, with the phenotype's own drug list."""
    drugs_of_phenotype = indication_list(all_indication_lists, params.phenotype)
    persons = demographics(
        covariates, drugs, biomarkers, drugs_of_phenotype, ingredients, params
    )
    return table_one(
        stage(persons, "demographics"), "phenotype", TABLE_ONE_CATEGORICAL, TABLE_ONE_CONTINUOUS
    )


def cohort_characteristics(covariates: DataFrame, treatment_columns: Sequence[str]) -> DataFrame:
    """Flags, age and lengths per row of a covariates file.

    ``treatment_columns`` names the start and end of the treatment.
    """
    start, end = treatment_columns
    return covariates.select(
        "person_id",
        binary_flag_null("gender", "F").alias("is_f"),
        binary_flag_null("race", "W").alias("is_w"),
        age_years("dob", "start_date").alias("age"),
        days_between("start_date", "end_date").alias("obs_length"),
        days_between(start, end).alias("treatment_length"),
    )


def cohort_membership(
    covariates: DataFrame,
    metadata: DataFrame,
    treatment_columns: Sequence[str],
    labels: Mapping[str, str] = COHORT_LABELS,
) -> DataFrame:
    """Characteristics repeated for every cohort slice a person belongs to.

    One pass over the covariates: a person's slices are gathered first, then
    unfolded, instead of one filtered copy per slice.
    """
    member = [
        F.when(F.max((F.col(flag) == 1).cast("int")) == 1, F.lit(label))
        for flag, label in labels.items()
    ]
    slices = metadata.groupBy("person_id").agg(F.array_compact(F.array(*member)).alias("_cohorts"))
    rows = cohort_characteristics(covariates, treatment_columns)
    return (
        rows.join(slices, "person_id")
        .withColumn("cohort", F.explode("_cohorts"))
        .drop("_cohorts")
    )


def cohort_table(
    spark: SparkSession,
    config: DataFrame,
    drug: str,
    metadata: DataFrame,
    schema: T.StructType,
    treatment_columns: Sequence[str],
    labels: Mapping[str, str] = COHORT_LABELS,
) -> DataFrame:
    """Labelled slices of the covariates file that the configuration row of ``drug`` names."""
    covariates = read_cohort_covariates(spark, config, drug, schema)
    return cohort_membership(covariates, metadata, treatment_columns, labels)
