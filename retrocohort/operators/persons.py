"""Sets of persons and their covariates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.operators.summaries import stage_counts
from retrocohort.staging import join_side


def persons_in_all(*frames: DataFrame) -> DataFrame:
    """Persons present in every frame.

    One shuffle: each frame sets its own bit, and repeats of a person collapse
    before they leave the task that read them.
    """
    tagged = [
        frame.select("person_id", F.lit(1 << i).alias("_seen")) for i, frame in enumerate(frames)
    ]
    everywhere = (1 << len(frames)) - 1
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("person_id")
        .agg(F.bit_or("_seen").alias("_seen"))
        .where((F.col("_seen") == everywhere) & F.col("person_id").isNotNull())
        .select("person_id")
    )


def restrict_to(df: DataFrame, keys: DataFrame, on: str = "person_id") -> DataFrame:
    """Rows of ``df`` whose ``on`` value occurs in ``keys``; rows never multiply."""
    return df.join(join_side(keys.select(on).distinct(), False), on, "left_semi")


def distinct_persons(**frames: DataFrame) -> DataFrame:
    """Exact number of distinct persons per named frame, empty ones included: name, n_persons."""
    pairs = [F.struct(F.lit(name).alias("name"), F.col(name).alias("n_persons")) for name in frames]
    return stage_counts(**frames).select(F.inline(F.array(*pairs)))


def person_covariates(persons: DataFrame, index: DataFrame) -> DataFrame:
    """Birth date, gender and race of everyone with an index exposure."""
    return (
        restrict_to(persons, index)
        .select("person_id", "birth_datetime", "gender_concept_id", "race_concept_id")
        .distinct()
        .select(
            "person_id",
            F.to_date("birth_datetime").alias("dob"),
            "gender_concept_id",
            "race_concept_id",
        )
    )


def merge_covariates(covariates: DataFrame, span: DataFrame) -> DataFrame:
    """Covariates with the first and last outpatient exposure, without repeats."""
    return (
        covariates.join(span, "person_id")
        .select(
            "person_id",
            "dob",
            "gender_concept_id",
            "race_concept_id",
            "drug_concept_id",
            "first_drug_exposure",
            "last_drug_exposure",
        )
        .distinct()
    )
