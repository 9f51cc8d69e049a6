"""Concept sets from the pre-closed ancestor table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.staging import join_side

DRUG_DOMAIN = "Drug"
MEASUREMENT_DOMAIN = "Measurement"


def concept_set(
    concepts: DataFrame, ancestors: DataFrame, ancestor_id: int, domain: str
) -> DataFrame:
    """Concepts of one domain below ``ancestor_id``: concept_id, concept_name.

    The descendants are not measured, so they are a shuffled join side.
    """
    below = ancestors.where(F.col("ancestor_concept_id") == F.lit(int(ancestor_id))).select(
        F.col("descendant_concept_id").alias("concept_id")
    )
    return (
        concepts.where(F.col("domain_id") == F.lit(domain))
        .select("concept_id", "concept_name")
        .join(join_side(below, False), "concept_id", "left_semi")
        .distinct()
    )


def code_sets(drug_set: DataFrame, biomarker_set: DataFrame) -> DataFrame:
    """Both sets under one roof, tagged 1 (drug) and 2 (biomarker).

    Repeated concepts of a set are one row.
    """
    tagged = [
        part.select(F.lit(tag).alias("codeset_id"), "concept_id", "concept_name")
        for tag, part in ((1, drug_set), (2, biomarker_set))
    ]
    return tagged[0].unionByName(tagged[1]).distinct()


def indication_list(all_lists: DataFrame, phenotype: str) -> DataFrame:
    """Indication drugs of one phenotype; ``ValueError`` when there are none."""
    chosen = all_lists.where(F.col("indication") == F.lit(phenotype))
    if chosen.isEmpty():
        raise ValueError(f"no indication drugs are listed for {phenotype!r}")
    return chosen


def exclude_by_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text does not match; case matters and NULL text is dropped."""
    return df.where(~F.col(column).rlike(pattern))


def exclude_concepts(df: DataFrame, column: str, concept_ids: tuple[int, ...] | list[int]) -> DataFrame:
    """Rows whose concept is not in the list; a NULL concept is in no list."""
    return df.where(F.coalesce(~F.col(column).isin(list(concept_ids)), F.lit(True))) if concept_ids else df
