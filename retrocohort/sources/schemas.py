"""Declared columns of the source tables and of the extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_LONG, _INT, _STRING, _DATE = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
_DOUBLE, _TIMESTAMP = T.DoubleType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SOURCES: dict[str, T.StructType] = {
    "concept": _schema(concept_id=_LONG, concept_name=_STRING, domain_id=_STRING),
    "concept_ancestor": _schema(ancestor_concept_id=_LONG, descendant_concept_id=_LONG),
    "drug_exposure": _schema(person_id=_LONG, drug_concept_id=_LONG, drug_exposure_start_date=_DATE),
    "visit_occurrence": _schema(person_id=_LONG, visit_concept_id=_INT, visit_start_date=_DATE),
    "person": _schema(
        person_id=_LONG, birth_datetime=_TIMESTAMP, gender_concept_id=_INT, race_concept_id=_INT
    ),
    "measurement": _schema(
        person_id=_LONG, measurement_concept_id=_LONG, measurement_date=_DATE, value_as_number=_DOUBLE
    ),
    "condition_occurrence": _schema(
        person_id=_LONG, condition_source_concept_id=_LONG, condition_start_date=_DATE
    ),
    "comorbidity_codes": _schema(concept_id=_LONG, concept_code=_STRING, vocabulary_id=_STRING),
    "indication_ancestor": _schema(descendant_concept_id=_LONG),
    "drug_to_ingredient": _schema(drug_concept_id=_LONG, rxcui_ingr=_INT),
    "indication_drugs": _schema(rxcui_in=_INT, drug_desc=_STRING, indication=_STRING),
    "cohort_metadata": _schema(
        person_id=_LONG, drug_name=_STRING, cohort1=_INT, cohort2=_INT, cohort3=_INT, cohort4=_INT
    ),
    "covariates_file": _schema(
        person_id=_LONG,
        gender=_STRING,
        race=_STRING,
        dob=_DATE,
        start_date=_DATE,
        end_date=_DATE,
        treat_start=_DATE,
        treat_end=_DATE,
    ),
    "results": _schema(test_id=_LONG, pval=_DOUBLE),
}

EXTRACTS: dict[str, T.StructType] = {
    "covariates": _schema(
        person_id=_LONG,
        dob=_DATE,
        gender_concept_id=_INT,
        race_concept_id=_INT,
        drug_concept_id=_LONG,
        first_drug_exposure=_DATE,
        last_drug_exposure=_DATE,
    ),
    "drugs": _schema(
        person_id=_LONG,
        start_date=_DATE,
        end_date=_DATE,
        drug_exposure_start_date=_DATE,
        drug_concept_id=_LONG,
    ),
    "biomarkers": _schema(
        person_id=_LONG,
        start_date=_DATE,
        measurement_date=_DATE,
        end_date=_DATE,
        measurement_concept_id=_LONG,
        value_as_number=_DOUBLE,
    ),
    "conditions": _schema(
        person_id=_LONG, concept_code=_STRING, condition_date=_DATE, vocabulary_id=_STRING
    ),
}


def require_columns(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """``df`` reduced to ``columns``; ``ValueError`` names those it lacks."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in columns if name.lower() not in present]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df.select(*columns)
