"""A customer/orders star schema bound to the OMOP-shaped logical tables.

The projection is portable SQL, so the same text also serves as the WITH
prefix of a check in another engine. Names in braces are the inputs. The
modulo terms give each source row deterministic attributes (gender, second
visits, second birth times, ingredients, cohort flags); no query uses them to
read less. Both sides of a join
compute their columns first, so filters on them reach the scan they belong to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retrocohort.sources.tables import CdmTables

# The columns the projection reads. Declared, so opening a table starts no job.
STAR_SCHEMAS: dict[str, str] = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE",
}
STAR_TABLES = tuple(STAR_SCHEMAS)

# The projection's expressions and literals.
VIEW_SQL: dict[str, str] = {
    "person": """
SELECT c_custkey AS person_id,
  CAST(DATE '1930-01-01' + CAST((c_custkey * 7919) % 21000 AS INT) AS TIMESTAMP) AS birth_datetime,
  CAST(CASE c_custkey % 5 WHEN 0 THEN 8532 WHEN 1 THEN 45878463 WHEN 2 THEN NULL ELSE 8507 END AS INT) AS gender_concept_id,
  CAST(CASE c_custkey % 3 WHEN 0 THEN 8527 WHEN 1 THEN 8516 ELSE 8515 END AS INT) AS race_concept_id
FROM {customer}
UNION ALL
SELECT c_custkey, CAST(DATE '1930-01-01' + CAST((c_custkey * 7919) % 21000 AS INT) AS TIMESTAMP) + INTERVAL '1' HOUR,
  CAST(CASE c_custkey % 5 WHEN 0 THEN 8532 WHEN 1 THEN 45878463 WHEN 2 THEN NULL ELSE 8507 END AS INT),
  CAST(CASE c_custkey % 3 WHEN 0 THEN 8527 WHEN 1 THEN 8516 ELSE 8515 END AS INT)
FROM {customer} WHERE c_custkey % 20 = 0""",
    "concept": """
SELECT p_partkey + 1 AS concept_id, p_name AS concept_name, 'Drug' AS domain_id FROM {part}
UNION ALL
SELECT 800000 + s_suppkey, s_name, 'Measurement' FROM {supplier}""",
    "concept_ancestor": """
SELECT CAST(900000 + CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS BIGINT) AS ancestor_concept_id,
  p_partkey + 1 AS descendant_concept_id FROM {part}
UNION ALL
SELECT CAST(910000 + CAST(substr(p_brand, 7) AS INT) AS BIGINT), p_partkey + 1 FROM {part}
UNION ALL
SELECT CAST(850000 + s_nationkey % 2 AS BIGINT), 800000 + s_suppkey FROM {supplier}""",
    "drug_exposure": """
SELECT o.person_id, l.drug_concept_id, o.drug_exposure_start_date
FROM (SELECT o_orderkey, o_custkey AS person_id, CAST(o_orderdate AS DATE) AS drug_exposure_start_date
      FROM {orders}) o
JOIN (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_partkey + 1 END AS drug_concept_id
      FROM {lineitem}) l ON o.o_orderkey = l.l_orderkey""",
    "visit_occurrence": """
SELECT o_custkey AS person_id, CASE o_orderstatus WHEN 'P' THEN 9201 ELSE 9202 END AS visit_concept_id,
  CAST(o_orderdate AS DATE) AS visit_start_date FROM {orders}
UNION ALL
SELECT o_custkey, 9202, CAST(o_orderdate AS DATE) FROM {orders}
WHERE o_orderkey % 10 = 0 AND o_orderstatus <> 'P'""",
    "measurement": """
SELECT o.person_id, l.measurement_concept_id, o.measurement_date, l.value_as_number
FROM (SELECT o_orderkey, o_custkey AS person_id, CAST(o_orderdate AS DATE) AS measurement_date
      FROM {orders}) o
JOIN (SELECT l_orderkey, 800000 + l_suppkey AS measurement_concept_id,
        CASE WHEN l_linenumber = 6 THEN CAST(NULL AS DOUBLE) ELSE l_quantity * 6 - 12 END AS value_as_number
      FROM {lineitem}) l ON o.o_orderkey = l.l_orderkey""",
    "condition_occurrence": """
SELECT o_custkey AS person_id, 700000 + o_orderkey % 50 AS condition_source_concept_id,
  CAST(o_orderdate AS DATE) AS condition_start_date FROM {orders}""",
    "comorbidity_codes": """
SELECT CAST(700000 + n_nationkey AS BIGINT) AS concept_id, n_name AS concept_code,
  CASE WHEN n_regionkey < 3 THEN 'ICD10CM' ELSE 'ICD9CM' END AS vocabulary_id FROM {nation}
UNION ALL
SELECT CAST(700000 + n_nationkey AS BIGINT), n_name, 'ICD10CM' FROM {nation} WHERE n_nationkey = 1""",
    "indication_ancestor": """
SELECT descendant_concept_id FROM {concept_ancestor}
WHERE ancestor_concept_id IN (910001, 910002, 910003)""",
    "drug_to_ingredient": """
SELECT p_partkey + 1 AS drug_concept_id, CAST(substr(p_brand, 7) AS INT) AS rxcui_ingr FROM {part}
WHERE p_partkey % 11 <> 0
UNION ALL
SELECT p_partkey + 1, CAST(substr(p_brand, 7) AS INT) % 4 + 1 FROM {part} WHERE p_partkey % 7 = 0""",
    "indication_drugs": """
SELECT DISTINCT rxcui_ingr AS rxcui_in,
  CASE rxcui_ingr WHEN 1 THEN 'brand one' WHEN 2 THEN 'brand two' ELSE 'target drug tablet' END AS drug_desc,
  'X' AS indication
FROM {drug_to_ingredient} WHERE rxcui_ingr IN (1, 2, 3)""",
    "cohort_metadata": """
SELECT c_custkey AS person_id, 'drug_a' AS drug_name,
  CASE WHEN c_custkey % 10 <> 9 AND c_custkey % 7 <> 6 THEN 1 ELSE 0 END AS cohort1,
  CASE WHEN c_custkey % 4 = 1 AND c_custkey % 7 <> 6 THEN 1 ELSE 0 END AS cohort2,
  CASE WHEN c_custkey % 3 = 0 AND c_custkey % 7 <> 6 THEN 1 ELSE 0 END AS cohort3,
  CASE WHEN c_custkey % 5 = 2 AND c_custkey % 7 <> 6 THEN 1 ELSE 0 END AS cohort4
FROM {customer}""",
    "covariates_file": """
SELECT c_custkey AS person_id,
  CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'F' WHEN 2 THEN NULL ELSE 'M' END AS gender,
  CASE c_custkey % 3 WHEN 0 THEN 'W' WHEN 1 THEN 'B' ELSE 'A' END AS race,
  DATE '1930-01-01' + CAST((c_custkey * 7919) % 21000 AS INT) AS dob,
  DATE '1996-01-01' + CAST((c_custkey * 31) % 1500 AS INT) AS start_date,
  DATE '1998-01-01' + CAST((c_custkey * 31) % 1500 AS INT) AS end_date,
  DATE '1997-01-01' + CAST((c_custkey * 31) % 1500 AS INT) AS treat_start,
  DATE '1997-01-01' + CAST((c_custkey * 31) % 1500 + c_custkey % 365 AS INT) AS treat_end
FROM {customer}""",
    "results": """
SELECT p_partkey AS test_id,
  CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE CAST(1 AS DOUBLE) / (p_partkey * p_partkey + 3) END AS pval
FROM {part}""",
}

# A catalogue of indication drugs with one row per part: the part's type is the
# indication, its brand the ingredient, its name the description.
CATALOGUE_SQL = """
SELECT CAST(substr(p_brand, 7) AS INT) AS rxcui_in, p_name AS drug_desc, p_type AS indication
FROM {part}"""


class StarSchema:
    """Lazy OMOP-shaped views over a folder of star-schema Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._inputs: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._inputs:
            if name in STAR_TABLES:
                self._inputs[name] = self.spark.read.schema(STAR_SCHEMAS[name]).parquet(
                    f"{self.folder}/{name}.parquet"
                )
            else:
                self._inputs[name] = self.project(VIEW_SQL[name])
        return self._inputs[name]

    def project(self, sql: str) -> DataFrame:
        used = [n for n in (*STAR_TABLES, *VIEW_SQL) if f"{{{n}}}" in sql]
        return self.spark.sql(sql, **{n: self.table(n) for n in used})

    def cdm(self) -> CdmTables:
        return CdmTables(
            self.spark, {name: (lambda name=name: self.table(name)) for name in VIEW_SQL}
        )


def with_prefix() -> list[str]:
    """The views as WITH entries over tables named as the star schema's files."""
    names = {name: name for name in (*STAR_TABLES, *VIEW_SQL)}
    return [f"{name} AS ({sql.strip().format(**names)})" for name, sql in VIEW_SQL.items()]
