"""The registered queries as plain SQL over the same Parquet tables.

Written stage by stage in the order a warehouse would run them, without the
rewrites of the Spark pipelines: windows before visits, deduplication by GROUP
BY, one filtered copy per cohort.
"""

from __future__ import annotations

from retrocohort.sources.star_schema import CATALOGUE_SQL, with_prefix

STAGES: dict[str, str] = {
    "drug_set": """
SELECT c.concept_id, c.concept_name FROM concept c
JOIN concept_ancestor a ON c.concept_id = a.descendant_concept_id
WHERE c.domain_id = 'Drug' AND a.ancestor_concept_id = 900001
GROUP BY c.concept_id, c.concept_name""",
    "biomarker_set": """
SELECT c.concept_id, c.concept_name FROM concept c
JOIN concept_ancestor a ON c.concept_id = a.descendant_concept_id
WHERE c.domain_id = 'Measurement' AND a.ancestor_concept_id = 850000
GROUP BY c.concept_id, c.concept_name""",
    "index_exposure": """
SELECT e.person_id, CAST(900001 AS BIGINT) AS drug_concept_id, e.drug_exposure_start_date
FROM drug_exposure e JOIN drug_set d ON e.drug_concept_id = d.concept_id""",
    "op_visit": """
SELECT person_id, visit_start_date FROM visit_occurrence WHERE visit_concept_id = 9202""",
    "span": """
SELECT i.person_id, i.drug_concept_id, min(i.drug_exposure_start_date) AS first_drug_exposure,
  max(i.drug_exposure_start_date) AS last_drug_exposure
FROM index_exposure i
JOIN op_visit v ON i.person_id = v.person_id AND i.drug_exposure_start_date = v.visit_start_date
GROUP BY i.person_id, i.drug_concept_id""",
    "obs_window": """
SELECT person_id, drug_concept_id,
  CAST(first_drug_exposure - INTERVAL 12 MONTH AS DATE) AS start_date,
  CAST(first_drug_exposure + INTERVAL 12 MONTH AS DATE) AS end_date
FROM span""",
    "index_person": """
SELECT p.person_id, CAST(p.birth_datetime AS DATE) AS dob, p.gender_concept_id, p.race_concept_id
FROM person p JOIN index_exposure i ON p.person_id = i.person_id
GROUP BY p.person_id, p.birth_datetime, p.gender_concept_id, p.race_concept_id""",
    "covariates": """
SELECT p.person_id, p.dob, p.gender_concept_id, p.race_concept_id, s.drug_concept_id,
  s.first_drug_exposure, s.last_drug_exposure
FROM index_person p JOIN span s ON p.person_id = s.person_id
GROUP BY ALL""",
    "drug_in_window": """
SELECT w.person_id, w.start_date, w.end_date, e.drug_concept_id, e.drug_exposure_start_date
FROM obs_window w JOIN drug_exposure e ON w.person_id = e.person_id
WHERE e.drug_concept_id <> 0 AND e.drug_exposure_start_date >= w.start_date
  AND e.drug_exposure_start_date <= w.end_date""",
    "drugs_all": """
SELECT d.person_id, d.start_date, d.end_date, d.drug_exposure_start_date, d.drug_concept_id
FROM drug_in_window d
JOIN op_visit v ON d.person_id = v.person_id AND d.drug_exposure_start_date = v.visit_start_date
GROUP BY ALL""",
    "drugs": """
SELECT d.* FROM drugs_all d JOIN indication_ancestor i ON d.drug_concept_id = i.descendant_concept_id
UNION
SELECT d.* FROM drugs_all d JOIN drug_set s ON d.drug_concept_id = s.concept_id""",
    "biomarkers": """
SELECT w.person_id, w.start_date, m.measurement_date, w.end_date, m.measurement_concept_id, m.value_as_number
FROM obs_window w
JOIN measurement m ON w.person_id = m.person_id
JOIN biomarker_set b ON m.measurement_concept_id = b.concept_id
JOIN op_visit v ON m.person_id = v.person_id AND m.measurement_date = v.visit_start_date
WHERE m.value_as_number > 0 AND m.value_as_number <= 250
  AND m.measurement_date >= w.start_date AND m.measurement_date <= w.end_date""",
    "coded": """
SELECT c.person_id, k.concept_code, c.condition_start_date AS condition_date, k.vocabulary_id
FROM condition_occurrence c JOIN comorbidity_codes k ON c.condition_source_concept_id = k.concept_id
GROUP BY ALL""",
    "conditions": """
SELECT c.person_id, c.concept_code, c.condition_date, c.vocabulary_id
FROM coded c
JOIN obs_window w ON c.person_id = w.person_id
  AND c.condition_date >= w.start_date AND c.condition_date <= w.end_date
JOIN op_visit v ON c.person_id = v.person_id AND c.condition_date = v.visit_start_date
GROUP BY ALL""",
    "overlap": """
SELECT DISTINCT b.person_id FROM (SELECT DISTINCT person_id FROM biomarkers) b
JOIN (SELECT DISTINCT person_id FROM drugs) d ON b.person_id = d.person_id
JOIN (SELECT DISTINCT person_id FROM covariates) c ON b.person_id = c.person_id""",
    "spans": """
SELECT d.person_id, d.start_date, d.end_date, c.drug_concept_id, c.first_drug_exposure, c.last_drug_exposure
FROM (SELECT DISTINCT person_id, start_date, end_date FROM drugs) d
JOIN (SELECT DISTINCT person_id, drug_concept_id, first_drug_exposure, last_drug_exposure FROM covariates) c
  ON d.person_id = c.person_id
WHERE d.person_id IN (SELECT person_id FROM overlap)""",
    "periods": """
SELECT *, least(last_drug_exposure, end_date) AS final_end_date FROM spans
WHERE date_diff('day', first_drug_exposure, last_drug_exposure) >= 30""",
    "ingredients": """
SELECT d.person_id, d.drug_exposure_start_date, d.drug_concept_id, m.rxcui_ingr
FROM (SELECT DISTINCT person_id, drug_exposure_start_date, drug_concept_id FROM drugs
      WHERE person_id IN (SELECT person_id FROM overlap)) d
JOIN drug_to_ingredient m ON d.drug_concept_id = m.drug_concept_id""",
    "aged": """
SELECT *, CAST((date_diff('month', dob, start_date)
    - CASE WHEN day(start_date) < day(dob) AND start_date <> last_day(start_date) THEN 1 ELSE 0 END) // 12
    AS BIGINT) AS whole
FROM (SELECT DISTINCT c.person_id, c.dob, c.gender_concept_id, c.race_concept_id, p.start_date,
        p.first_drug_exposure, p.final_end_date
      FROM covariates c JOIN periods p ON c.person_id = p.person_id)""",
    "adults": """
SELECT person_id, dob, gender_concept_id, race_concept_id, start_date, first_drug_exposure, final_end_date, age
FROM (SELECT *, whole + CAST(date_diff('day', CAST(dob + to_years(whole) AS DATE), start_date) AS DOUBLE)
        / date_diff('day', CAST(dob + to_years(whole) AS DATE), CAST(dob + to_years(whole + 1) AS DATE)) AS age
      FROM aged)
WHERE age >= 18""",
    "exposures": """
SELECT p.person_id, i.drug_exposure_start_date, i.drug_concept_id, i.rxcui_ingr,
  CASE WHEN i.drug_exposure_start_date < p.first_drug_exposure THEN 'baseline' ELSE 'treatment' END AS period
FROM periods p JOIN ingredients i ON p.person_id = i.person_id
WHERE i.drug_exposure_start_date >= p.start_date AND i.drug_exposure_start_date <= p.final_end_date""",
    "indication_exposures": """
SELECT * FROM exposures WHERE rxcui_ingr IN
  (SELECT rxcui_in FROM indication_drugs WHERE NOT regexp_matches(drug_desc, 'target'))""",
    "flagged": """
SELECT a.*,
  CASE WHEN EXISTS (SELECT 1 FROM indication_exposures e WHERE e.person_id = a.person_id)
    THEN 1 ELSE 0 END AS drug_exposed,
  CASE WHEN EXISTS (SELECT 1 FROM indication_exposures e WHERE e.person_id = a.person_id AND e.period = 'treatment')
    AND NOT EXISTS (SELECT 1 FROM indication_exposures e WHERE e.person_id = a.person_id AND e.period = 'baseline')
    THEN 1 ELSE 0 END AS treatment_new_exposed
FROM adults a""",
    "change": """
SELECT *, treatment_value - baseline_value AS value_change FROM (
  SELECT b.person_id,
    median(CASE WHEN b.measurement_date < f.first_drug_exposure THEN b.value_as_number END) AS baseline_value,
    median(CASE WHEN b.measurement_date >= f.first_drug_exposure THEN b.value_as_number END) AS treatment_value
  FROM biomarkers b JOIN flagged f ON b.person_id = f.person_id
  WHERE b.measurement_concept_id NOT IN (800005)
    AND b.measurement_date >= f.start_date AND b.measurement_date <= f.final_end_date
  GROUP BY b.person_id)
WHERE baseline_value IS NOT NULL AND treatment_value IS NOT NULL""",
    "demographics": """
SELECT DISTINCT f.person_id, 'X' AS phenotype, 'target' AS drug,
  CASE WHEN f.gender_concept_id IN (8532, 45878463) THEN 1 ELSE 0 END AS is_f,
  CASE WHEN f.race_concept_id = 8527 THEN 1 ELSE 0 END AS is_w,
  f.age,
  CAST(date_diff('day', f.start_date, f.final_end_date) AS INT) AS observation_period_length_days,
  CAST(date_diff('day', f.first_drug_exposure, f.final_end_date) AS INT) AS treatment_period_length_days
FROM flagged f JOIN change c ON f.person_id = c.person_id
WHERE f.drug_exposed = 0""",
    "characteristics": """
SELECT person_id,
  CASE WHEN gender IS NULL THEN NULL WHEN gender = 'F' THEN 1 ELSE 0 END AS is_f,
  CASE WHEN race IS NULL THEN NULL WHEN race = 'W' THEN 1 ELSE 0 END AS is_w,
  round(whole + CAST(date_diff('day', CAST(dob + to_years(whole) AS DATE), start_date) AS DOUBLE)
    / date_diff('day', CAST(dob + to_years(whole) AS DATE), CAST(dob + to_years(whole + 1) AS DATE)), 6) AS age,
  CAST(date_diff('day', start_date, end_date) AS INT) AS obs_length,
  CAST(date_diff('day', treat_start, treat_end) AS INT) AS treatment_length
FROM (SELECT *, CAST((date_diff('month', dob, start_date)
        - CASE WHEN day(start_date) < day(dob) AND start_date <> last_day(start_date) THEN 1 ELSE 0 END) // 12
        AS BIGINT) AS whole FROM covariates_file)""",
    "membership": " UNION ALL ".join(
        f"""
SELECT c.*, '{label}' AS cohort FROM characteristics c
WHERE c.person_id IN (SELECT person_id FROM cohort_metadata WHERE {flag} = 1)"""
        for flag, label in (
            ("cohort1", "entire_cohort"),
            ("cohort3", "subgroup1"),
            ("cohort4", "subgroup2"),
            ("cohort2", "subgroup3"),
        )
    ),
    "indication_catalogue": CATALOGUE_SQL.format(part="part"),
}


def _table_one_categorical() -> str:
    return " UNION ALL ".join(
        f"""
SELECT phenotype, '{name}' AS variable, CAST({name} AS VARCHAR) AS level, stat,
  CASE stat WHEN 'n' THEN CAST(n AS DOUBLE) ELSE round(100.0 * n / sum_n, 6) END AS value
FROM (SELECT phenotype, {name}, count(*) AS n, sum(count(*)) OVER (PARTITION BY phenotype) AS sum_n
      FROM demographics GROUP BY phenotype, {name})
CROSS JOIN (VALUES ('n'), ('pct')) AS s(stat)"""
        for name in ("is_f", "is_w", "drug")
    )


def _table_one_continuous() -> str:
    return " UNION ALL ".join(
        f"""
SELECT phenotype, '{name}' AS variable, '{stat}' AS stat, round(CAST({call}({name}) AS DOUBLE), 6) AS value
FROM demographics GROUP BY phenotype"""
        for name in ("age", "observation_period_length_days", "treatment_period_length_days")
        for stat, call in (
            ("mean", "avg"),
            ("sd", "stddev_samp"),
            ("median", "median"),
            ("min", "min"),
            ("max", "max"),
            ("missing", "count(*) - count"),
        )
    )


FINAL: dict[str, str] = {
    "concept_set": "SELECT * FROM drug_set",
    "code_sets": """SELECT 1 AS codeset_id, concept_id, concept_name FROM drug_set
UNION SELECT 2, concept_id, concept_name FROM biomarker_set""",
    "outpatient_visits": "SELECT * FROM op_visit",
    "mapped_exposures": """SELECT person_id, drug_concept_id, drug_exposure_start_date FROM drug_exposure
WHERE drug_concept_id <> 0""",
    "bounded_measurements": """SELECT person_id, measurement_concept_id, measurement_date, value_as_number
FROM measurement WHERE value_as_number > 0 AND value_as_number <= 250""",
    "excluded_measurements": """SELECT person_id, measurement_concept_id, measurement_date, value_as_number
FROM measurement WHERE measurement_concept_id NOT IN (800005)""",
    "index_exposures": "SELECT * FROM index_exposure",
    "outpatient_exposures": """SELECT i.* FROM index_exposure i WHERE EXISTS (SELECT 1 FROM op_visit v
WHERE v.person_id = i.person_id AND v.visit_start_date = i.drug_exposure_start_date)""",
    "exposure_span": "SELECT * FROM span",
    "cohort_window": "SELECT * FROM obs_window",
    "events_in_window": "SELECT * FROM drug_in_window",
    "person_covariates": "SELECT * FROM index_person",
    "covariates_extract": "SELECT * FROM covariates",
    "drugs_extract_all": "SELECT * FROM drugs_all",
    "drugs_extract_selected": "SELECT * FROM drugs",
    "selected_drugs": "SELECT * FROM drugs",
    "saved_extract": "SELECT * FROM drugs",
    "outpatient_biomarkers": """SELECT m.person_id, m.measurement_date, m.measurement_concept_id, m.value_as_number
FROM measurement m JOIN biomarker_set b ON m.measurement_concept_id = b.concept_id
JOIN op_visit v ON m.person_id = v.person_id AND m.measurement_date = v.visit_start_date
WHERE m.value_as_number > 0 AND m.value_as_number <= 250""",
    "biomarkers_extract": "SELECT * FROM biomarkers",
    "coded_conditions": "SELECT * FROM coded",
    "conditions_extract": "SELECT * FROM conditions",
    "normalized_extracts": """
SELECT 'r_c' AS bundle, person_id, dob AS date_1, first_drug_exposure AS date_2, last_drug_exposure AS date_3,
  drug_concept_id AS concept_id FROM covariates
UNION ALL SELECT 'r_d', person_id, start_date, end_date, drug_exposure_start_date, drug_concept_id FROM drugs
UNION ALL SELECT 'r_b', person_id, start_date, end_date, measurement_date, measurement_concept_id FROM biomarkers""",
    "persons_in_all": "SELECT * FROM overlap",
    "restricted_drugs": "SELECT * FROM drugs WHERE person_id IN (SELECT person_id FROM overlap)",
    "distinct_persons": """SELECT 'covariates' AS name, count(DISTINCT person_id) AS n_persons FROM covariates
UNION ALL SELECT 'drugs', count(DISTINCT person_id) FROM drugs
UNION ALL SELECT 'biomarkers', count(DISTINCT person_id) FROM biomarkers""",
    "window_with_span": "SELECT * FROM spans",
    "short_exposures": """SELECT *, CAST(date_diff('day', first_drug_exposure, last_drug_exposure) AS INT) AS drug_length
FROM spans WHERE date_diff('day', first_drug_exposure, last_drug_exposure) < 30""",
    "observation_periods": "SELECT * FROM periods",
    "drug_ingredients": """SELECT d.person_id, d.drug_exposure_start_date, d.drug_concept_id, m.rxcui_ingr
FROM (SELECT DISTINCT person_id, drug_exposure_start_date, drug_concept_id FROM drugs) d
JOIN drug_to_ingredient m ON d.drug_concept_id = m.drug_concept_id""",
    "adult_covariates": "SELECT * REPLACE (round(age, 6) AS age) FROM adults",
    "age_years": "SELECT person_id, age FROM characteristics",
    "sex_race_flags": """SELECT person_id,
  CASE WHEN gender_concept_id IN (8532, 45878463) THEN 1 ELSE 0 END AS is_f,
  CASE WHEN race_concept_id = 8527 THEN 1 ELSE 0 END AS is_w FROM person""",
    "period_exposures": "SELECT * FROM exposures",
    "indication_list": """SELECT rxcui_in, drug_desc, indication FROM indication_catalogue
WHERE indication = 'PROMO' AND NOT regexp_matches(drug_desc, 'ring|^red')""",
    "subanalysis_flags": "SELECT * REPLACE (round(age, 6) AS age) FROM flagged",
    "biomarker_change": "SELECT * FROM change",
    "demographics": "SELECT * REPLACE (round(age, 6) AS age) FROM demographics",
    "cohort_attrition": """
SELECT 'target' AS drug, 'X' AS phenotype, n_overlapping_patients, less_30_exposure, age_num_removed,
  n_overlapping_patients - less_30_exposure - age_num_removed - indication_drug_exposed - final_cohort_number
    AS biomarker_filter, indication_drug_exposed, final_cohort_number
FROM (SELECT (SELECT count(*) FROM overlap) AS n_overlapping_patients,
  (SELECT count(DISTINCT person_id) FROM spans
   WHERE date_diff('day', first_drug_exposure, last_drug_exposure) < 30) AS less_30_exposure,
  (SELECT count(DISTINCT person_id) FROM periods) - (SELECT count(DISTINCT person_id) FROM adults) AS age_num_removed,
  (SELECT count(DISTINCT person_id) FROM flagged WHERE drug_exposed = 1) AS indication_drug_exposed,
  (SELECT count(DISTINCT person_id) FROM demographics) AS final_cohort_number)""",
    "table_one_categorical": _table_one_categorical(),
    "table_one_continuous": _table_one_continuous(),
    "cohort_file_scan": "SELECT * FROM covariates_file",
    "cohort_characteristics": "SELECT * FROM characteristics",
    "cohort_membership": "SELECT * FROM membership",
    "observation_length_summary": """SELECT CAST(min(n) AS DOUBLE) AS min, quantile_cont(n, 0.25) AS q1,
  median(n) AS median, round(avg(n), 6) AS mean, quantile_cont(n, 0.75) AS q3, CAST(max(n) AS DOUBLE) AS max
FROM (SELECT CAST(obs_length AS DOUBLE) AS n FROM characteristics)""",
    "format_pvalues": "SELECT test_id, printf('%.2E', pval) AS pval FROM results",
    "results_file": "SELECT test_id, printf('%.2E', pval) AS pval FROM results",
    "repaired_names": """SELECT test_id, pval AS p_percent, test_id * 2 AS p_percent_2, 'a;b' AS groe_g,
  CAST(test_id % 7 AS INT) AS x2nd_number FROM results""",
    "rejected_fields": """
SELECT "column", type, count(*) AS n, min(text) AS least_text, max(text) AS greatest_text FROM (
  SELECT 'dob' AS "column", 'date' AS type, 'unknown ' || person_id % 3 AS text FROM covariates_file WHERE person_id % 5 = 0
  UNION ALL SELECT 'end_date', 'date', '2001-02-30' FROM covariates_file WHERE person_id % 11 = 0
  UNION ALL SELECT 'person_id', 'bigint', 'P' || person_id FROM covariates_file WHERE person_id % 13 = 0)
GROUP BY ALL""",
    "preview_rows": """SELECT * FROM results WHERE pval < 0.05 ORDER BY pval, test_id LIMIT 100""",
}


def oracle(name: str) -> str:
    """Query ``name`` with the views and stages it may use as its WITH prefix."""
    stages = [f"{stage} AS ({sql.strip()})" for stage, sql in STAGES.items()]
    return "WITH " + ",\n".join([*with_prefix(), *stages]) + "\n" + FINAL[name].strip()
