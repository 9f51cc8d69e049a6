import pytest

from retrocohort.operators import periods as P
from retrocohort.operators import persons as R
from retrocohort.operators.concepts import exclude_by_regex
from retrocohort.plans.analysis import AnalysisParams, CohortAnalysis, cohort_membership
from tests.conftest import rows

SPAN = (
    "person_id long, start_date date, end_date date, drug_concept_id long, "
    "first_drug_exposure date, last_drug_exposure date"
)


@pytest.fixture
def spans(frame):
    return frame(
        [
            (1, "2019-01-01", "2021-01-01", 5, "2020-01-01", "2020-01-30"),
            (2, "2019-01-01", "2021-01-01", 5, "2020-01-01", "2020-01-31"),
            (3, "2019-01-01", "2021-01-01", 5, "2020-01-01", "2022-01-01"),
        ],
        SPAN,
    )


def test_exposure_of_29_days_is_short_and_30_is_kept(spans):
    assert [(r["person_id"], r["drug_length"]) for r in P.short_exposures(spans).collect()] == [(1, 29)]
    kept = P.observation_periods(spans)
    assert rows(kept.select("person_id", "final_end_date")) == [(2, "2020-01-31"), (3, "2021-01-01")]
    assert P.observation_periods(spans, min_days=0).count() == 3


def test_window_with_span_collapses_repeats(frame):
    drugs = frame(
        [(1, "2019-01-01", "2021-01-01", 7), (1, "2019-01-01", "2021-01-01", 8), (2, "2019-01-01", "2021-01-01", 8)],
        "person_id long, start_date date, end_date date, drug_concept_id long",
    ).drop("drug_concept_id")
    covariates = frame(
        [(1, 5, "2020-01-01", "2020-02-01")] * 2 + [(3, 5, "2020-01-01", "2020-02-01")],
        "person_id long, drug_concept_id long, first_drug_exposure date, last_drug_exposure date",
    )
    assert rows(P.window_with_span(drugs, covariates)) == [
        (1, "2019-01-01", "2021-01-01", 5, "2020-01-01", "2020-02-01")
    ]


def test_persons_in_all_and_restriction(frame):
    a = frame([(1,), (1,), (2,), (None,)], "person_id long")
    b = frame([(1,), (2,), (3,), (None,)], "person_id long")
    c = frame([(1,), (1,), (None,)], "person_id long")
    assert rows(R.persons_in_all(a, b, c)) == [(1,)]
    assert rows(R.persons_in_all(a, b)) == [(1,), (2,)]
    assert rows(R.restrict_to(b, a)) == [(1,), (2,)]
    assert rows(R.distinct_persons(a=a, b=b, c=a.limit(0))) == [("a", 2), ("b", 3), ("c", 0)]


def test_person_covariates_keep_one_row_per_birth_time(frame):
    persons = frame(
        [(1, "1950-05-05 10:00:00", None, 8527), (1, "1950-05-05 11:00:00", None, 8527), (2, "1960-01-01 00:00:00", 8532, 8527)],
        "person_id long, birth_datetime timestamp, gender_concept_id int, race_concept_id int",
    )
    index = frame([(1,), (1,)], "person_id long")
    covariates = R.person_covariates(persons, index)
    assert rows(covariates) == [(1, "1950-05-05", None, 8527)] * 2
    span = frame(
        [(1, 5, "2020-01-01", "2020-02-01")],
        "person_id long, drug_concept_id long, first_drug_exposure date, last_drug_exposure date",
    )
    assert rows(R.merge_covariates(covariates, span)) == [
        (1, "1950-05-05", None, 8527, 5, "2020-01-01", "2020-02-01")
    ]


def test_adults_by_age_and_race(frame, spans):
    covariates = frame(
        [(2, "2001-01-01", 1, 8527), (3, "2001-01-02", 1, 8527), (1, "1950-01-01", 1, 8527)],
        "person_id long, dob date, gender_concept_id int, race_concept_id int",
    )
    periods = P.observation_periods(spans)
    assert [r["person_id"] for r in P.process_covariates(covariates, periods).collect()] == [2]
    assert P.process_covariates(covariates, periods, min_age=0, race_ids=(8527,)).count() == 2
    assert P.process_covariates(covariates, periods, min_age=0, race_ids=(1,)).count() == 0


def test_exposures_are_labelled_and_flagged(frame, spans, side):
    periods = P.observation_periods(spans)
    drugs = frame(
        [
            (2, "2019-06-01", 70),
            (2, "2020-01-01", 70),
            (2, "2020-01-01", 70),
            (2, "2020-02-01", 70),
            (3, "2020-06-01", 80),
            (3, "2020-06-01", 99),
        ],
        "person_id long, drug_exposure_start_date date, drug_concept_id long",
    )
    mapping = side(frame([(70, 1), (70, 2), (80, 3)], "drug_concept_id long, rxcui_ingr int"))
    exposures = P.period_exposures(side(periods), P.to_ingredients(drugs, mapping))
    assert rows(exposures) == [
        (2, "2019-06-01", 70, 1, "baseline"),
        (2, "2019-06-01", 70, 2, "baseline"),
        (2, "2020-01-01", 70, 1, "treatment"),
        (2, "2020-01-01", 70, 2, "treatment"),
        (3, "2020-06-01", 80, 3, "treatment"),
    ]
    people = frame([(2,), (3,), (4,)], "person_id long")
    assert rows(P.flag_exposure(exposures, people)) == [(2, 1, 0), (3, 1, 1), (4, 0, 0)]


def test_biomarker_change_needs_both_periods(frame, side):
    flagged = frame(
        [(1, "2019-01-01", "2020-01-01", "2021-01-01"), (2, "2019-01-01", "2020-01-01", "2021-01-01")],
        "person_id long, start_date date, first_drug_exposure date, final_end_date date",
    )
    values = frame(
        [
            (1, "2019-02-01", 5, 1.0),
            (1, "2019-03-01", 5, 2.0),
            (1, "2019-03-01", 5, 3.0),
            (1, "2019-04-01", 5, 10.0),
            (1, "2019-04-01", 9, 200.0),
            (1, "2020-01-01", 5, 7.0),
            (1, "2021-01-02", 5, 90.0),
            (2, "2019-02-01", 5, 1.0),
        ],
        "person_id long, measurement_date date, measurement_concept_id long, value_as_number double",
    )
    assert rows(P.biomarker_change(values, side(flagged), exclude=[9])) == [(1, 2.5, 7.0, 4.5)]
    assert rows(P.biomarker_change(values, side(flagged))) == [(1, 3.0, 7.0, 4.0)]


def test_a_person_has_one_row_per_cohort(frame):
    covariates = frame(
        [(1, "F", "W", "1950-01-01", "2000-01-01", "2002-01-01", "2001-01-01", "2001-03-01"),
         (2, None, "B", "1950-01-01", "2000-01-01", "2002-01-01", "2001-01-01", "2001-03-01"),
         (3, "M", None, "1950-01-01", "2000-01-01", "2002-01-01", "2001-01-01", "2001-03-01")],
        "person_id long, gender string, race string, dob date, start_date date, end_date date, "
        "t1 date, t2 date",
    )
    metadata = frame(
        [(1, 1, 0, 1, 0), (1, 1, 0, 0, 0), (2, 0, 1, None, 1), (9, 1, 1, 1, 1)],
        "person_id long, cohort1 int, cohort2 int, cohort3 int, cohort4 int",
    )
    got = cohort_membership(covariates, metadata, ("t1", "t2"))
    assert rows(got) == [
        (1, 1, 1, 50.0, 731, 59, "entire_cohort"),
        (1, 1, 1, 50.0, 731, 59, "subgroup1"),
        (2, None, 0, 50.0, 731, 59, "subgroup2"),
        (2, None, 0, 50.0, 731, 59, "subgroup3"),
    ]


def test_attrition_terms_add_up(frame):
    people = range(1, 9)
    covariates = frame(
        [(p, "2010-01-01" if p == 2 else "1950-01-01", 8532, 8527, 5, "2020-01-01",
          "2020-01-10" if p == 1 else "2020-06-01") for p in people],
        "person_id long, dob date, gender_concept_id int, race_concept_id int, drug_concept_id long, "
        "first_drug_exposure date, last_drug_exposure date",
    )
    drugs = frame(
        [(p, "2019-01-01", "2021-01-01", "2020-01-01", 77) for p in people]
        + [(3, "2019-01-01", "2021-01-01", "2020-02-01", 88)],
        "person_id long, start_date date, end_date date, drug_exposure_start_date date, drug_concept_id long",
    )
    biomarkers = frame(
        [(p, "2019-01-01", d, "2021-01-01", 5, 100.0) for p in people if p != 8 for d in ("2019-05-01", "2020-03-01")
         if not (p == 4 and d.startswith("2020"))],
        "person_id long, start_date date, measurement_date date, end_date date, "
        "measurement_concept_id long, value_as_number double",
    )
    lists = frame([(1, "other", "X"), (2, "target pill", "X")], "rxcui_in int, drug_desc string, indication string")
    ingredients = frame([(77, 2), (88, 1)], "drug_concept_id long, rxcui_ingr int")
    steps = CohortAnalysis(covariates, drugs, biomarkers, lists, ingredients, AnalysisParams("target", "X"))
    row = steps.attrition(outpatient_exposed=True).first().asDict()
    assert row == {
        "drug": "target",
        "phenotype": "X",
        "outpatient_exposed": 8,
        "n_overlapping_patients": 7,
        "less_30_exposure": 1,
        "age_num_removed": 1,
        "biomarker_filter": 1,
        "indication_drug_exposed": 1,
        "final_cohort_number": 3,
    }
    assert rows(steps.demographics().select("person_id", "is_f", "is_w", "treatment_period_length_days")) == [
        (p, 1, 1, 152) for p in (5, 6, 7)
    ]
    assert rows(exclude_by_regex(lists, "drug_desc", "target")) == [(1, "other", "X")]
