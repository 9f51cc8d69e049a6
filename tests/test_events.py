import pytest

from retrocohort.operators import events as E
from retrocohort.operators import exposure as X
from retrocohort.operators.concepts import (
    code_sets,
    concept_set,
    exclude_by_regex,
    exclude_concepts,
    indication_list,
)
from tests.conftest import rows


def test_concept_set_keeps_the_domain_and_drops_repeats(frame):
    concepts = frame(
        [(1, "a", "Drug"), (1, "a", "Drug"), (2, "b", "Drug"), (3, "c", "Measurement"), (4, "d", None)],
        "concept_id long, concept_name string, domain_id string",
    )
    ancestors = frame(
        [(9, 1), (9, 1), (9, 3), (9, 4), (8, 2)],
        "ancestor_concept_id long, descendant_concept_id long",
    )
    drugs = concept_set(concepts, ancestors, 9, "Drug")
    values = concept_set(concepts, ancestors, "9", "Measurement")
    assert rows(drugs) == [(1, "a")]
    assert rows(code_sets(drugs.unionByName(drugs), values)) == [(1, 1, "a"), (2, 3, "c")]


def test_bounds_are_open_below_and_closed_above(frame):
    df = frame([(0.0,), (0.01,), (250.0,), (250.01,), (None,), (float("nan"),)], "value_as_number double")
    assert rows(E.bounded_values(df, 250)) == [(0.01,), (250.0,)]
    assert rows(E.bounded_values(df, upper=100)) == [(0.01,)]


def test_unmapped_drugs_are_dropped(frame):
    df = frame(
        [(1, 0, "2020-01-01"), (1, None, "2020-01-01"), (1, 7, "2020-01-01")],
        "person_id long, drug_concept_id long, drug_exposure_start_date date",
    )
    assert rows(E.mapped_exposures(df)) == [(1, 7, "2020-01-01")]


def test_two_visits_on_a_day_repeat_only_what_is_kept_per_visit(frame, side):
    visits = frame(
        [(1, 9202, "2020-01-01"), (1, 9202, "2020-01-01"), (1, 9201, "2020-01-02"), (2, 9202, "2020-01-01")],
        "person_id long, visit_concept_id int, visit_start_date date",
    )
    events = frame(
        [(1, "2020-01-01", 5.0), (1, "2020-01-02", 6.0), (3, "2020-01-01", 7.0), (1, "2020-01-01", 5.0)],
        "person_id long, measurement_date date, value double",
    )
    days = side(E.visit_days(E.outpatient_visits(visits)))
    once = E.at_outpatient_visit(events, days, "measurement_date", keep_duplicates=False)
    each = E.at_outpatient_visit(events, days, "measurement_date", keep_duplicates=True)
    assert rows(once) == [(1, "2020-01-01", 5.0)] * 2
    assert rows(each) == [(1, "2020-01-01", 5.0)] * 4


@pytest.mark.parametrize("times", [0, 1, 2, 4095, 4096, 4097, 10000])
def test_repeat_rows(frame, times):
    df = frame([("x", times)], "name string, n long")
    got = E.repeat_rows(df, "n")
    assert got.columns == ["name"]
    assert got.count() == times


def test_window_ends_are_inclusive(frame, side):
    windows = frame(
        [(1, "2020-01-31", "2020-03-01"), (2, "2020-05-01", "2020-04-01"), (3, None, "2020-04-01")],
        "person_id long, start_date date, end_date date",
    )
    days = ["2020-01-30", "2020-01-31", "2020-02-29", "2020-03-01", "2020-03-02"]
    events = frame(
        [(p, d, i) for p in (1, 2, 3, 4) for i, d in enumerate(days)] + [(1, None, 9)],
        "person_id long, event_date date, n int",
    )
    got = E.in_window(events, side(windows), "event_date").select("person_id", "n", "start_date", "end_date")
    assert rows(got) == [(1, n, "2020-01-31", "2020-03-01") for n in (1, 2, 3)]


def test_leap_day_windows(frame):
    span = frame(
        [(1, 5, "2020-02-29"), (2, 5, "2019-02-28")],
        "person_id long, drug_concept_id long, first_drug_exposure date",
    )
    assert rows(X.cohort_window(span)) == [
        (1, 5, "2019-02-28", "2021-02-28"),
        (2, 5, "2018-02-28", "2020-02-28"),
    ]


def test_index_exposures_keep_repeats_and_carry_the_target_id(frame, side):
    exposures = frame(
        [(1, 7, "2020-01-01"), (1, 7, "2020-01-01"), (1, 8, "2020-01-05"), (2, 9, "2020-01-01")],
        "person_id long, drug_concept_id long, drug_exposure_start_date date",
    )
    drugs = side(frame([(7,), (8,)], "concept_id long"))
    index = X.index_exposures(exposures, drugs, "100")
    assert rows(index) == [(1, 100, "2020-01-01")] * 2 + [(1, 100, "2020-01-05")]
    assert rows(X.exposure_span(index)) == [(1, 100, "2020-01-01", "2020-01-05")]


def test_selected_drugs_are_a_distinct_union(frame, side):
    drugs = frame([(1, 7), (1, 7), (1, 8), (1, 9)], "person_id long, drug_concept_id long")
    wanted = X.wanted_drugs(
        frame([(7,), (8,)], "descendant_concept_id long"), frame([(8,)], "concept_id long")
    )
    assert rows(X.select_drugs(drugs, side(wanted))) == [(1, 7), (1, 8)]


def test_conditions_with_codes(frame, side):
    conditions = frame(
        [(1, 5, "2020-01-01"), (1, 5, "2020-01-01"), (1, 6, "2020-01-01"), (2, None, "2020-01-01")],
        "person_id long, condition_source_concept_id long, condition_start_date date",
    )
    codes = side(frame([(5, "I10", "ICD10CM")], "concept_id long, concept_code string, vocabulary_id string"))
    assert E.with_codes(conditions, codes).count() == 2
    assert rows(E.coded_conditions(conditions, codes)) == [(1, "I10", "2020-01-01", "ICD10CM")]


def test_regex_exclusion_is_case_sensitive_and_drops_null(frame):
    df = frame([("simvastatin 10 MG",), ("Simvastatin",), (None,), ("a.b",)], "drug_desc string")
    assert rows(exclude_by_regex(df, "drug_desc", "simva")) == [("Simvastatin",), ("a.b",)]
    assert rows(exclude_by_regex(df, "drug_desc", r"a\.b|^S")) == [("simvastatin 10 MG",)]


def test_concept_exclusion(frame):
    df = frame([(1,), (2,), (None,)], "c long")
    assert rows(exclude_concepts(df, "c", [2])) == [(1,), (None,)]
    assert exclude_concepts(df, "c", ()).count() == 3


def test_indication_list_needs_a_known_phenotype(frame):
    lists = frame([(1, "d", "X"), (2, "e", "Y")], "rxcui_in int, drug_desc string, indication string")
    assert rows(indication_list(lists, "Y")) == [(2, "e", "Y")]
    with pytest.raises(ValueError, match="'Z'"):
        indication_list(lists, "Z")
