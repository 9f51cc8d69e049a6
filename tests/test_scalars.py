import random

import pytest
from pyspark.sql import functions as F

from retrocohort.functions.scalars import (
    age_years,
    binary_flag,
    binary_flag_null,
    days_between,
    safe_date,
    scientific,
)
from tests.conftest import rows


def test_age_counts_anniversaries_and_the_share_of_the_current_year(frame):
    df = frame(
        [
            (1, "2000-02-29", "2001-02-28"),
            (2, "1900-01-01", "1999-12-31"),
            (3, "1950-08-31", "2001-02-28"),
            (4, "2000-02-29", "2004-02-28"),
            (5, "1999-02-28", "2000-02-29"),
            (6, "1980-05-05", "1980-05-05"),
            (7, None, "2000-01-01"),
        ],
        "id int, born date, at date",
    )
    got = dict(rows(df.select("id", F.round(age_years("born", "at"), 6))))
    assert got == {
        1: 1.0,
        2: 99.99726,
        3: 50.49589,
        4: round(3 + 365 / 366, 6),
        5: round(1 + 1 / 366, 6),
        6: 0.0,
        7: None,
    }


def test_days_between_may_be_negative(frame):
    df = frame([("2020-03-01", "2020-02-28"), ("2020-02-28", "2020-03-01")], "a date, b date")
    assert [r[0] for r in df.select(days_between("a", "b")).collect()] == [-2, 2]


def test_flags_treat_null_differently(frame):
    df = frame([("F",), ("M",), (None,)], "sex string")
    got = df.select(binary_flag("sex", ["F"]), binary_flag_null("sex", "F")).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, 0), (0, None)]


def test_safe_date_gives_null_for_bad_text(frame):
    df = frame([("2020-01-31",), ("notadate",), ("2020-13-01",), (None,)], "d string")
    assert [str(r[0]) for r in df.select(safe_date("d")).collect()] == ["2020-01-31", "None", "None", "None"]


def test_safe_date_of_a_timestamp(frame):
    df = frame([("2020-01-31 23:59:59",)], "d timestamp")
    assert str(df.select(safe_date("d")).first()[0]) == "2020-01-31"


def test_scientific_examples(frame):
    df = frame([(1, 1.234e-5), (2, 0.05), (3, 0.0), (4, None), (5, 1.0), (6, 1e-120)], "id int, p double")
    assert dict(rows(df.select("id", scientific("p")))) == {
        1: "1.23E-05",
        2: "5.00E-02",
        3: "0.00E+00",
        4: None,
        5: "1.00E+00",
        6: "1.00E-120",
    }


@pytest.mark.parametrize("digits", [4, 17])
def test_scientific_rounds_the_number_and_not_its_shortest_text(frame, digits):
    random.seed(digits)
    values = [1.005, 0.03125, 0.01235, 1.125, 1.375, 999.5, 0.09995] + [
        float(f"{random.uniform(1, 10):.{digits - 1}f}e{random.randint(-30, 3)}") for _ in range(500)
    ]
    values += [int(v * 1000) / 1000 + 0.005 for v in (random.random() * 9 + 1 for _ in range(300))]
    df = frame([(v,) for v in values], "p double")
    for row in df.select("p", scientific("p").alias("t")).collect():
        assert row["t"] == "%.2E" % row["p"]
