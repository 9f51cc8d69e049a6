import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retrocohort.operators import summaries as S
from tests.conftest import rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.floats(-50, 50, allow_nan=False).map(lambda v: round(v, 2)), min_size=1, max_size=60),
    ordered_rows=st.sampled_from([1, 7, 4096]),
)
def test_quantiles_equal_the_interpolated_definition(spark, values, ordered_rows):
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, v double")
    probs = {"q1": 0.25, "median": 0.5, "p90": 0.9, "top": 1.0}
    for row in S.exact_quantiles(df, ["g"], "v", probs, ordered_rows).collect():
        group = [v for i, v in enumerate(values) if i % 3 == row["g"]]
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(group, p), abs=1e-9)


def test_quantiles_skip_null_values_and_keep_null_groups(frame):
    df = frame([("a", 1.0), ("a", None), (None, 3.0), (None, 5.0), ("b", None)], "g string, v double")
    assert rows(S.exact_quantiles(df, ["g"], "v", {"m": 0.5})) == [("a", 1.0), (None, 4.0)]


def test_quantiles_over_a_large_single_group(spark):
    df = spark.range(200_001).select(F.lit("all").alias("g"), (F.col("id") * 7919 % 200_001 / 1000).alias("v"))
    assert S.exact_quantiles(df, ["g"], "v", {"m": 0.5, "q": 0.25}).first().asDict() == {
        "g": "all",
        "m": 100.0,
        "q": 50.0,
    }


@pytest.mark.parametrize("kind", ["a 4096th of the range", "powers", "even", "all in one hot group"])
def test_clustered_values_are_ordered_in_small_pieces(spark, monkeypatch, kind):
    n = 200_000
    shuffled = F.col("id") * 7919 % n
    value = {
        "a 4096th of the range": F.when(F.col("id") == 0, 1e9).when(F.col("id") == 1, -1e9).otherwise(1 + shuffled / n / 4096),
        "powers": F.pow(F.lit(10.0), shuffled / n * 600 - 300),
        "even": shuffled / n,
        "all in one hot group": F.when(F.col("id") < 5, F.col("id")).otherwise(shuffled / n),
    }[kind]
    group = F.when(F.col("id") < 5, "small").otherwise("hot") if "hot" in kind else F.lit("all")
    extremes = [float("nan"), float("inf"), -float("inf"), None]
    df = spark.range(n).select(group.alias("g"), value.alias("v"))
    df = df.unionByName(spark.createDataFrame([("x", v) for v in extremes], "g string, v double"))
    pieces = []
    stage = S.stage
    monkeypatch.setattr(S, "stage", lambda frame, label: pieces.append(stage(frame, label)) or pieces[-1])
    found = S.exact_quantiles(df, ["g"], "v", {"q": 0.25, "m": 0.5, "p": 0.9})
    got = {r["g"]: (r["q"], r["m"], r["p"]) for r in found.collect()}
    want = {r["g"]: tuple(r["p"]) for r in df.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9))).alias("p")).collect()}
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, nan_ok=True)
    ordered = [p.where(F.col("_piece_rows") <= S.ORDERED_ROWS).groupBy("_group", "_piece").count() for p in pieces if "_piece" in p.columns]
    assert len(ordered) >= 2
    assert max(r["count"] for o in ordered for r in o.collect()) <= 10_000
    # a narrowing leaves no more than a few hundredths of the rows
    assert all(b.count() < a.count() / 10 for a, b in zip(pieces[1:], pieces[2:]))


def test_small_groups_take_one_staged_table(spark, monkeypatch):
    df = spark.range(100).select(F.lit("all").alias("g"), F.col("id").alias("v"))
    labels = []
    stage = S.stage
    monkeypatch.setattr(S, "stage", lambda frame, label: labels.append(label) or stage(frame, label))
    assert S.exact_quantiles(df, ["g"], "v", {"m": 0.5}).first()["m"] == 49.5
    assert labels == ["value_counts"]


def test_quantiles_with_nan_and_infinities(spark):
    inf, nan = float("inf"), float("nan")
    for values in ([1, 2, 3, nan, -5], [1, inf, inf], [-inf, -inf, 0, inf], [nan], [-inf, 1, 2], [1e308, -1e308, 0, 3], [0.0, 5e-324]):
        df = spark.createDataFrame([(float(v),) for v in values], "v double").selectExpr("1 AS g", "v")
        got, want = S.exact_quantiles(df, ["g"], "v", {"m": 0.5}).first()["m"], df.agg(F.median("v")).first()[0]
        assert got == want or (np.isnan(got) and np.isnan(want)), values


def test_a_variable_without_values_keeps_its_rows(frame):
    df = frame([("X", None), ("Y", 2.0)], "phenotype string, age double")
    got = {(r[0], r[2]): r[3] for r in S.continuous_summary(df, "phenotype", ["age"]).collect()}
    assert {k[1] for k in got if k[0] == "X"} == {"mean", "sd", "median", "min", "max", "missing"}
    assert got[("X", "median")] is None and got[("Y", "median")] == 2
    assert got[("X", "missing")] == 1 and got[("Y", "missing")] == 0


def test_table_one(frame):
    df = frame(
        [("X", 1, "d", 1.0), ("X", 0, "d", 2.0), ("X", 1, "d", 3.0), ("X", None, "d", 10.0), ("Y", 1, "d", 4.0)],
        "phenotype string, is_f int, drug string, age double",
    )
    got = {(r[0], r[1], r[2], r[3]): r[4] for r in S.table_one(df, "phenotype", ["is_f", "drug"], ["age"]).collect()}
    assert got[("X", "N", None, "n")] == 4
    assert got[("X", "is_f", "1", "n")] == 2
    assert got[("X", "is_f", "1", "pct")] == 50
    assert got[("X", "is_f", None, "pct")] == 25
    assert got[("X", "age", None, "median")] == 2.5
    assert got[("X", "age", None, "mean")] == 4
    assert got[("X", "age", None, "sd")] == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    assert (got[("X", "age", None, "min")], got[("X", "age", None, "max")]) == (1, 10)
    assert got[("Y", "age", None, "sd")] is None
    for stratum in ("X", "Y"):
        for variable in ("is_f", "drug"):
            shares = [v for k, v in got.items() if k[0] == stratum and k[1] == variable and k[3] == "pct"]
            assert sum(shares) == pytest.approx(100)


def test_describe_lengths(frame):
    df = frame([(v,) for v in (1, 2, 3, 10, None)], "n int")
    assert rows(S.describe_lengths(df, "n")) == [(1.0, 1.75, 2.5, 4.0, 4.75, 10.0)]


def test_stage_counts_count_persons_once_and_keep_empty_stages(frame):
    some = frame([(1,), (1,), (2,)], "person_id long")
    assert S.stage_counts(some=some, none=some.where("person_id > 5")).first().asDict() == {"some": 2, "none": 0}
