"""Queries with SQL against it, and the shape of all on empty tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from retrocohort.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"
TABLES = "documents pages benchmark labels conversations".split()


def _connection(folder):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(row[c] for c in columns) for row in df.collect())
    want = _connection(FOLDER).sql(ORACLES[name])
    assert sorted(want.columns) == columns
    assert got == Counter(want.select(", ".join(columns)).fetchall())


def test_registry():
    found = entry_point.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert found["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "source_mix", "shards",
    ]


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables(spark, empty_folder, name):
    got = entry_point.queries()[name](spark, empty_folder)
    assert got.count() == (1 if name.startswith("op1_") else 0)


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op6_quality_rules", "op10_personal_data"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "ExistingRDD"):
        assert node not in plan
