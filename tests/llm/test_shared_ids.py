"""Stages of the pipeline on rows that share a doc_id, or have none."""

from __future__ import annotations

from retrocohort.llm.decontaminate import drop_leaking, find_leaks
from retrocohort.llm.near_dedup import drop_near_duplicates

SCHEMA = "doc_id long, text string, note string"
A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
C = " ".join(f"gamma{i}" for i in range(40))


def _texts(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.note) for r in df.collect())


def test_near_duplicates_are_judged_by_their_own_text(spark):
    rows = [(1, A, "a"), (1, B, "b"), (2, A + " more", "c"), (None, C, "d"), (None, C, "e"), (None, None, "f"), (3, "", "g")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS document", "2 AS version_1")
    assert _texts(drop_near_duplicates(docs)) == [
        (False, 1, A, "a"), (False, 1, B, "b"), (False, 3, "", "g"), (True, 0, "", "f"), (True, 0, C, "d"),
    ]
    assert drop_near_duplicates(docs).columns == docs.columns
    plain = spark.createDataFrame([(1, A, "a"), (2, A + " more", "b"), (3, B, "c")], SCHEMA)
    assert _texts(drop_near_duplicates(plain)) == [(False, 1, A, "a"), (False, 3, B, "c")]


def test_leaks_are_judged_by_their_own_text(spark):
    rows = [(1, A, "leaks"), (1, B, "clean"), (None, "x " + A, "leaks"), (None, C, "clean"), (None, None, "clean")]
    docs = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame([(7, A)], "item_id long, text string")
    got = drop_leaking(docs.selectExpr("*", "1 AS leaking"), benchmark)
    assert sorted(r.text or "" for r in got.collect()) == sorted(["", B, C]) and got.columns[-1] == "leaking"


def test_items_shorter_than_a_shingle(spark):
    benchmark = spark.createDataFrame([(1, "what is the answer"), (2, "yes"), (3, ""), (4, A)], "item_id long, text string")
    texts = ["What is  the answer", "so what is the answer", "yes", "yes it is so my friend", "", None, "answer the is what"]
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)
    found = sorted((r.doc_id, r.item_id, r.start, r.n_words, r.similarity) for r in find_leaks(docs, benchmark).collect())
    assert found == [(0, 1, 0, 4, 1.0), (2, 2, 0, 1, 1.0)]
    only_short = benchmark.where("item_id < 3")
    assert sorted(r.doc_id for r in find_leaks(docs, only_short).collect()) == [0, 2]
