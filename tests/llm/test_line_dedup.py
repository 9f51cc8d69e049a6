from __future__ import annotations

import random
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retrocohort.llm.line_dedup import (
    LineRule,
    aligned_blocks,
    drop_repeated_blocks,
    drop_repeated_lines,
    patience,
    repeated_places,
    shared_runs,
)
from retrocohort.llm.texts import table


def brute_force(docs):
    """{doc_id: (text, lines, removed)}: aligns each document with the first holder of each of its lines."""
    lines = {d: t.split("\n") for d, t in docs}
    first = {}
    for d in sorted(lines):
        for x in lines[d]:
            if len(x.split()) >= 5:
                first.setdefault(x, d)
    gone = defaultdict(set)
    for d, own in lines.items():
        words = [len(x.split()) for x in own]
        for e in {first[x] for x in own if x in first and first[x] != d}:
            gone[d] |= set(repeated_places(lines[e], own, words, 5))
    return {
        (d, "\n".join(x for i, x in enumerate(own) if i not in gone[d]), len(own), len(gone[d]))
        for d, own in lines.items()
    }


def found(df):
    return {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in df.collect()}


def test_equals_brute_force(spark):
    rnd = random.Random(8)
    pool = [" ".join(f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(0, 9))) for _ in range(60)]
    docs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 12)))) for i in range(150)]
    docs += [(200 + i, docs[0][1]) for i in range(5)]
    assert found(drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"))) == brute_force(docs)


def test_equals_brute_force_on_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(drop_repeated_lines(docs)) == brute_force(rows)


@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_alignment_matches_equal_lines_in_order(a, b):
    got = patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(i < k and j < m for (i, j), (k, m) in zip(got, got[1:], strict=False))


def test_alignment_of_moved_blocks():
    assert patience([1, 2, 3, 4], [1, 2, 3, 4]) == [(i, i) for i in range(4)]
    assert patience([1, 2, 3, 9, 9], [7, 2, 3, 9]) == [(1, 1), (2, 2), (4, 3)]
    assert repeated_places([1, 2, 3], [1, 8, 3], [4, 9, 6], 5) == [2]


def test_odd_rows(spark, odd_docs, no_docs):
    got = drop_repeated_lines(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {(r.text, r.n_lines, r.n_removed) for r in got if r.doc_id == 0} == {(None, 0, 0)}
    assert {(r.text, r.n_lines, r.n_removed) for r in got if r.doc_id == 1} == {("", 1, 0)}
    assert all(r.n_removed == 0 for r in got)
    assert drop_repeated_lines(no_docs).isEmpty()


def all_holders(docs, words=lambda x: len(x.split())):
    """{doc_id: (text, lines, removed)}: compares each document with every earlier one, run by run."""
    lines = {d: t.split("\n") for d, t in docs}
    out = set()
    for d, own in lines.items():
        gone = set()
        for e in sorted(x for x in lines if x < d):
            for i in range(len(own)):
                for j in range(len(lines[e])):
                    n = 0
                    while i + n < len(own) and j + n < len(lines[e]) and own[i + n] == lines[e][j + n]:
                        n += 1
                    if sum(map(words, own[i : i + n])) >= 5:
                        gone |= set(range(i, i + n))
        out.add((d, "\n".join(x for i, x in enumerate(own) if i not in gone), len(own), len(gone)))
    return out


def test_blocks_equal_all_earlier_holders(spark):
    rnd = random.Random(9)
    pool = [" ".join(f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(0, 9))) for _ in range(40)]
    docs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 12)))) for i in range(60)]
    docs += [(100 + i, docs[0][1]) for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = found(drop_repeated_blocks(df))
    assert got == all_holders(docs)
    removed = {r[0]: r[3] for r in got}
    assert all(r.n_removed <= removed[r.doc_id] for r in drop_repeated_lines(df).collect())


L1, L2 = "a line of five words", "another line of six words here"


def test_blocks_held_twice_or_in_another_order(spark):
    docs = [
        (1, f"x\n{L1}\ny\n{L1}\nz"),
        (2, f"p\n{L1}\nq"),
        (3, f"{L2}\n{L1}"),
        (4, f"{L1}\n{L2}"),
        (5, f"u\n{L2}\nv\n{L2}"),
    ]
    got = {r.doc_id: r.text for r in drop_repeated_blocks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: "p\nq", 3: L2, 4: "", 5: "u\nv"}


def test_alignment_without_a_unique_line():
    assert repeated_places([1, 2, 3, 2, 4], [5, 2, 6], [1, 9, 1], 5) == [1]
    assert repeated_places([5, 2, 6], [1, 2, 3, 2, 4], [1, 9, 1, 9, 1], 5) == [1]


def test_blocks_of_short_lines_and_of_text_without_spaces(spark):
    menu = "soup 4\n\nbread 2\nwine 7"
    chinese = "这是一个没有空格的很长的句子。"
    docs = [
        (1, f"Monday\n{menu}"),
        (2, f"Tuesday\n{menu}\nclosed"),
        (3, f"first\n{chinese}"),
        (4, f"second\n{chinese}"),
        (5, "soup 4\nwine 7\nยินดีต้อนรับ"),
        (6, "wine 7\nยินดีต้อนรับ\nかな 漢 A1"),
        (7, "かな 漢 A1"),
        (8, "かな 漢"),
        (9, "かな 漢\nwine 7"),
    ]
    got = {r.doc_id: r.text for r in drop_repeated_blocks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == dict(docs) | {2: "Tuesday\nclosed", 4: "second", 6: "かな 漢 A1"}


def test_blocks_equal_all_earlier_holders_on_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    first = {}
    for d, t in sorted(rows):
        for x in t.split("\n"):
            first.setdefault(x, d)
    got = {r.doc_id: r for r in drop_repeated_blocks(docs).collect()}
    for d, t in rows:
        # every line of five words that an earlier document holds is a block
        left = [x for x in got[d].text.split("\n") if len(x.split()) >= 5]
        assert left == [x for x in t.split("\n") if len(x.split()) >= 5 and first[x] == d]


def test_aligned_blocks_are_all_shared_runs(spark):
    # on sf0.01: the lines that go are those of any run that an earlier document holds, no more and no less
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    runs = shared_runs(docs, LineRule()).select("doc_id", "version", F.explode(F.sequence("begin", "end")).alias("line"))
    brute = runs.distinct().groupBy("doc_id").agg(F.count("*").alias("n_lines_gone"))
    got = drop_repeated_blocks(docs).where("n_removed > 0").selectExpr("doc_id", "n_removed AS n_lines_gone")
    assert got.count() > 0 and got.exceptAll(brute).isEmpty() and brute.exceptAll(got).isEmpty()


@given(st.lists(st.integers(0, 6), unique=True, min_size=1), st.lists(st.integers(0, 6), min_size=1, max_size=15))
def test_every_shared_run_is_in_a_block(earlier, later):
    shared = [(j, j, run) for j, run in enumerate(later) if run in earlier]
    got = aligned_blocks([(i, run) for i, run in enumerate(earlier) if run in later], shared)
    assert {x for begin, end in got for x in range(begin, end + 1)} == {j for j, _, _ in shared}
    for begin, end in got:
        at = earlier.index(later[begin])
        assert earlier[at : at + end - begin + 1] == later[begin : end + 1]


def test_blocks_in_order_and_moved():
    earlier = [(0, 10), (1, 11), (2, 14), (3, 12), (6, 13)]
    later = [(0, 0, 12), (3, 3, 10), (4, 4, 11), (5, 5, 14), (6, 6, 13), (9, 9, 10)]
    assert aligned_blocks(earlier, later) == [(3, 5), (6, 6), (0, 0), (9, 9)]


def test_a_long_document_in_reverse():
    n = 100_000
    assert len(aligned_blocks([(i, i) for i in range(n)], [(n - 1 - i, n - 1 - i, i) for i in range(n)])) == n


def test_blocks_of_odd_rows(spark, odd_docs, no_docs):
    got = drop_repeated_blocks(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {(r.text, r.n_lines, r.n_removed) for r in got if r.doc_id == 0} == {(None, 0, 0)}
    assert {(r.text, r.n_lines, r.n_removed) for r in got if r.doc_id == 1} == {("", 1, 0)}
    assert all(r.n_removed == 0 for r in got)
    assert drop_repeated_blocks(no_docs).isEmpty()
