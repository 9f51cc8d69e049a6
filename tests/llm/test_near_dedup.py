from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from retrocohort.llm.components import components
from retrocohort.llm.near_dedup import NearDuplicates, drop_near_duplicates, links_within, near_duplicates
from retrocohort.llm.texts import Words, polynomial, table


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def alternating(a, b, levels):
    """A word in which sums modulo a power of two do not tell the two letters apart."""
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(1 << levels))


@pytest.mark.parametrize("levels", [10, 12])
def test_crafted_words_have_hashes_of_their_own(levels):
    pair = alternating("a", "b", levels), alternating("b", "a", levels)
    raw = np.frombuffer(" ".join(pair).encode(), dtype=np.uint8)
    found, _ = Words(lower=True).hashes(raw, np.array([0, len(raw)]))
    assert len(set(found.tolist())) == 2
    values = np.frombuffer("".join(pair).encode(), dtype=np.uint8).astype(np.uint64)
    n = 1 << levels
    assert len(set(polynomial(values, np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2


def test_hashes_do_not_depend_on_the_place_of_a_word():
    words = [f"w{i % 50}" for i in range(400_000)]
    raw = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    found, _ = Words(lower=True).hashes(raw, np.array([0, len(raw)]))
    by_word = {}
    assert all(by_word.setdefault(w, h) == h for w, h in zip(words, found.tolist(), strict=True))
    assert len(set(by_word.values())) == 50


def test_crafted_documents_are_not_linked(spark):
    docs = [(i, " ".join([alternating(*letters, 10)] * 5)) for i, letters in enumerate((("a", "b"), ("b", "a")))]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), NearDuplicates(shingle=3, percent=85))
    assert found(got) == {(0, 1, 0), (1, 1, 1)}


def brute_force(rows, k, percent):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in combinations([s for s in sets if s[1]], 2):
        if 100 * len(a & b) >= percent * len(a | b):
            low, high = sorted((find(i), find(j)))
            parent[high] = low
    return {(i, len(s), find(i)) for i, s in sets}


def found(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def mutated(words, n, rnd):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"new{rnd.randrange(10**9)}"
    return " ".join(out)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force_on_copies_of_all_degrees(spark, k, percent):
    rnd = random.Random(5)
    rows = []
    for _ in range(12):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(3, 300))]
        rows += [mutated(base, rnd.randrange(0, 1 + len(base) // 12), rnd) for _ in range(rnd.randrange(1, 25))]
    rows += rows[:10]
    rnd.shuffle(rows)
    rows = [(3 * i + 1, t) for i, t in enumerate(rows)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), NearDuplicates(k, percent))
    assert found(got) == brute_force(rows, k, percent)


def test_blocks_of_a_large_group_give_the_same(spark):
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, mutated(base, rnd.randrange(0, 7), rnd)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small = NearDuplicates(3, 85, block_bytes=20_000)
    assert found(near_duplicates(docs, small)) == found(near_duplicates(docs, NearDuplicates(3, 85)))
    assert found(near_duplicates(docs, small)) == brute_force(rows, 3, 85)


def test_members_far_from_their_centre_are_found_in_other_blocks(spark):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    # a walk: near its neighbours, soon far from its smallest document
    rows = []
    for i in range(120):
        base = mutated(base, 2, rnd).split()
        rows.append((i, " ".join(base)))
    rows += [(1000 + i, mutated(rows[0][1].split(), 1, rnd)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small = NearDuplicates(3, 85, block_bytes=8_000, member_bytes=64)
    assert found(near_duplicates(docs, small)) == brute_force(rows, 3, 85)


def test_a_block_links_only_what_is_asked():
    rule = NearDuplicates(3, 85)
    sets = [np.arange(100), np.arange(1, 101), np.arange(500, 600), np.arange(501, 601)]
    minima = np.stack([np.zeros(rule.hashes), np.zeros(rule.hashes), np.ones(rule.hashes), np.ones(rule.hashes)])
    assert [x.tolist() for x in links_within(sets, minima, rule)] == [[1, 3], [0, 2]]
    asked = np.array([False, False, False, True])
    assert [x.tolist() for x in links_within(sets, minima, rule, asked)] == [[3], [2]]
    assert [len(x) for x in links_within(sets, minima, rule, np.zeros(4, dtype=bool))] == [0, 0]


def test_equals_brute_force_on_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(near_duplicates(docs, NearDuplicates(3, 85))) == brute_force(rows, 3, 85)


def test_odd_rows(spark, odd_docs, no_docs):
    got = near_duplicates(odd_docs, NearDuplicates(3, 85)).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].n_shingles for i in (0, 1, 2)] == [0, 0, 0]
    assert by_id[3].n_shingles == by_id[4].n_shingles == 1
    assert all(r.component_id == r.doc_id for r in got) and all(r.kept for r in got)
    assert near_duplicates(no_docs).isEmpty()
    left = drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    # unlike texts under one doc_id both stay, of repeated rows one does
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted([*range(9), 7])
    assert any(r.text.startswith("another") for r in left.where("doc_id = 7").collect())
    assert left.where("doc_id is null").count() == 2


def test_texts_that_share_a_doc_id_join_their_links(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(5, a), (5, b), (6, a), (7, b)], "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(docs).collect()} == {5}


def test_components(spark):
    rnd = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rnd.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    links += [(2000, i) for i in range(2001, 2300)] + [(9, 9)]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = components(spark.createDataFrame([*links, (None, 1)], "u long, v long")).collect()
    linked = {i for a, b in links if a != b for i in (a, b)}
    assert {(r.node, r.component) for r in got} == {(i, find(i)) for i in linked}
    assert len(got) == len(linked)
