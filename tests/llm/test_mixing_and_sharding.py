from __future__ import annotations

import struct
import zlib
from collections import Counter, defaultdict
from math import log

import pytest
import xxhash
from pyspark.sql import functions as F

from retrocohort.llm import mixing
from retrocohort.llm.mixing import Mix, mixed_documents, mixture
from retrocohort.llm.sharding import assign, shard_tree, sharded, write_shards
from retrocohort.llm.texts import table

FOLDER = "/root/testdata/sf0.01"


def test_targets_and_budgets(spark):
    rows = mixture(table(spark, FOLDER, "documents")).collect()
    sizes, taken, target, weight = Counter(), Counter(), {}, {}
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    for i, source in enumerate(sorted(sizes)):
        weight[source] = (5, 2, 1)[i % 3]
    # water filling, step by step
    want, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if share * weight[s] > 2 * sizes[s]}
        if not full:
            break
        for s in full:
            want[s] = 2 * sizes[s]
            left -= want[s]
        free -= full
    want |= {s: share * weight[s] for s in free}
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert Counter(rows) == Counter(mixture(table(spark, FOLDER, "documents")).collect())


def test_key_ranges_do_not_matter(spark):
    docs = table(spark, FOLDER, "documents")
    assert Counter(mixture(docs, Mix(range_rows=3)).collect()) == Counter(mixture(docs).collect())


def test_documents_of_the_mix(spark):
    docs = table(spark, FOLDER, "documents")
    copies = Counter(r.doc_id for r in mixed_documents(docs).collect())
    for r in mixture(docs).collect():
        assert copies[r.doc_id] == -(-r.taken // r["size"])


def test_better_documents_are_drawn_more_often(spark):
    rows = [(i, "word " * 20 + ("#" * 60 if i % 2 else ""), f"s{i % 3}") for i in range(3000)]
    got = mixture(spark.createDataFrame(rows, "doc_id long, text string, source string"), Mix(percent=50)).collect()
    per = {r.doc_id: r.taken / r["size"] for r in got}
    assert sum(v for i, v in per.items() if i % 2 == 0) > 1.5 * sum(v for i, v in per.items() if i % 2)


def test_few_rows_are_put_in_order_whatever_the_quality(spark):
    # qualities from 1 to 1 in 300, one source with many copies of a row, one without words
    docs = spark.range(3000).selectExpr(
        "id AS doc_id",
        "repeat('word ', int(1 + id % 7)) || repeat('#', int(pow(300, id % 10 / 9D)) * int(1 + id % 7)) AS text",
        "IF(id % 3 = 0, 'low', 'other') AS source",
    )
    docs = docs.unionAll(spark.range(500).selectExpr("1L", "'same text'", "'copies'"))
    docs = docs.unionAll(spark.range(5, 9).selectExpr("id", "''", "'empty'"))
    few = Mix(range_rows=20)
    assert sorted(map(str, mixture(docs, few).collect())) == sorted(map(str, mixture(docs).collect()))
    measured = mixing._measured(docs, few).cache()
    planned = measured.groupBy("source").agg(F.floor(0.4 * F.sum("size")).cast("long").alias("budget"))
    edge = mixing.edges(measured, planned, few, 2000)
    assert edge.count() == 3
    left = mixing._within(measured, edge).groupBy("s").agg(F.countDistinct("key").alias("n")).collect()
    assert len(left) == 3 and all(r.n <= 20 for r in left)


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    got = mixture(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.source for r in got} == {"src0", "src1", None}
    assert mixture(no_docs).isEmpty() and mixed_documents(no_docs).isEmpty()
    assert mixed_documents(odd_docs).columns == odd_docs.columns


def descend(doc_id, node):
    """The shard of a doc_id, drawn one node at a time."""
    while node.shard is None:
        draws = []
        for child in node.children:
            seed = xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
            bits = xxhash.xxh64(child.path.encode(), seed=seed).intdigest() >> 11
            draws.append(-log((bits + 0.5) / (1 << 53)) / child.weight)
        node = node.children[draws.index(min(draws))]
    return node.shard


@pytest.mark.parametrize("range_rows", [10_000, 5])
def test_shards_equal_brute_force(spark, range_rows):
    docs = table(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    slots = defaultdict(list)
    for r in assign(docs, range_rows=range_rows).collect():
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.shard == descend(r.doc_id, shard_tree(24))
        assert r.grown_shard == descend(r.doc_id, shard_tree(25))
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_near_equal_and_growth_moves_a_share(spark):
    rows = assign(spark.range(40_000).selectExpr("id AS doc_id", "'x' AS text")).collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) < 1.15 * min(counts.values())
    assert 0.03 < sum(r.shard != r.grown_shard for r in rows) / len(rows) < 0.05


def test_slots_of_many_equal_rows(spark):
    rows = spark.range(25_000).selectExpr("1L AS doc_id", "'x' AS text")
    rows = rows.unionAll(spark.range(3).selectExpr("CAST(NULL AS LONG)", "CAST(NULL AS STRING)"))
    rows = rows.unionAll(spark.range(2, 900).selectExpr("id", "'y'"))
    slots = defaultdict(list)
    for r in assign(rows, range_rows=7).collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 25_901
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_the_type_of_doc_id_does_not_matter(spark):
    rows = spark.range(500).selectExpr("id AS doc_id", "'x' AS text")
    whole = {r.doc_id: r.shard for r in assign(rows).collect()}
    for kind in ("int", "string"):
        other = rows.withColumn("doc_id", rows.doc_id.cast(kind))
        assert {r.doc_id: r.shard for r in assign(other).collect()} == whole
        assert {int(r.doc_id): r.shard for r in sharded(other).collect()} == whole


def test_shards_of_odd_rows(spark, odd_docs, no_docs, tmp_path):
    got = assign(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {(r["size"], r.text_crc32) for r in got if r.doc_id == 0} == {(8, 0)}
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert assign(no_docs).isEmpty()
    assert sharded(odd_docs).columns == [c for c in odd_docs.columns if c != "shard"] + ["shard"]
    write_shards(odd_docs, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == odd_docs.count()
