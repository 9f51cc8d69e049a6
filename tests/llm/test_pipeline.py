"""The pipeline against its stages' brute-force versions, on the small tables."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from retrocohort.llm.sharding import shard_tree
from retrocohort.llm.texts import table
from tests.llm.test_decontaminate import brute_force as leaks
from tests.llm.test_mixing_and_sharding import descend
from tests.llm.test_near_dedup import brute_force as groups
from tests.llm.test_quality_and_chat import repeated

FOLDER = "/root/testdata/sf0.001"


def good(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return (
        len(words) >= 20
        and 100 * repeated(words) <= 30 * len(words)
        and 100 * sum(c in "#*$%&|<>" for c in text) <= 30 * len(words)
        and 2 * (len(lines) - len(set(lines))) <= len(lines)
        and 2 * len(words) <= sum(map(len, words)) <= 20 * len(words)
    )


def test_stages_equal_brute_force(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    left = {i for i, r in rows.items() if good(r.text)}
    wanted = [left]
    left = {i for i, _, c in groups([(i, rows[i].text) for i in sorted(left)], 5, 80) if i == c}
    wanted.append(left)
    # only texts that share five words with an item can hold it
    text = " ".join(t.lower() for _, t in items)
    near = [i for i in left if any(" ".join(w) in text for w in zip(*[rows[i].text.lower().split()[k:] for k in range(5)], strict=False))]
    left = left - {x[0] for x in leaks([(i, rows[i].text) for i in near], items)}
    wanted.append(left)
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted, strict=False):
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert Counter(r.doc_id for r in docs.collect()) == Counter(want), name
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, FOLDER)
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in docs.collect()}
    words, size = Counter(), Counter()
    for r in docs.collect():
        size[r.source] += len(r.text.split())
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    assert all(words[s] <= 2 * size[s] for s in size)
    assert sum(words.values()) >= 1.5 * sum(size.values()) - len(size)
    for r in corpus_pipeline.STAGES[4][1](spark, mixed, FOLDER).collect():
        assert r.shard == descend(r.doc_id, shard_tree(24))


def test_odd_rows_pass_through(spark, odd_docs, no_docs, tmp_path):
    for k, start in enumerate((odd_docs, no_docs)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            out.write.parquet(f"{tmp_path}/{k}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{name}")
            assert set(docs.columns) == set(start.columns)


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert set(got.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard"}
    assert got.count() > 0
