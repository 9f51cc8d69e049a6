"""Toxicity: counted ratios against plain counts, held-out accuracy, what scores may depend on."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retrocohort.llm.queries import QUERIES
from retrocohort.llm.texts import table
from retrocohort.llm.toxicity import Toxicity, _Features, _ratios, fit, labelled, score, toxicity, train

FOLDER = "/root/testdata/sf0.1"


def _held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op11_toxicity"](spark, FOLDER).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = table(spark, FOLDER, "labels").select("doc_id", "toxic").toPandas()
    assert scored.held_out.tolist() == [_held(d) for d in scored.doc_id]
    held = scored[scored.held_out].merge(labels, on="doc_id")
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert len(toxic) > 50
    assert toxic.predicted.mean() > 0.8
    assert clean.predicted.mean() < 0.01
    assert ((scored.score >= 0.5) == (scored.predicted == 1)).all() and scored.score.between(0, 1).all()


def _small(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows, labels = [], []
    for i in range(300):
        toxic = int(i % 4 == 0)
        text = " ".join(words[(i * k) % 5] for k in range(1, 6)) + (" badword!" if toxic else "")
        rows.append((i, text, "en", "src"))
        labels.append((i, i % 2, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark):
    docs, labels = _small(spark)
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    first = {r.doc_id: r.score for r in toxicity(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in toxicity(other, turned.withColumn("quality", F.lit(0))).collect()}
    assert all((first[i] >= 0.5) == (i % 4 == 0) for i in first)


def test_ratios_equal_plain_counts(spark):
    docs, labels = _small(spark)
    rows = labelled(docs, labels).collect()
    shuffled = labelled(docs, labels, broadcast_bytes=0).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, shuffled))
    assert len(rows) == sum(not _held(i) for i in range(300))
    settings = Toxicity(bits=14)
    features = _Features(settings)
    counts = np.zeros((2, 1 << 14))
    for row in rows:
        counts[row.toxic, sorted({int(g) for grams in features.grams(row.text) for g in grams})] += 1
    n = [sum(r.toxic == k for r in rows) for k in (0, 1)]
    ratios = _ratios(counts[0], counts[1], tuple(n), settings)
    for feature in np.flatnonzero(ratios)[:50]:
        want = np.log((counts[1, feature] + 1) / (n[1] + 2)) - np.log((counts[0, feature] + 1) / (n[0] + 2))
        assert abs(ratios[feature] - want) < 1e-12
    found = [features.present(r.text) for r in sorted(rows, key=lambda r: (r.draw, r.toxic))]
    found = [f[ratios[f] != 0] for f in found]
    toxic = np.array([r.toxic for r in sorted(rows, key=lambda r: (r.draw, r.toxic))])
    want = fit(toxic, np.concatenate(found), np.array([len(f) for f in found]), ratios, settings)
    got = train(docs, labels, settings)
    assert np.allclose(got.weights, want.weights, atol=1e-5) and abs(got.intercept - want.intercept) < 1e-5


def test_long_text_is_read_whole(spark):
    docs, labels = _small(spark)
    model = train(docs, labels)
    long = "alpha beta " * 200_000
    rows = spark.createDataFrame([(1, long), (2, long + " badword badword!"), (3, "alpha beta")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in score(rows, model).collect()}
    assert got[1] == got[3] or abs(got[1] - got[3]) < 0.2
    assert got[2] > got[1]


def test_odd_rows(spark, odd_docs, no_docs):
    _, labels = _small(spark)
    odd_labels = spark.createDataFrame([(1, 0, None), (None, 1, 1), (2, 0, 7), (3, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, odd_labels, odd_labels.limit(0)):
        got = toxicity(odd_docs, known)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        rows = got.collect()
        assert len(rows) == odd_docs.count()
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
        assert toxicity(no_docs, known).count() == 0
    texts = odd_docs.select("doc_id", "text").where("text IS NULL OR text = ''")
    assert len({r.score for r in toxicity(texts, labels).collect()}) == 1


def test_one_class_of_labels(spark):
    docs, labels = _small(spark)
    for toxic in (0, 1):
        got = toxicity(docs, labels.where(F.col("toxic") == toxic)).collect()
        assert {r.predicted for r in got} == {toxic}
