"""Toxicity scores by a linear classifier over character n-grams.

A text is lower-cased, ASCII characters other than letters and digits become
spaces, runs of spaces one. Which hashed n-grams occur in a text are its
features, each scaled by its naive Bayes log-count ratio: the logarithm of the
share of toxic labelled texts that have it over that of the others. The ratios
are counted over all labelled texts for training. A logistic regression with
both classes weighing the same gives the features' weights; it is fitted on a
bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrocohort.llm.texts import unused
from retrocohort.staging import BROADCAST_BYTES, stage, stored

_STEP = np.uint64(0xD1342543DE82EF95)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
# Characters of a long text that are hashed at a time.
_CHUNK = 1 << 18


@dataclass(frozen=True)
class Toxicity:
    """Parameters of the classifier.

    ``lengths`` of the n-grams, hashed to 2**``bits`` features. Features that
    fewer than ``least_texts`` labelled texts have, or whose ratio is below
    ``least_ratio`` either way, are left out. The regression is fitted on about
    ``sample`` texts of each class at most, drawn by a hash of doc_id, and on
    ``sample_features`` features in them at most.
    """

    lengths: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 18
    smoothing: float = 1.0
    least_texts: int = 3
    least_ratio: float = 1.0
    penalty: float = 0.01
    sample: int = 6_000
    sample_features: int = 30_000_000
    steps: int = 200


@dataclass(frozen=True)
class Model:
    """Weight of each feature, ratio included, and the intercept."""

    weights: np.ndarray
    intercept: float


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are kept from training: crc32 of doc_id as text is a multiple of 5; false for NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _plain_table() -> np.ndarray:
    return np.array([c if chr(c).isalnum() else 32 for c in range(128)], dtype=np.uint32)


class _Features:
    """Hashed n-grams of a text, a chunk of it at a time."""

    def __init__(self, settings: Toxicity):
        self.settings = settings
        self.plain = _plain_table()
        self.seen = np.zeros(1 << settings.bits, dtype=bool)

    def grams(self, text: str) -> Iterator[np.ndarray]:
        """Features at every place of the text, repeats included."""
        code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = np.where(code < 128, self.plain[np.minimum(code, 127)], code)
        space = code == 32
        code = code[~(space & np.append(False, space[:-1]))].astype(np.uint64)
        overlap = max(self.settings.lengths) - 1
        for first in range(0, max(1, len(code) - overlap), _CHUNK):
            yield from self._hashed(code[first : first + _CHUNK + overlap])

    def _hashed(self, code: np.ndarray) -> Iterator[np.ndarray]:
        value = code
        for n in range(2, max(self.settings.lengths) + 1):
            if len(code) < n:
                return
            value = value[:-1] * _STEP + code[n - 1 :]
            if n in self.settings.lengths:
                mixed = value ^ np.uint64(n)
                mixed ^= mixed >> np.uint64(31)
                mixed *= _SPREAD
                yield (mixed >> np.uint64(64 - self.settings.bits)).astype(np.int64)

    def present(self, text: str) -> np.ndarray:
        """The features that occur, ascending."""
        for grams in self.grams(text):
            self.seen[grams] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found

    def total(self, text: str, weights: np.ndarray) -> float:
        """The sum of the weights of the features that occur."""
        weighed = [grams[weights[grams] != 0] for grams in self.grams(text)]
        return float(weights[np.unique(np.concatenate(weighed))].sum()) if weighed else 0.0


def _counter(settings: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(settings)
        counts = np.zeros((2, 1 << settings.bits), dtype=np.int64)
        texts = [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[toxic, features.present(text.as_py() or "")] += 1
                texts[toxic] += 1
        found = np.flatnonzero(counts.any(axis=0))
        columns = [np.append(-1, found), np.append(texts[0], counts[0, found]), np.append(texts[1], counts[1, found])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["feature", "clean", "toxic"])

    return run


def _sampler(settings: Toxicity, ratios: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(settings)
        for batch in batches:
            found = [features.present(t.as_py() or "") for t in batch.column(0)]
            found = [f[ratios[f] != 0] for f in found]
            at = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            values = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *found]), pa.int32())
            columns = [batch.column(1), batch.column(2), pa.ListArray.from_arrays(at, values)]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "draw", "features"])

    return run


def _scorer(settings: Toxicity, model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(settings)
        for batch in batches:
            sums = [features.total(t.as_py() or "", model.weights) + model.intercept for t in batch.column(0)]
            score = pa.array(1 / (1 + np.exp(-np.clip(sums, -500, 500))), pa.float64())
            yield pa.RecordBatch.from_arrays([score, *batch.columns[1:]], names=["score", *batch.schema.names[1:]])

    return run


def _ratios(clean: np.ndarray, toxic: np.ndarray, texts: tuple[int, int], settings: Toxicity) -> np.ndarray:
    """Log-count ratios; 0 for features that are left out."""
    share = [(n + settings.smoothing) / (m + 2 * settings.smoothing) for n, m in zip((clean, toxic), texts, strict=True)]
    ratios = np.log(share[1]) - np.log(share[0])
    ratios[(clean + toxic < settings.least_texts) | (np.abs(ratios) < settings.least_ratio)] = 0
    return ratios


def fit(toxic: np.ndarray, features: np.ndarray, lengths: np.ndarray, ratios: np.ndarray, settings: Toxicity) -> Model:
    """Logistic regression over scaled features, by L-BFGS.

    ``features`` are those of all texts behind each other, ``lengths`` how many
    each has. Both classes weigh one half; ``penalty`` is on squared weights.
    """
    used, column = np.unique(features, return_inverse=True)
    row, value, n = np.repeat(np.arange(len(toxic)), lengths), ratios[features], len(used)
    weight = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum()))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        total = np.bincount(row, value * x[column], len(toxic)) + x[n]
        error = weight * (1 / (1 + np.exp(-np.clip(total, -500, 500))) - toxic)
        gradient = np.append(np.bincount(column, value * error[row], n) + settings.penalty * x[:n], error.sum())
        return float((weight * (np.logaddexp(0, total) - toxic * total)).sum() + settings.penalty / 2 * x[:n] @ x[:n]), gradient

    x = _minimum(loss, np.zeros(n + 1), settings.steps)
    weights = np.zeros(len(ratios))
    weights[used] = x[:n] * ratios[used]
    return Model(weights.astype(np.float32), float(x[n]))


def _minimum(loss, x: np.ndarray, steps: int, kept: int = 8) -> np.ndarray:
    """Where a convex function is least: quasi-Newton steps from the last ``kept`` changes."""
    value, gradient = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, shares = gradient.copy(), []
        for move, change in reversed(moves):
            shares.append(move @ direction / (move @ change))
            direction -= shares[-1] * change
        if moves:
            direction *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1])
        for (move, change), share in zip(moves, reversed(shares), strict=True):
            direction += (share - change @ direction / (move @ change)) * move
        size, slope = 1.0, -(direction @ gradient)
        after, next_gradient = loss(x - size * direction)
        while after > value + 1e-4 * size * slope and size > 1e-8:
            size /= 2
            after, next_gradient = loss(x - size * direction)
        move, change = -size * direction, next_gradient - gradient
        if move @ change > 1e-12:
            moves = [*moves[1 - kept :], (move, change)]
        done = abs(value - after) <= 1e-7 * max(abs(value), 1e-3)
        x, value, gradient = x + move, after, next_gradient
        if done:
            break
    return x


def _trainer(settings: Toxicity, ratios: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, found, total = [], [], 0
        for batch in batches:
            for label, features in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if total + len(features) > settings.sample_features:
                    break
                total += len(features)
                toxic.append(label)
                found.append(features.values.to_numpy())
        lengths = np.array([len(f) for f in found], dtype=np.int64)
        every = np.concatenate([np.zeros(0, dtype=np.int64), *found]).astype(np.int64)
        model = fit(np.array(toxic, dtype=np.int64), every, lengths, ratios, settings)
        used = np.flatnonzero(model.weights)
        weights = np.append(model.intercept, model.weights[used])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, used)), pa.array(weights)], names=["feature", "weight"])

    return run


def labelled(docs: DataFrame, labels: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """text, toxic (0 or 1) and draw of the documents whose labels may be learned.

    Documents that share a doc_id count each; of several labels of a doc_id the
    highest counts, and labels other than 0 and 1 none. draw is a hash of doc_id
    between 0 and 1 that decides about the sample. The labels are sent to the
    executors within ``broadcast_bytes``; beyond, the join is a shuffle.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    known = known.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = stage(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 11) / float(1 << 53)
    return rows.join(stored(known, broadcast_bytes).side, "doc_id").select("text", "toxic", draw.alias("draw"))


def train(
    docs: DataFrame, labels: DataFrame, settings: Toxicity = Toxicity(), broadcast_bytes: int = BROADCAST_BYTES
) -> Model:
    """The classifier, from documents (doc_id, text) and labels (doc_id, toxic) that are not held out.

    Without texts of both classes all weights are 0 and the intercept says the
    class that there is, or clean. What reaches the driver is bounded by the
    number of features.
    """
    spark = docs.sparkSession
    rows = labelled(docs, labels, broadcast_bytes)
    counted = rows.select("text", "toxic").mapInArrow(_counter(settings), "feature long, clean long, toxic long")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = np.zeros((2, 1 << settings.bits))
    texts = (0, 0)
    found = counted.toArrow()
    feature, clean, toxic = (found.column(i).to_numpy() for i in range(3))
    if len(feature):
        texts = (int(clean[feature < 0].sum()), int(toxic[feature < 0].sum()))
        real = feature >= 0
        counts[0, feature[real]], counts[1, feature[real]] = clean[real], toxic[real]
    if not all(texts):
        return Model(np.zeros(1 << settings.bits, dtype=np.float32), 500.0 if texts[1] else -500.0)
    ratios = _ratios(counts[0], counts[1], texts, settings)
    rate = F.when(F.col("toxic") == 1, settings.sample / texts[1]).otherwise(settings.sample / texts[0])
    chosen = rows.where(F.col("draw") < rate)
    sample = stage(chosen.mapInArrow(_sampler(settings, ratios), "toxic int, draw double, features array<int>"), "sample")
    one = sample.repartition(1).sortWithinPartitions("draw", "toxic")
    fitted = one.mapInArrow(_trainer(settings, ratios), "feature long, weight double").toArrow()
    feature, weight = fitted.column(0).to_numpy(), fitted.column(1).to_numpy()
    weights = np.zeros(1 << settings.bits, dtype=np.float32)
    weights[feature[feature >= 0]] = weight[feature >= 0]
    return Model(weights, float(weight[feature < 0][0]))


def score(docs: DataFrame, model: Model, settings: Toxicity = Toxicity()) -> DataFrame:
    """``docs`` with a score between 0 and 1 from the whole text; NULL counts as empty. A column score is replaced."""
    text = unused("text_", docs)
    kept = [c for c in docs.columns if c.lower() != "score"]
    rows = docs.select(F.col("text").cast("string").alias(text), *kept)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    scored = rows.mapInArrow(_scorer(settings, model), f"score double, {kinds}")
    return scored.select(*kept, "score")


def toxicity(docs: DataFrame, labels: DataFrame, settings: Toxicity = Toxicity()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    predicted is 1 from a score of 0.5. Repeated rows and rows without doc_id
    are scored each; equal texts have equal scores. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = score(rows, train(docs, labels, settings), settings)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
