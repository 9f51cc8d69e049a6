"""Passages of a benchmark inside documents.

A window of a document as long as an item is compared with the item. Windows
are those that hold at least one of the item's shingles: any other has
similarity 0. Each gets a 128-bit SimHash. Sixteen one-byte blocks index the
items' fingerprints: if two differ in at most 47 bits, some block differs in at
most two, so the index finds every item within that radius. The exact
similarity of the weighted shingles then decides.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.llm.texts import Words, chunks, mixed, rolled, sequence_hash, unused
from retrocohort.staging import stage

FOUND = "doc_id long, item_id long, start long, n_words long, similarity double"

_BLOCKS = 16
_PER_BLOCK = 2
RADIUS = _BLOCKS * (_PER_BLOCK + 1) - 1

_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class Leaks:
    """What counts as a leak.

    The similarity of a window and an item is the sum over their shingles of the
    smaller number of occurrences, over the sum of the larger one. A text with
    fewer words than one shingle has its whole sequence of words as one, so a
    short item is found in documents that consist of it. ``slice_bytes`` and
    ``slice_items`` bound the part of the benchmark that is in the driver and sent
    to the executors at once (an item's index takes 4 KB); a larger benchmark is
    searched slice by slice.
    """

    shingle: int = 5
    percent: int = 80
    slice_bytes: int = 16 << 20
    slice_items: int = 1 << 14


def fingerprints(shingles: np.ndarray) -> np.ndarray:
    """SimHash of each row of shingles: the majority of every bit, as 16 bytes."""
    n, width = shingles.shape
    both = np.stack([mixed(shingles), mixed(shingles ^ np.uint64(0x5851F42D4C957F2D))], axis=-1)
    bits = np.unpackbits(both.view(np.uint8).reshape(n, width, _BLOCKS), axis=-1)
    return np.packbits(2 * bits.sum(axis=1, dtype=np.int32) > width, axis=-1)


class _Items:
    """Items of one length: shingles, fingerprints and their index."""

    def __init__(self, ids: list[int], shingles: list[np.ndarray]):
        self.ids = ids
        self.prints = fingerprints(np.stack(shingles))
        self.counts = [Counter(s.tolist()) for s in shingles]
        self.values = [np.unique(s) for s in shingles]
        byte = np.arange(256, dtype=np.uint8)
        # near[block, value]: the items whose block differs from the value in few bits
        self.near = _ONES[byte[None, :, None] ^ self.prints.T[:, None, :]] <= _PER_BLOCK

    def candidates(self, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, windows within the radius)."""
        hit = np.zeros((len(prints), len(self.ids)), dtype=bool)
        for block in range(_BLOCKS):
            hit |= self.near[block][prints[:, block]]
        for item in np.flatnonzero(hit.any(axis=0)):
            rows = np.flatnonzero(hit[:, item])
            far = _ONES[prints[rows] ^ self.prints[item]].sum(axis=1)
            rows = rows[far <= RADIUS]
            if len(rows):
                yield int(item), rows


def _search(rule: Leaks, items: list[tuple[int, str]]):
    """A task function that finds the given items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        k = rule.shingle
        by_length: dict[int, tuple[list[int], list[np.ndarray]]] = defaultdict(lambda: ([], []))
        lengths: dict[int, set[int]] = defaultdict(set)
        short: dict[int, list[int]] = defaultdict(list)
        for place, (_, text) in enumerate(items):
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            found, _ = words.hashes(raw, np.array([0, len(raw)]))
            if len(found) < k:
                if len(found):
                    short[int(sequence_hash(found)[0])].append(place)
                continue
            shingles = rolled(found, k)
            by_length[len(found)][0].append(place)
            by_length[len(found)][1].append(shingles)
            for s in shingles.tolist():
                lengths[s].add(len(found))
        index = {n: _Items(*group) for n, group in by_length.items()}
        known = np.array(sorted(lengths), dtype=np.uint64)
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[known >> np.uint64(44)] = True
        sizes = [np.array(sorted(lengths[s]), dtype=np.int64) for s in known.tolist()]

        def windows(every: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            """Distinct (length, first word, words, document) of the windows to compare."""
            at = np.flatnonzero(maybe[every >> np.uint64(44)])
            which = np.searchsorted(known, every[at])
            which[which == len(known)] = 0
            sure = known[which] == every[at]
            at, which = at[sure], which[sure]
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + k <= offsets[doc + 1]
            parts = [np.zeros((0, 4), dtype=np.int64)]
            for p, w, d in zip(at[inside], which[inside], doc[inside], strict=True):
                first, end = offsets[d], offsets[d + 1]
                for n in sizes[w]:
                    m = min(n, end - first)
                    low, high = max(first, p + k - m), min(p, end - m)
                    part = np.empty((high - low + 1, 4), dtype=np.int64)
                    part[:, 0], part[:, 1], part[:, 2], part[:, 3] = n, np.arange(low, high + 1), m, d
                    parts.append(part)
            return np.unique(np.concatenate(parts), axis=0)

        def verified(every: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
            """(document, item, first word, words, similarity) of one length's windows."""
            n, m = int(group[0, 0]), int(group[0, 2])
            own = index[n]
            for a in range(0, len(group), 256):
                part = group[a : a + 256]
                shingles = every[part[:, 1, None] + np.arange(m - k + 1)]
                for item, rows in own.candidates(fingerprints(shingles)):
                    total = n + m - 2 * (k - 1)
                    shared = np.isin(shingles[rows], own.values[item]).sum(axis=1)
                    for row in rows[100 * shared >= rule.percent * (total - shared)]:
                        there = Counter(shingles[row].tolist())
                        both = sum(min(c, own.counts[item][s]) for s, c in there.items())
                        if 100 * both >= rule.percent * (total - both):
                            yield int(part[row, 3]), own.ids[item], int(part[row, 1]), m, both / (total - both)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            for first_row, _, data, offsets in chunks(batch.column(1)):
                found, begins = words.hashes(data, offsets)
                n_words = np.diff(begins)
                for doc in np.flatnonzero((n_words > 0) & (n_words < k)) if short else ():
                    whole = int(sequence_hash(found[begins[doc] : begins[doc + 1]])[0])
                    for item in short.get(whole, ()):
                        best[first_row + int(doc), item] = (1.0, 0, int(n_words[doc]))
                every = rolled(found, k)
                if not len(known) or not len(every):
                    continue
                todo = windows(every, begins)
                cuts = np.flatnonzero((np.diff(todo[:, 0]) != 0) | (np.diff(todo[:, 2]) != 0)) + 1
                # windows cut short by their document lie between full ones of the same length
                for group in np.split(todo, cuts) if len(todo) else ():
                    for doc, item, start, n, similarity in verified(every, group):
                        key, value = (first_row + doc, item), (similarity, int(begins[doc] - start), n)
                        best[key] = max(best.get(key, value), value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[row] for row, _ in best], pa.int64()),
                    pa.array([items[place][0] for _, place in best], pa.int64()),
                    pa.array([-back for _, back, _ in best.values()], pa.int64()),
                    pa.array([n for _, _, n in best.values()], pa.int64()),
                    pa.array([s for s, _, _ in best.values()], pa.float64()),
                ],
                names=["doc_id", "item_id", "start", "n_words", "similarity"],
            )

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, rule: Leaks = Leaks()) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity: the most similar window of each item in each document.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns
    are not read. Words are taken after lower-casing A-Z; ``start`` counts words
    from 0 and is the first of equally similar windows. A document shorter than
    the item is one window. NULL or empty texts and items leak nothing; repeated
    documents give repeated results, repeated items do not; an item_id with
    several texts counts as several items.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = items.distinct()
    size, n = items.agg(F.sum(F.octet_length("text") + 64), F.count(F.lit(1))).first()
    slices = max(1, -(-(size or 0) // rule.slice_bytes), -(-n // rule.slice_items))
    parts = []
    for s in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == s)
        rows = [tuple(row) for row in part.collect()]
        found = texts.mapInArrow(_search(rule, rows), FOUND)
        # written before the next slice is read, so that the driver holds one at a time
        parts.append(found if slices == 1 else stage(found, f"leaks_{s}"))
    return reduce(DataFrame.unionByName, parts)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, rule: Leaks = Leaks()) -> DataFrame:
    """The rows of ``docs`` without a passage of the benchmark; all columns.

    A row is judged by its own text, whatever its doc_id: rows that share one,
    or have none, go only if their text holds a passage.
    """
    version, gone = unused("leak_version", docs), unused("leaking", docs)
    text = F.col("text").cast("string")
    texts = docs.select(F.xxhash64(text).alias("doc_id"), text.alias("text"))
    found = find_leaks(texts, benchmark, rule).select(F.col("doc_id").alias(gone)).distinct()
    marked = docs.withColumn(version, F.xxhash64(text))
    return marked.join(found, F.col(version) == F.col(gone), "left_anti").select(*docs.columns)
