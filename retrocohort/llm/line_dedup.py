"""Lines that repeat across documents.

:func:`drop_repeated_blocks` pairs each document with earlier ones by hashes of
the shortest runs of lines of enough words that both hold, aligns each pair by
patience diff and removes aligned blocks from the later document. A document
meets the first holder of each of its runs, not all of them, so a frequent line
gives one pair a document; a pair is the runs that it shares, so long documents
are not sent whole to each of their partners. As runs out of order are aligned
too, every run of enough words that any earlier document holds goes.

:func:`drop_repeated_lines` aligns whole documents with the first holder of each
of their longer lines only. Whatever it removes, the other removes too.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrocohort.llm.texts import WORD, mixed, polynomial
from retrocohort.staging import stage


# Scripts written without spaces; each of their characters counts as a word of a block.
UNSPACED = "".join(rf"\p{{Is{x}}}" for x in "Han Hiragana Katakana Thai Lao Khmer Myanmar Tibetan".split())
UNIT = rf"[{UNSPACED}]|(?<![^\x20\x09-\x0D])[^{UNSPACED}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])"


@dataclass(frozen=True)
class LineRule:
    """``line_words``: words that a line needs to start an alignment; ``block_words``: that a block needs to go."""

    line_words: int = 5
    block_words: int = 5


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, ascending in the first, that also ascends in the second."""
    tails: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for n, (_, b) in enumerate(pairs):
        at = bisect_left(tails, b)
        back.append(last[at - 1] if at else -1)
        tails[at : at + 1] = [b]
        last[at : at + 1] = [n]
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _by_occurrence(a: list[int], b: list[int], stretch: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Places of the n-th occurrence of each value on either side."""
    a0, a1, b0, b1 = stretch
    seen: Counter = Counter()
    place: dict[tuple[int, int], int] = {}
    for j in range(b0, b1):
        place[b[j], seen[b[j]]] = j
        seen[b[j]] += 1
    seen.clear()
    out = []
    for i in range(a0, a1):
        if (a[i], seen[a[i]]) in place:
            out.append((i, place[a[i], seen[a[i]]]))
        seen[a[i]] += 1
    return out


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matching places of two sequences, ascending in both.

    Between two places: equal ends are matched, then the longest ascending run
    of values that occur once on either side, and so on between those. Without
    such a value, equal values are paired by their occurrence number.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        anchors = _increasing([(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place])
        if not anchors:
            anchors = _increasing(_by_occurrence(a, b, (a0, a1, b0, b1)))
        if anchors:
            # an anchor begins its stretch, where it is matched as an equal end
            edges = [(a0, b0), *anchors, (a1, b1)]
            todo += [(i, k, j, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(out)


def repeated_places(earlier: list[int], later: list[int], n_words: list[int], block_words: int) -> list[int]:
    """Lines of the later document in aligned blocks of enough words."""
    out: list[int] = []
    block: list[int] = []
    previous = (-2, -2)
    for i, j in [*patience(earlier, later), (-2, -2)]:
        if (i, j) != (previous[0] + 1, previous[1] + 1):
            if sum(n_words[x] for x in block) >= block_words:
                out += block
            block = []
        block.append(j)
        previous = (i, j)
    return out


def _aligner(rule: LineRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in ("earlier", "later", "n_words")]
            places = [
                repeated_places(a.as_py(), b.as_py(), n.as_py(), rule.block_words)
                for a, b, n in zip(*columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(places, pa.list_(pa.int32()))],
                names=["doc_id", "version", "places"],
            )

    return run


def repeated_lines(docs: DataFrame, rule: LineRule = LineRule()) -> DataFrame:
    """doc_id, version, places: the lines (from 0) to remove from each document that repeats earlier ones.

    A document is a doc_id with a text; version is the text's hash, and orders
    texts that share a doc_id.
    """
    text = F.col("text").cast("string")
    lines = F.split(text, "\n", -1)
    lined = stage(
        docs.where("doc_id is not null and text is not null")
        .select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("version"), lines.alias("lines"))
        .select(
            "doc_id",
            "version",
            F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
            F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("n_words"),
        ),
        "lines",
    )
    each = lined.select("doc_id", "version", F.explode(F.arrays_zip("hashes", "n_words")).alias("line")).where(
        F.col("line.n_words") >= rule.line_words
    )
    held = each.select(F.struct("doc_id", "version").alias("holder"), F.col("line.hashes").alias("line"))
    first = stage(
        held.groupBy("line").agg(F.min("holder").alias("first"), F.max("holder").alias("last")).where("first <> last"),
        "first_holders",
    )
    pairs = stage(
        held.join(first, "line").where("holder <> first").select("first", "holder").distinct(), "alignments"
    )
    one = lined.dropDuplicates(["doc_id", "version"])
    earlier = one.select(F.struct("doc_id", "version").alias("first"), F.col("hashes").alias("earlier"))
    later = one.select(
        F.struct("doc_id", "version").alias("holder"), "doc_id", "version", F.col("hashes").alias("later"), "n_words"
    )
    aligned = (
        pairs.join(earlier, "first")
        .join(later, "holder")
        .select("doc_id", "version", "earlier", "later", "n_words")
        .mapInArrow(_aligner(rule), "doc_id long, version long, places array<int>")
    )
    return (
        aligned.where(F.size("places") > 0)
        .select("doc_id", "version", F.explode("places").alias("place"))
        .groupBy("doc_id", "version")
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )


def drop_repeated_lines(docs: DataFrame, rule: LineRule = LineRule()) -> DataFrame:
    """doc_id, text, n_lines, n_removed for every row: the text without lines that earlier documents hold.

    Earlier is the smaller doc_id; of texts that share a doc_id, the smaller
    hash. Repeated rows are one document and do not remove each other. Rows
    without doc_id or text come back as they are; NULL has 0 lines, the empty
    text one. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = stage(repeated_lines(rows, rule), "repeated_lines")
    joined = rows.withColumn("version", F.xxhash64("text")).join(found, ["doc_id", "version"], "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("places"), i))
    return joined.select(
        "doc_id",
        F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_removed"),
    )


def block_windows(
    hashes: np.ndarray, n_words: np.ndarray, offsets: np.ndarray, block_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last place of the shortest runs of enough words from and up to every line.

    ``offsets`` say where each document's lines begin (one more than documents);
    places count from the first line of all. A run of enough words is the union
    of those within it.
    """
    n = len(hashes)
    at = np.arange(n)
    sums = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(n_words, out=sums[1:])
    size = np.diff(offsets)
    begins, ends = np.repeat(offsets[:-1], size), np.repeat(offsets[1:], size)
    last = np.maximum(np.searchsorted(sums, sums[:-1] + block_words, side="left") - 1, at)
    first = np.minimum(np.searchsorted(sums, sums[1:] - block_words, side="right") - 1, at)
    whole = last < ends
    # the same run is listed once
    other = first >= begins
    other[other] = last[first[other]] != at[other]
    a, b = np.concatenate([at[whole], first[other]]), np.concatenate([last[whole], at[other]])
    return polynomial(mixed(hashes), a, b + 1), a, b


def _windows(rule: LineRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(n) for n in ("hashes", "n_words")]
            hashes, n_words = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            offsets = np.zeros(len(batch) + 1, dtype=np.int64)
            np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False), out=offsets[1:])
            found, a, b = block_windows(hashes.view(np.uint64), n_words, offsets, rule.block_words)
            row = np.searchsorted(offsets, a, side="right") - 1
            columns = [batch.column(n).take(pa.array(row)) for n in ("doc_id", "version")]
            columns += [pa.array(found.view(np.int64))]
            columns += [pa.array((x - offsets[row]).astype(np.int32)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "run", "begin", "end"])

    return run


def aligned_blocks(earlier: list[tuple[int, int]], later: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """First and last lines of the later document's blocks that align with an earlier one.

    ``earlier`` has the place and hash of each shared run of lines, ``later`` the
    first and last line and the hash of each of its own. The runs are aligned by
    patience diff. What that leaves, being moved or held again, is aligned with
    the run's place in the earlier document. Neighbouring runs at the same
    distance in both documents are one block.
    """
    earlier, later = sorted(earlier), sorted(later)
    pairs = patience([run for _, run in earlier], [run for _, _, run in later])
    in_order = {j: earlier[i][0] for i, j in pairs}
    place = {run: at for at, run in earlier}
    moved = {j: place[run] for j, (_, _, run) in enumerate(later) if j not in in_order}
    out: list[tuple[int, int]] = []
    for aligned in (in_order, moved):
        distance = None
        for j, at in aligned.items():
            begin, end, _ = later[j]
            if begin - at == distance and begin <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(out[-1][1], end))
            else:
                out.append((begin, end))
            distance = begin - at
    return out


def _block_aligner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = []
        for runs in batch.column("runs"):
            pairs: defaultdict = defaultdict(lambda: ({}, []))
            for r in runs.as_py():
                earlier, later = pairs[r["first_id"], r["first_version"]]
                earlier[r["run"]] = r["place"]
                later.append((r["begin"], r["end"], r["run"]))
            blocks = [
                block
                for earlier, later in pairs.values()
                for block in aligned_blocks([(at, run) for run, at in earlier.items()], later)
            ]
            step = np.zeros(max(end for _, end in blocks) + 2, dtype=np.int64)
            np.add.at(step, [begin for begin, _ in blocks], 1)
            np.add.at(step, [end + 1 for _, end in blocks], -1)
            gone.append(np.cumsum(step[:-1]) > 0)
        columns = [batch.column("doc_id"), batch.column("version"), pa.array(gone, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "gone"])


def _n_units(line: Column) -> Column:
    """Words of a line; a word with characters of scripts without spaces counts as so many."""
    spaced = F.regexp_count(line, F.lit(WORD))
    return F.when(line.rlike(f"[{UNSPACED}]"), F.regexp_count(line, F.lit(UNIT))).otherwise(spaced)


def shared_runs(docs: DataFrame, rule: LineRule) -> DataFrame:
    """doc_id, version, run, begin, end, first_id, first_version, place: runs that an earlier document holds.

    A document is what it is to :func:`repeated_lines`. ``first_id`` and
    ``first_version`` are the first document that holds the run, ``place`` is
    where it begins there (the first one).
    """
    text = F.col("text").cast("string")
    windows = stage(
        docs.where("doc_id is not null and text is not null")
        .select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("version"), F.split(text, "\n", -1).alias("lines"))
        .select(
            "doc_id",
            "version",
            F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
            F.transform("lines", _n_units).alias("n_words"),
        )
        .mapInArrow(_windows(rule), "doc_id long, version long, run long, begin int, end int"),
        "line_runs",
    )
    first, last = F.min(F.struct("doc_id", "version", "begin")), F.max(F.struct("doc_id", "version"))
    holders = stage(
        windows.groupBy("run")
        .agg(first.alias("first"), last.alias("last"))
        .select(
            "run",
            F.col("first.doc_id").alias("first_id"),
            F.col("first.version").alias("first_version"),
            F.col("first.begin").alias("place"),
            "last",
        )
        .where("first_id <> last.doc_id or first_version <> last.version")
        .drop("last"),
        "first_holders",
    )
    return windows.join(holders, "run").where("doc_id <> first_id or version <> first_version")


def repeated_blocks(docs: DataFrame, rule: LineRule = LineRule()) -> DataFrame:
    """doc_id, version, gone: for each line up to the last to remove, whether it goes.

    Each document is aligned with the first holder of each run of lines that it
    shares with earlier documents; only the shared runs are needed for that. All
    pairs of a document are one row.
    """
    runs = F.struct("first_id", "first_version", "place", "run", "begin", "end")
    return (
        shared_runs(docs, rule)
        .groupBy("doc_id", "version")
        .agg(F.collect_set(runs).alias("runs"))
        .mapInArrow(_block_aligner, "doc_id long, version long, gone array<boolean>")
    )


def drop_repeated_blocks(docs: DataFrame, rule: LineRule = LineRule()) -> DataFrame:
    """doc_id, text, n_lines, n_removed for every row: the text without blocks that earlier documents hold.

    A block is a run of lines of ``block_words`` words together, however short
    the lines; a character of a script without spaces counts as a word.
    ``line_words`` is not read. What is earlier and how rows without doc_id or text come back
    is as in :func:`drop_repeated_lines`. The first holder of a line keeps it.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = stage(repeated_blocks(rows, rule), "repeated_blocks")
    joined = rows.withColumn("version", F.xxhash64("text")).join(found, ["doc_id", "version"], "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    removed = F.size(F.filter("gone", lambda x: x))
    return joined.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"),
    )
