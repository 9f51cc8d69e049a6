"""Alignment of the tokens of two tokenizers over the same text, and links between their ids.

A text with a space before it is encoded by a byte-level tokenizers file (A)
and by a sentencepiece model (B), which adds that space. Character offsets of A
and byte spans of B's immutable proto are the coarse cuts; where a token ends
inside a character, and at byte-fallback pieces, decoded bytes refine them.
Byte offsets where tokens of both end cut the tokens into groups; the two
tokens that end there are linked.

Neither tokenizer has tokens that go on past a single space or line feed, or
from a letter to a mark of punctuation (of B's model that is checked). Texts are
therefore cut there, and each distinct part is encoded and aligned once in a
task, many new ones at a time with line feeds between them. A text with white
space of other kinds, or with a part whose decoded bytes differ from it, is
aligned as a whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.staging import BROADCAST_BYTES, Lookup, lookup, stage

# White space of either tokenizer, and characters that Python alone takes for it.
_SPACE = "\t-\r \x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER = re.compile(f"(?![ \n])[{_SPACE}]")
_MARK = "!-/:-@\\[-`{-~"
_LETTER = "[^\\W\\d_\u00b2\u00b3\u00b9]"
_PART = re.compile(f"\n| ?{_LETTER}+(?=[ \n{_MARK}]|\\Z)| ?[^ \n]+")
_CROSSING = re.compile(f"[^▁]▁|{_LETTER}[{_MARK}]|.\n|\n.")
_BYTE = re.compile("<0x[0-9A-F]{2}>")

# Parts whose alignment a task remembers; beyond, it starts anew.
REMEMBERED = 600_000
# New parts that the tokenizers get as one text.
JOINED = 128
# Documents whose new parts are encoded together.
TOGETHER = 256
# An id pair as one number: A's id times this, plus B's id.
PAIR = 1 << 32

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<int>"
)


@dataclass
class Alignment:
    """Tokens of one text: numbers of both and of groups, groups as ``a1,a2|b1;a3|b2``, linked id pairs in order."""

    n_a: int
    n_b: int
    n_groups: int
    groups: bytes
    pairs: np.ndarray


_NONE = Alignment(0, 0, 0, b"", np.zeros(0, dtype=np.int64))


def parts(text: str) -> list[str] | None:
    """``text`` behind a space, cut where no token goes on; None if it has white space of other kinds or in runs."""
    if text[0] in " \n" or text[-1] in " \n" or any(run in text for run in ("  ", " \n", "\n ", "\n\n")):
        return None
    return None if _OTHER.search(text) else _PART.findall(f" {text}")


class _Numbers(dict):
    """Numbers of parts in the order in which they are first asked for; new ones are listed."""

    def __init__(self, *first: str):
        super().__init__((part, i) for i, part in enumerate(first))
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        self.new.append(part)
        self[part] = number = len(self)
        return number


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, loaded from their files."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = _byte_alphabet()
        alphabet = _byte_alphabet()
        vocabulary = sorted((number, entry) for entry, number in self.a.get_vocab().items())
        if [number for number, _ in vocabulary] != list(range(len(vocabulary))):
            raise ValueError("the ids of the byte-level vocabulary have gaps")
        self.a_bytes = [
            bytes(map(alphabet.__getitem__, e)) if all(c in alphabet for c in e) else e.encode() for _, e in vocabulary
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        fallback = [self.b.is_byte(i) and bool(_BYTE.fullmatch(p)) for i, p in enumerate(pieces)]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if single else p.replace("▁", " ").encode()
            for p, single in zip(pieces, fallback, strict=True)
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.fallback = np.array(fallback)
        matched = [p for i, p in enumerate(pieces) if not (fallback[i] or self.b.is_control(i) or self.b.is_unknown(i))]
        self.cuts = not any(_CROSSING.search(p) for p in matched)

    def spans(self, texts: list[str]) -> tuple | None:
        """Ids of A, ids of B and the byte offsets in the joined texts where their tokens end.

        Each text begins with the space that B adds, or with a line feed, before
        which that space is dropped. None where the decoded bytes of A or B
        differ from the texts.
        """
        raw = [text.encode() for text in texts]
        spaced = [text.startswith(" ") for text in texts]
        found = self.a.encode_batch(texts, add_special_tokens=False)
        plain = [t[1:] if s else t for t, s in zip(texts, spaced, strict=True)]
        protos = self.b.encode(plain, return_type="proto", num_threads=1)
        ids, ends, base = ([], []), ([], []), 0
        for text, data, space, one, proto in zip(texts, raw, spaced, found, protos, strict=True):
            pieces = proto.pieces[0 if space or not proto.pieces else 1 :]
            if not space and proto.pieces and self.b_bytes[proto.pieces[0].id] != b" ":
                return None
            a, b = one.ids, [p.id for p in pieces]
            if b"".join([self.a_bytes[i] for i in a]) != data or b"".join([self.b_bytes[i] for i in b]) != data:
                return None
            at = np.arange(len(text) + 1)
            if len(text) < len(data):
                code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
                at[1:] += np.cumsum((code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000))
            offsets = np.array(one.offsets, dtype=np.int64).reshape(-1, 2)
            shared = np.append(offsets[1:, 0] < offsets[:-1, 1], [False] * min(1, len(a)))
            for side, numbers in zip(ids, (a, b), strict=True):
                side.append(np.array(numbers, dtype=np.int64))
            ends[0].append(base + _refined(at[offsets[:, 1]], shared, self.a_size[ids[0][-1]]))
            told = np.array([p.end for p in pieces], dtype=np.int64) + space
            ends[1].append(base + _refined(told, self.fallback[ids[1][-1]], self.b_size[ids[1][-1]]))
            base += len(data)
        return tuple(np.concatenate(x) for x in (*ids, *ends))

    def align(self, text: str) -> Alignment | None:
        """The alignment of a whole text that begins with the space that B adds, or with a line feed."""
        spans = self.spans([text])
        if spans is None:
            return None
        a, b, cut_a, cut_b = _cut(*spans)
        groups = _stream(a, b, cut_a, cut_b)[0].tobytes()[:-1]
        return Alignment(len(a), len(b), len(cut_a), groups, a[cut_a] * PAIR + b[cut_b])


def _refined(ends: np.ndarray, unclear: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens; unclear ones lie their own and their neighbours' decoded bytes behind the last clear end."""
    if not unclear.any():
        return ends
    decoded = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(unclear, -1, np.arange(len(ends))))
    before = np.where(last >= 0, ends[last] - decoded[last], 0)
    return np.where(unclear, before + decoded, ends)


def _cut(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple:
    """Ids of both, and which tokens of both end where a token of the other ends."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return a, b, np.searchsorted(a_ends, common), np.searchsorted(b_ends, common)


def _stream(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;`` for all groups in order, and where each token's begin (one more than tokens).

    The tokens of a group stand together, those of A first.
    """
    n = len(a) + len(b)
    number, mark = np.zeros(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8)
    begin_b, end_a = np.append(0, cut_b + 1), np.append(cut_a + 1, len(a))
    at_a = np.arange(len(a)) + begin_b[np.searchsorted(cut_a, np.arange(len(a)))]
    at_b = np.arange(len(b)) + end_a[np.searchsorted(cut_b, np.arange(len(b)))]
    number[at_a], number[at_b] = a, b
    mark[at_a[cut_a]], mark[at_b[cut_b]] = ord("|"), ord(";")
    digits = np.ones(n, dtype=np.int64)
    for power in range(1, len(str(int(number.max(initial=0))))):
        digits += number >= 10**power
    ends = np.cumsum(digits + 1)
    out = np.zeros(int(ends[-1]) if n else 0, dtype=np.uint8)
    out[ends - 1] = mark
    place = ends - 2
    while len(number):
        out[place] = ord("0") + number % 10
        number //= 10
        more = number > 0
        number, place = number[more], place[more] - 1
    return out, np.append(0, ends)


class _Memory:
    """Alignments of parts under numbers, kept as arrays."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.forget()

    def forget(self) -> None:
        line = self.aligner.align("\n") or _NONE
        self.number = _Numbers("\n")
        self.groups = [line.groups]
        self.sizes = np.array([[line.n_a, line.n_b, line.n_groups]])
        self.whole = np.array([line.n_groups > 0])
        self.pairs = line.pairs
        self.begin = np.array([0, len(line.pairs)])

    def learn(self, new: list[str]) -> None:
        """Aligns new parts, each behind a line feed; halves them while a tokenizer changes one of them."""
        joined = ["\n" + "\n".join(new[i : i + JOINED]) for i in range(0, len(new), JOINED)]
        spans = self.aligner.spans(joined)
        if spans is None and len(new) > 1:
            half = len(new) // 2
            self.learn(new[:half])
            self.learn(new[half:])
            return
        if spans is None:
            sizes, groups, pairs = np.zeros((1, 3), dtype=np.int64), [b""], self.pairs[:0]
        else:
            a, b, cut_a, cut_b = _cut(*spans)
            ends = np.cumsum([len(part.encode()) + 1 for part in new])
            upto = [np.searchsorted(x, ends, side="right") for x in (spans[2], spans[3], spans[2][cut_a])]
            sizes = np.diff(np.stack(upto, axis=1), axis=0, prepend=0) - 1  # without the line feed
            text, at = _stream(a, b, cut_a, cut_b)
            last = at[upto[0] + upto[1]]
            first = at[np.append(0, (upto[0] + upto[1])[:-1]) + 2]
            data = text.tobytes()
            groups = [data[x : y - 1] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
            pairs = np.delete(a[cut_a] * PAIR + b[cut_b], np.append(0, upto[2][:-1]))
        self.whole = np.append(self.whole, np.full(len(new), spans is not None))
        self.groups += groups
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pairs = np.append(self.pairs, pairs)
        self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(sizes[:, 2]))

    def __call__(self, texts: list[str]) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs, their times."""
        if len(self.number) > REMEMBERED:
            self.forget()
        cut = [(text and self.aligner.cuts and parts(text)) or [] for text in texts]
        which = [np.fromiter(map(self.number.__getitem__, found), dtype=np.int64, count=len(found)) for found in cut]
        if self.number.new:
            self.learn(self.number.new)
            self.number.new = []
        sizes, hashes, pairs, times = np.zeros((len(texts), 4), dtype=np.int64), [""] * len(texts), [], []
        for i, (text, w) in enumerate(zip(texts, which, strict=True)):
            if len(w) and self.whole[w].all():
                sizes[i, :3] = self.sizes[w].sum(axis=0)
                first = self.begin[w]
                n = self.begin[w + 1] - first
                ends = np.cumsum(n)
                linked = self.pairs[np.repeat(first - ends + n, n) + np.arange(ends[-1])]
                groups = b";".join(map(self.groups.__getitem__, w.tolist()))
            else:
                one = (self.aligner.align(f" {text}") if text else None) or _NONE
                sizes[i, :3], linked, groups = (one.n_a, one.n_b, one.n_groups), one.pairs, one.groups
            sizes[i, 3] = len(linked)
            hashes[i] = hashlib.sha256(groups).hexdigest() if groups else ""
            kept, often = np.unique(linked, return_counts=True)
            pairs.append(kept)
            times.append(often)
        at = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
        lists = [
            pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), kind))
            for x, kind in ((pairs, pa.int64()), (times, pa.int32()))
        ]
        return [*(pa.array(column) for column in sizes.T), pa.array(hashes, pa.string()), *lists]


def _aligned(byte_level: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(Aligner(byte_level, pieces))
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
        for batch in batches:
            for first in range(0, len(batch), TOGETHER):
                rows = batch.slice(first, TOGETHER)
                columns = memory([t.as_py() or "" for t in rows.column(1)])
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns], names=names)

    return run


def aligned_documents(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Alignment of every row of ``docs`` (doc_id, text): ``ALIGNED`` and a number of the row, written once.

    ``byte_level`` and ``pieces`` are paths of tokenizer files that executors
    can read. pairs are the distinct linked ids (:data:`PAIR`), times how often
    the row links each. NULL and empty texts, and texts that either tokenizer
    changes, have zeros, no pairs and an empty hash. Repeated rows and rows that
    share a doc_id, or have none, are aligned each. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = rows.mapInArrow(_aligned(byte_level, pieces), ALIGNED)
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "aligned")


def link_counts(aligned: DataFrame) -> DataFrame:
    """pair, n, best for all linked id pairs: their links in all documents, and 1 if no pair of that B id has more."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counted = stage(links.groupBy("link.pairs").agg(F.sum("link.times").alias("n")).toDF("pair", "n"), "link_counts")
    b_id = F.pmod("pair", F.lit(PAIR))
    most = counted.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    joined = counted.withColumn("b", b_id).join(most, "b")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def _frequent(counts: Lookup, rows: int) -> int:
    """The least number of links such that at most ``rows`` pairs have that or more."""
    by_n = counts.table.groupBy("n").agg(F.count(F.lit(1)).alias("pairs"))
    doubling = by_n.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.sum("pairs").alias("pairs")).collect()
    above, least = 0, 1 << 62
    for power, pairs in sorted(doubling, reverse=True):
        above += pairs
        if above > rows:
            break
        least = 1 << power
    return least


def linked_documents(
    docs: DataFrame, byte_level: str, pieces: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    n_best counts the row's links whose pair no other pair of the same B id
    exceeds in all documents; count_sum adds up the counts of the pairs. Rows
    without tokens have zeros. Counts are sent to the executors if they stay
    within ``broadcast_bytes``; else the most frequent pairs are, which have
    nearly all links, and only the others are shuffled.
    """
    aligned = aligned_documents(docs, byte_level, pieces)
    counts = lookup(link_counts(aligned), "link_ledger", broadcast_bytes)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    if counts.small:
        judged = [links.join(counts.side, "pair")]
    else:
        least = _frequent(counts, broadcast_bytes // 160)
        frequent = F.broadcast(counts.table.where(F.col("n") >= least))
        rare = links.join(frequent, "pair", "left_anti").join(counts.table.where(F.col("n") < least), "pair")
        judged = [links.join(frequent, "pair"), rare]
    sums = [F.sum(F.col("times") * F.col("best")), F.sum(F.col("times") * F.col("n"))]
    summed = [j.groupBy("row").agg(sums[0].alias("n_best"), sums[1].alias("count_sum")) for j in judged]
    if len(summed) > 1:
        both = summed[0].unionByName(summed[1]).groupBy("row")
        summed = [both.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))]
    none = F.lit(0).cast("long")
    return aligned.join(summed[0], "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
    )
