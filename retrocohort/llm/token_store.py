"""Token ids of whole documents in compressed, checksummed binary records.

Documents are put in ascending doc_id order over the partitions, encoded, and
gathered to records of whole documents. A record is a header with its
documents and blocks, then the blocks, each coded by itself
(:mod:`retrocohort.llm.token_coder`) and with its own checksum. Records are
written as the rows of Parquet files, so that a lost executor leaves no half
file behind.

Record, numbers little-endian: ``TIDS``, version (u32), documents (u32), ids
(u64), ids in a block (u32), blocks (u32); of all documents doc_id (i64, 0 if
NULL), then number of ids (u64), then whether doc_id is NULL (u8); of all blocks
bytes (u32), then CRC-32 of the ids (u32); CRC-32 of all this (u32); the blocks.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from retrocohort.llm.texts import chunks
from retrocohort.llm.token_coder import LIMIT, decode, encode
from retrocohort.staging import stage

MAGIC, VERSION = b"TIDS", 3
HEADER = "<4sIIQII"

# Ids in a block, and in a record unless one document has more.
BLOCK = 2048
RECORD = 2048 * BLOCK
# Blocks that are decoded together, of several records if they are small.
SIDE_BY_SIDE = 2 * RECORD // BLOCK
# Parts of words, and words that are encoded whole, whose ids a task remembers; beyond, it starts anew.
REMEMBERED = 400_000
# New words that the tokenizer gets as one text.
JOINED = 256
# Bytes of text whose distinct words are looked up together; one longer document is taken whole.
TOGETHER = 8 << 20

# What a tokenizer does before it looks at single parts of words, if it is of this kind. The pattern's
# classes of letters and digits are then those of the plain characters, and parts can be told without it.
PLAIN = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pre_tokenizer": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_ODD = re.compile("[^\n!-~À-ÖØ-öø-ÿ]")
_PARTS = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")

RECORDS = "part int, record int, payload binary"
STORED = "part int, record int, place long, doc_id long, n_tokens long, ids_crc32 long"


class _Numbers(dict):
    """Numbers of words or parts in the order in which they first came."""

    def add(self, words: list[str]) -> list[str]:
        """Those of distinct ``words`` that are new."""
        new = [w for w in words if w not in self]
        self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
        return new

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


class _Runs:
    """Ids of numbered things, one after the other."""

    def __init__(self):
        self.ids = np.zeros(0, dtype=np.int32)
        self.begin = np.zeros(1, dtype=np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, np.asarray(ids, dtype=np.int32)])
        self.begin = np.concatenate([self.begin, np.cumsum(sizes, dtype=np.int64) + self.begin[-1]])

    def get(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbers, and where each number's end."""
        first = self.begin[which]
        sizes = self.begin[which + 1] - first
        ends = np.cumsum(sizes)
        at = np.repeat(first - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.ids[at], ends


class _Encoder:
    """Ids of texts, word by word: the tokenizer never looks across white space.

    Words of plain characters are cut to the parts that the tokenizer encodes one by one, if it is of that
    kind, and each distinct part is encoded once; other words are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        # A special token between words parts their ids; it is cut out before anything else is done.
        exact = (i for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word))
        self.border = next(exact, None)
        self.special = [t.content for t in added.values()]
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        steps = {
            "normalizer": (settings.get("normalizer") or {}).get("normalizers"),
            "pre_tokenizer": (settings.get("pre_tokenizer") or {}).get("pretokenizers"),
        }
        suffix = settings["model"].get("end_of_word_suffix")
        self.plain = steps == PLAIN and bool(suffix) and not any(t.normalized for t in added.values())
        if self.plain:
            # the model alone, for parts that are cut and in lower case; the last id of a part tells its end
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.number, self.words = _Numbers(), _Runs()
        # a line feed ends a word and has no ids
        self.part, self.parts = _Numbers({"\n": 0}), _Runs()
        self.parts.add(np.zeros(0), np.zeros(1))

    def _one_by_one(self, words: list[str]) -> tuple[list[int], list[int]]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        lists = [e.ids for e in found]
        return [i for x in lists for i in x], [len(x) for x in lists]

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        border = self.tokenizer.id_to_token(self.border)
        texts = [border.join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array([*e.ids, self.border], dtype=np.int64) for e in found])
        cuts = np.flatnonzero(ids == self.border)
        return np.delete(ids, cuts), np.diff(cuts, prepend=-1) - 1

    def _spaced(self, parts: list[str]) -> tuple[np.ndarray | list[int], np.ndarray | list[int]]:
        found = self.bare.encode_batch_fast([" ".join(parts)], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype=np.int64)
        ends = np.flatnonzero(self.last[ids])
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(parts) else self._one_by_one(parts)

    def _by_parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = _PARTS.findall(("\n".join(words) + "\n").lower())
        new = self.part.add(list(dict.fromkeys(parts)))
        if new:
            self.parts.add(*self._spaced(new))
        numbers = self.part.of(parts)
        ids, ends = self.parts.get(numbers)
        return ids, np.diff(ends[numbers == 0], prepend=0)

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        new = self.number.add(words)
        if new:
            border = self.border is not None and not any(t in "\n".join(new) for t in self.special)
            self.words.add(*(self._joined if border else self._one_by_one)(new))
        ids, ends = self.words.get(self.number.of(words))
        return ids, np.diff(ends, prepend=0)

    def encode(self, words: list[str]) -> _Runs:
        """The ids of distinct words."""
        runs, text = _Runs(), "\n".join(words)
        special = any(t in text for t in self.special)
        if self.plain and not special and not _ODD.search(text):
            runs.add(*self._by_parts(words))
            return runs
        odd = np.array([not self.plain or bool(_ODD.search(w)) or any(t in w for t in self.special) for w in words])
        places = np.empty(len(words), dtype=np.int64)
        for kind, ids_of in ((~odd, self._by_parts), (odd, self._whole)):
            chosen = np.flatnonzero(kind)
            if len(chosen):
                places[chosen] = np.arange(len(chosen)) + len(runs.begin) - 1
                runs.add(*ids_of([words[i] for i in chosen.tolist()]))
        ids, ends = runs.get(places)
        both = _Runs()
        both.add(ids, np.diff(ends, prepend=0))
        return both

    def __call__(self, texts: pa.Array | list[str], end_id: int) -> list[np.ndarray]:
        if len(self.number) + len(self.part) > REMEMBERED:
            self.forget()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        offsets = split.offsets.to_numpy()
        found = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
        distinct = found.dictionary
        # no word has a line feed
        kind = pa.LargeListArray if pa.types.is_large_string(distinct.type) else pa.ListArray
        words = pc.binary_join(kind.from_arrays([0, len(distinct)], distinct), "\n")[0].as_py().split("\n")
        runs = self.encode(words) if len(distinct) else _Runs()
        ids, ends = runs.get(found.indices.to_numpy())
        cuts = np.concatenate([[0], ends])[offsets - offsets[0]]
        ids = np.insert(ids, cuts[1:], end_id)
        return np.split(ids, (cuts[1:] + np.arange(1, len(cuts)))[:-1]) if len(cuts) > 1 else []


def pack(doc_ids: list[int | None], documents: list[np.ndarray]) -> bytes:
    """One record."""
    ids = np.concatenate(documents)
    if len(ids) and int(ids.max()) >= LIMIT:
        raise ValueError(f"ids must be below {LIMIT}")
    size = min(BLOCK, max(1, len(ids)))
    n = -(-len(ids) // size)
    blocks = np.zeros(n * size, dtype=np.uint16)
    blocks[: len(ids)] = ids
    blocks = blocks.reshape(n, size)
    codes = encode(blocks) if n else []
    head = struct.pack(HEADER, MAGIC, VERSION, len(documents), len(ids), size, n)
    head += np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
    head += np.array([len(d) for d in documents], dtype="<u8").tobytes()
    head += np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes()
    head += np.array([len(c) for c in codes], dtype="<u4").tobytes()
    head += np.array([zlib.crc32(b.astype("<u4").tobytes()) for b in blocks], dtype="<u4").tobytes()
    return b"".join([head, struct.pack("<I", zlib.crc32(head)), *codes])


class _Record:
    """What the header of a record tells, and its blocks' codes."""

    def __init__(self, record: bytes):
        magic, version, n_docs, self.n_ids, self.size, n = struct.unpack_from(HEADER, record)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a record of token ids")
        at = struct.calcsize(HEADER)

        def read(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(record, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        doc_ids, self.lengths, missing = read("<i8", n_docs), read("<u8", n_docs), read("u1", n_docs)
        sizes, self.sums = read("<u4", n), read("<u4", n)
        if zlib.crc32(record[:at]) != read("<u4", 1)[0]:
            raise ValueError("the header of a record is damaged")
        ends = at + np.cumsum(sizes, dtype=np.int64)
        self.codes = [record[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
        self.doc_ids = [None if m else int(d) for d, m in zip(doc_ids, missing, strict=True)]

    def documents(self, blocks: np.ndarray) -> list[np.ndarray]:
        for i, block in enumerate(blocks):
            if zlib.crc32(block.astype("<u4").tobytes()) != self.sums[i]:
                raise ValueError(f"block {i} of a record is damaged")
        cuts = np.cumsum(self.lengths, dtype=np.int64)
        return np.split(blocks.reshape(-1)[: self.n_ids], cuts[:-1]) if len(cuts) else []


def _side_by_side(records: Iterable[_Record]) -> Iterator[list[_Record]]:
    """Neighbours with blocks of one size."""
    group, held = [], 0
    for record in records:
        if group and (record.size != group[0].size or held + len(record.codes) > SIDE_BY_SIDE):
            yield group
            group, held = [], 0
        group.append(record)
        held += len(record.codes)
    if group:
        yield group


def unpack_all(records: Iterable[bytes]) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """What :func:`pack` was given for each record; raises ValueError if a checksum differs."""
    for group in _side_by_side(map(_Record, records)):
        codes = [c for record in group for c in record.codes]
        blocks = decode(codes, group[0].size) if codes else np.zeros((0, 1), dtype=np.int64)
        cuts = np.cumsum([len(record.codes) for record in group])
        for record, own in zip(group, np.split(blocks, cuts[:-1]), strict=True):
            yield record.doc_ids, record.documents(own)


def unpack(record: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    return next(unpack_all([record]))


def _writer(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, record = TaskContext.get().partitionId(), 0
        encoder = _Encoder(tokenizer)
        doc_ids, documents, held = [], [], 0

        def row() -> pa.RecordBatch:
            columns = [pa.array([part], pa.int32()), pa.array([record], pa.int32())]
            columns.append(pa.array([pack(doc_ids, documents)], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["part", "record", "payload"])

        for batch in batches:
            for first, upto, _, _ in chunks(batch.column(1), TOGETHER):
                rows = batch.slice(first, upto - first)
                for doc_id, ids in zip(rows.column(0), encoder(rows.column(1), end_id), strict=True):
                    if documents and held + len(ids) > RECORD:
                        yield row()
                        doc_ids, documents, held, record = [], [], 0, record + 1
                    doc_ids.append(doc_id.as_py())
                    documents.append(ids)
                    held += len(ids)
        if documents:
            yield row()

    return run


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, numbers, payloads = batch.columns
        found = unpack_all(payload.as_py() for payload in payloads)
        for part, record, (doc_ids, documents) in zip(parts, numbers, found, strict=True):
            lengths = np.array([len(d) for d in documents], dtype=np.int64)
            n = len(documents)
            columns = [
                pa.array([part.as_py()] * n, pa.int32()),
                pa.array([record.as_py()] * n, pa.int32()),
                pa.array(np.cumsum(lengths) - lengths, pa.int64()),
                pa.array(doc_ids, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in documents], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["part", "record", "place", "doc_id", "n_tokens", "ids_crc32"]
            )


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Writes the ids of all rows of ``docs`` (doc_id, text) to files below ``path``.

    ``tokenizer`` is the path of a tokenizers file that executors can read.
    Every document ends in ``end_id``; NULL and empty texts are that id alone.
    Order is by doc_id, NULL first, ties by text; repeated rows are written
    each. Other columns are not read.
    """
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_writer(tokenizer, end_id), RECORDS)
        .write.option("compression", "uncompressed")
        .parquet(path)
    )


def _sum_before(order: WindowSpec) -> Column:
    return F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files; start counts the ids of all before."""
    records = spark.read.schema(RECORDS).parquet(path)
    stored = stage(records.mapInArrow(_reader, STORED), "token_index")
    by_record = stored.groupBy("part", "record").agg(F.sum("n_tokens").alias("n"))
    parts = by_record.groupBy("part").agg(F.sum("n").alias("n"))
    part_start = parts.select("part", _sum_before(Window.partitionBy(F.lit(0)).orderBy("part")).alias("base"))
    starts = by_record.join(part_start, "part").select(
        "part",
        "record",
        (F.col("base") + _sum_before(Window.partitionBy("part").orderBy("record"))).alias("base"),
    )
    return stored.join(stage(starts, "token_starts"), ["part", "record"]).select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
