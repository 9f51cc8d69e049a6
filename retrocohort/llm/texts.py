"""Words and word shingles of whole texts.

A word is a run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return. :func:`word_count` states that for Spark; the
rest computes on Arrow buffers, many documents at a time, inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that one round of array operations covers; one longer document is covered whole.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C55
_STEP = 0xD1342543DE82EF95


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; empty for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of ``frames`` has."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all bits; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    code = np.arange(256, dtype=np.uint64)
    if lower:
        code[65:91] += np.uint64(32)
    return mixed((code + np.uint64(1)) * np.uint64(_BASE))


# A second modulus: sums modulo a power of two alone are equal for certain patterns of two letters, whatever the base.
_PRIME = (1 << 31) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _residues(base: int, n: int) -> np.ndarray:
    """Powers modulo the prime."""
    out = np.ones(n, dtype=np.uint32)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more].astype(np.uint64) * np.uint64(pow(base, done, _PRIME)) % np.uint64(_PRIME)
        done += more
    return out


class _Runs:
    """Hashes of runs of values: polynomials modulo 2**64 and a prime by prefix sums; the length takes part."""

    def __init__(self, n: int):
        self.grow(n)

    def grow(self, n: int) -> None:
        self.size = n
        self._up, self._down = _powers(_STEP, n), _powers(pow(_STEP, -1, 1 << 64), n)
        self._up_residue, self._down_residue = _residues(_STEP, n), _residues(pow(_STEP, -1, _PRIME), n)

    def hashes(self, values: np.ndarray, residues: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the values from each ``begin`` up to before ``end``; ``residues`` are the values modulo the prime."""
        n, prime = len(values), np.uint64(_PRIME)
        if n >= self.size:
            self.grow(2 * n)
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self._up[:n], out=prefix[1:])
        first = (prefix[end] - prefix[begin]) * self._down[begin] + (end - begin).astype(np.uint64)
        terms = residues * self._up_residue[:n]
        # less than 2**32 each, so the sum of a text's bytes fits
        terms = (terms & prime) + (terms >> np.uint64(31))
        np.cumsum(terms, out=prefix[1:])
        second = (prefix[end] - prefix[begin]) % prime * self._down_residue[begin] % prime
        return mixed(first + mixed(second + np.uint64(1)))


def polynomial(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values from each ``begin`` up to before ``end``; the number takes part."""
    return _Runs(len(values) + 1).hashes(values, values % np.uint64(_PRIME), begin, end)


class Words:
    """Turns Arrow text into 64-bit word hashes, a chunk of documents at a time."""

    def __init__(self, lower: bool):
        self._value = _byte_values(lower)
        self._residue = self._value % np.uint64(_PRIME)
        self._space = np.zeros(256, dtype=bool)
        self._space[[9, 10, 11, 12, 13, 32]] = True
        self._runs = _Runs(CHUNK_BYTES + 1)

    def hashes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and where each document's begin (one more than documents)."""
        n = len(data)
        inside = ~self._space[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        first = inside.copy()
        first[1:] &= edge[1:n] | ~inside[:-1]
        last = inside.copy()
        last[:-1] &= edge[1:n] | ~inside[1:]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        found = self._runs.hashes(self._value[data], self._residue[data], begin, end)
        return found, np.searchsorted(begin, offsets)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of a text column; NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, upto, data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row]
        row = upto


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on, documents not regarded."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(_STEP)
        out += hashes[j : j + n]
    return mixed(out)


def sequence_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash for a whole short sequence of words; its length takes part."""
    value = len(hashes) + 1
    for h in hashes.tolist():
        value = (value * _BASE + h) & ((1 << 64) - 1)
    return mixed(np.array([value], dtype=np.uint64))


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each document's distinct ``k``-word shingles, ascending.

    A shorter document has its whole sequence as one; without words, none.
    """
    every = rolled(hashes, k)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        elif b > a:
            yield sequence_hash(hashes[a:b])
        else:
            yield every[:0]
