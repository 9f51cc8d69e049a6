"""Intermediate tables written to the shared checkpoint folder.

A study reuses a few narrow tables (first/last exposure, outpatient days,
observation periods) in many later steps. Writing each once cuts the plan,
survives the loss of executors, and gives the optimiser real file sizes. The
size that decides about a broadcast is measured by the same write, and so are
the least and greatest date and number of each column, with which the large
tables are filtered where they are read.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Largest hash table, as measured below, that is sent to every executor. At most
# eight lookups of a study are in use at once, so all of them stay within 512 MiB.
BROADCAST_BYTES = 64 * 1024 * 1024

# Values of a column that become a list in a filter at most; scans skip by longer lists no better than by their ends.
LISTED_VALUES = 10

_local_roots: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """Folder for staged tables: the session's checkpoint folder.

    Only a local session without that setting gets a folder of its own, which
    is removed when the process ends.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        if context.applicationId not in _local_roots:
            own = tempfile.mkdtemp(prefix="retrocohort-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _local_roots[context.applicationId] = own
        root = _local_roots[context.applicationId]
    return f"{root.rstrip('/')}/retrocohort-{context.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], Any]]) -> list[Any]:
    """Results of steps whose jobs run at the same time; the first error ends them."""
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]


def clear_stages(spark: SparkSession) -> None:
    """Delete every table this application has staged; frames over them can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_side(df: DataFrame, small: bool) -> DataFrame:
    """``df`` as a join side: broadcast if ``small``, never if not.

    Spark broadcasts what it takes for short by the size of its compressed
    files, whose rows, or those unfolded from them, can be too many for the
    driver's memory. The hint keeps it from that, now and after a stage has run.
    """
    return F.broadcast(df) if small else df.hint("merge")


_MEASURED = (T.DateType, T.IntegralType)


def _size_columns(df: DataFrame) -> list[Column]:
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if nested:
        raise ValueError(f"the size of nested columns is not measured: {nested}")
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text_bytes = F.lit(0).cast("long")
    for name in text:
        text_bytes = text_bytes + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    ends = [
        end(F.col(f.name)).alias(f"{which}_{f.name}")
        for f in df.schema.fields
        if isinstance(f.dataType, _MEASURED)
        for which, end in (("least", F.min), ("most", F.max))
    ]
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(text_bytes).alias("n_text"), *ends]


def _hash_table_bytes(df: DataFrame, n_rows: int, n_text: int | None) -> int:
    """Bytes the rows need in a hash table at most.

    Per row: a key and a value of all columns (8 bytes each and an 8-byte null
    map), 56 bytes for the record header and the half-empty index; text twice.
    """
    return n_rows * (2 * (8 + 8 * len(df.columns)) + 56) + 2 * (n_text or 0)


@dataclass(frozen=True)
class Lookup:
    """A table, whether its measured size allows a broadcast, its columns' ends and its number of rows.

    ``ends`` holds the least and greatest value of the columns that were
    measured, None for both where a column has no value. ``n_rows`` is None
    where rows were not counted.
    """

    table: DataFrame
    small: bool
    ends: dict[str, tuple[Any, Any]] = field(default_factory=dict)
    n_rows: int | None = None
    _listed: dict[str, list] = field(default_factory=dict, repr=False, compare=False)

    def values(self, column: str) -> list | None:
        """The distinct values of a column that is a date or a whole number, if its rows are few enough to list."""
        if self.n_rows is None or self.n_rows > LISTED_VALUES or not self.small or column not in self.ends:
            return None
        if column not in self._listed:
            rows = self.table.select(column).collect()
            self._listed[column] = sorted({row[0] for row in rows if row[0] is not None})
        return self._listed[column]

    @property
    def side(self) -> DataFrame:
        """The table as a join side: broadcast within the bound, shuffled beyond it."""
        return join_side(self.table, self.small)

    def within(self, df: DataFrame, column: str, first: str, last: str | None = None) -> DataFrame:
        """Rows of ``df`` whose ``column`` lies between the ends of two columns (or of one).

        A filter with literals, which reaches the scan. It loses no row that
        could meet the table there; columns that were not measured filter nothing.
        """
        last = last or first
        if first not in self.ends or last not in self.ends:
            return df
        least, most = self.ends[first][0], self.ends[last][1]
        if least is None or most is None:
            return df.where(F.lit(False))
        return df.where(F.col(column).between(F.lit(least), F.lit(most)))


def _measured(table: DataFrame, found: dict[str, Any], broadcast_bytes: int) -> Lookup:
    small = _hash_table_bytes(table, found["n_rows"], found["n_text"]) <= broadcast_bytes
    names = [key.removeprefix("least_") for key in found if key.startswith("least_")]
    return Lookup(table, small, {n: (found[f"least_{n}"], found[f"most_{n}"]) for n in names}, found["n_rows"])


def lookup(df: DataFrame, label: str, broadcast_bytes: int = BROADCAST_BYTES) -> Lookup:
    """Stage ``df``, measuring it while it is written.

    Beyond the bound the table stays a shuffled join side read straight from
    storage, so both inputs of the join are bare shuffles and adaptive
    execution can split a hot key.
    """
    size = Observation()
    table = stage(df.observe(size, *_size_columns(df)), label)
    return _measured(table, size.get, broadcast_bytes)


def stored(df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Lookup:
    """A lookup over a table that is stored already; it is only measured."""
    return _measured(df, df.agg(*_size_columns(df)).first().asDict(), broadcast_bytes)


# Bits that a key sets in its word, keys for each word, and bytes that a word needs in a hash table.
_BITS = 3
_KEYS_PER_WORD = 4
_WORD_BYTES = 2 * (8 + 8 * 2) + 56


@dataclass(frozen=True)
class Bloom:
    """A blocked Bloom filter of a table's keys: for each word of 64 bits those that some key sets.

    Its size is bounded whatever the number of keys, so it can be sent to every
    executor where the keys themselves cannot.
    """

    words: DataFrame
    n_words: int

    @staticmethod
    def _places(key: Column, n_words: int) -> tuple[Column, Column]:
        spread = F.xxhash64(key)
        one, mask = F.lit(1).cast("long"), F.lit(0).cast("long")
        for i in range(_BITS):
            place = F.pmod(F.shiftrightunsigned(spread, 40 + 6 * i), F.lit(64)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", one, place))
        return F.pmod(spread, F.lit(n_words)), mask

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """Rows of ``df`` whose ``column`` may be one of the keys: all that are, and few others; none without a key."""
        word, mask = self._places(F.col(column), self.n_words)
        marked = df.where(F.col(column).isNotNull()).withColumn("_word", word)
        found = marked.join(F.broadcast(self.words), "_word")
        return found.where(F.col("_bits").bitwiseAND(mask) == mask).drop("_word", "_bits")


def bloom(keys: Lookup, column: str, broadcast_bytes: int = BROADCAST_BYTES) -> Bloom | None:
    """The filter of a staged table's column; None if too few bits for its rows stay within ``broadcast_bytes``."""
    most = broadcast_bytes // _WORD_BYTES
    n_words = min(most, max(1, (keys.n_rows or 0) // _KEYS_PER_WORD))
    if keys.n_rows is None or 16 * n_words < keys.n_rows:
        return None
    word, mask = Bloom._places(F.col(column), n_words)
    words = keys.table.where(F.col(column).isNotNull()).groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits"))
    return Bloom(stage(words, f"bloom_{column}"), n_words)
