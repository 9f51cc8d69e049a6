"""Delimited files: the covariates file of a cohort and results tables."""

from __future__ import annotations

import csv
import re
import unicodedata
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retrocohort.staging import stage

SEPARATORS = (",", "\t", ";", "|")


def repaired_names(raw_names: Iterable[str]) -> list[str]:
    """Snake-case names; repeats get ``_2``, ``_3``, ...

    Accents are dropped, ``%`` and ``#`` are spelled out.
    """
    used: set[str] = set()
    names = []
    for raw in raw_names:
        plain = unicodedata.normalize("NFKD", raw).encode("ascii", "ignore").decode()
        spelled = plain.replace("%", " percent ").replace("#", " number ")
        spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", spelled)
        base = re.sub(r"[^0-9a-z]+", "_", spaced.lower()).strip("_") or "x"
        if base[0].isdigit():
            base = f"x{base}"
        name, repeat = base, 1
        while name in used:
            repeat += 1
            name = f"{base}_{repeat}"
        used.add(name)
        names.append(name)
    return names


def clean_names(df: DataFrame) -> DataFrame:
    """Columns under their :func:`repaired_names`."""
    return df.toDF(*repaired_names(df.columns))


def find_separator(header: str, candidates: Sequence[str] = SEPARATORS) -> str:
    """The candidate that cuts a header line into most fields; the first of several, and if none cuts it.

    A separator inside quotes does not count.
    """
    bare = re.sub(r'"(?:[^"]|"")*"', "", header)
    return max(candidates, key=bare.count)


def _raw(spark: SparkSession, path: str, sep: str | None, na: Sequence[str]) -> DataFrame:
    """All columns as text under repaired names. The header line is read once, and with it the separator found out."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} has no header")
    header = first[0].removeprefix("\ufeff")
    sep = find_separator(header) if sep is None else sep
    names = repaired_names(next(csv.reader([header], delimiter=sep)))
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    raw = spark.read.schema(schema).csv(path, header=True, sep=sep)
    return raw.select(*[F.when(~F.col(c).isin(*na), F.col(c)).alias(c) for c in names]) if na else raw


def _require(raw: DataFrame, path: str, schema: T.StructType) -> None:
    missing = [name for name in schema.fieldNames() if name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str | None = ",",
    na: Sequence[str] = ("", "NA"),
) -> DataFrame:
    """Delimited file with a header and repaired names; fields equal to one of ``na`` are NULL.

    Without ``sep`` the header tells the separator. With a schema the columns
    are matched to the repaired header by name and cast; text that does not fit
    the type becomes NULL. :func:`read_checked` reports such text.
    """
    raw = _raw(spark, path, sep, na)
    if schema is None:
        return raw
    _require(raw, path, schema)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class CheckedFile:
    """Typed rows of a file, and a ledger of the fields whose text did not fit: column, type, text, record."""

    rows: DataFrame
    rejected: DataFrame
    n_rejected: int


def read_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str | None = ",",
    na: Sequence[str] = ("", "NA"),
    max_rejected: int | None = None,
) -> CheckedFile:
    """As :func:`read_delimited`, with rejected fields counted and kept.

    One pass over the file writes the typed rows together with what was
    rejected in them; the field is NULL in its row. record is the row's text as
    JSON. ``ValueError`` if more than ``max_rejected`` fields were rejected.
    """
    raw = _raw(spark, path, sep, na)
    _require(raw, path, schema)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    reports = [
        F.when(
            F.col(f.name).isNotNull() & typed[f.name].isNull(),
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("text")),
        )
        for f in schema.fields
    ]
    found = F.array_compact(F.array(*reports))
    record = F.when(F.size(found) > 0, F.to_json(F.struct(*raw.columns)))
    size = Observation()
    read = raw.select(*[c.alias(n) for n, c in typed.items()], found.alias("_rejected"), record.alias("_record"))
    written = stage(read.observe(size, F.sum(F.size("_rejected")).alias("n")), "checked_file")
    n_rejected = size.get["n"] or 0
    rejected = written.where(F.size("_rejected") > 0).select(F.inline("_rejected"), F.col("_record").alias("record"))
    if max_rejected is not None and n_rejected > max_rejected:
        examples = [f"{r['column']}={r['text']!r}" for r in rejected.limit(3).collect()]
        raise ValueError(f"{path} has {n_rejected} fields that do not fit their type, such as {', '.join(examples)}")
    return CheckedFile(written.drop("_rejected", "_record"), rejected, n_rejected)


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """column, type, n, least and greatest text of a ledger of rejected fields."""
    return rejected.groupBy("column", "type").agg(
        F.count(F.lit(1)).alias("n"), F.min("text").alias("least_text"), F.max("text").alias("greatest_text")
    )


def cohort_source(config: DataFrame, drug: str) -> tuple[str, str, str]:
    """Path, drug name and experiment id of the configuration row for ``drug``.

    ``ValueError`` if there is none, or more than one that differ.
    """
    found = (
        config.where(F.col("drug_name") == F.lit(drug))
        .select("covariates_file", "drug_name", F.col("expt_id").cast("string"))
        .distinct()
        .take(2)
    )
    if len(found) != 1:
        raise ValueError(f"{'several configuration rows' if found else 'no configuration row'} for the drug {drug!r}")
    row = found[0]
    path = row["covariates_file"].format(
        drug_name=row["drug_name"], exptid=row["expt_id"], cohort_type="cohort1"
    )
    return path, row["drug_name"], row["expt_id"]


def read_cohort_covariates(
    spark: SparkSession, config: DataFrame, drug: str, schema: T.StructType, sep: str | None = ","
) -> DataFrame:
    """Covariates file named by the configuration row of ``drug``.

    The path may hold ``{drug_name}``, ``{exptid}`` and ``{cohort_type}``.
    """
    path, _, _ = cohort_source(config, drug)
    return read_delimited(spark, path, schema, sep)


def load_results(
    spark: SparkSession, source: str | DataFrame, schema: T.StructType | None = None, sep: str | None = None
) -> DataFrame:
    """A results table: a DataFrame as it is, or a delimited file, whose header tells the separator unless given."""
    return source if isinstance(source, DataFrame) else read_delimited(spark, source, schema, sep)
