"""Binding of logical table names to physical tables, files or DataFrames."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from retrocohort.sources.schemas import SOURCES, require_columns

Binding = str | DataFrame | Callable[[], DataFrame]


class CdmTables:
    """Logical name -> catalog table, Parquet path, DataFrame or DataFrame factory.

    ``get`` returns only the declared columns, so scans read nothing else.
    """

    def __init__(self, spark: SparkSession, names: Mapping[str, Binding]):
        unknown = sorted(set(names) - set(SOURCES))
        if unknown:
            raise ValueError(f"unknown logical tables: {unknown}")
        self.spark = spark
        self._names = dict(names)

    def get(self, name: str) -> DataFrame:
        if name not in self._names:
            raise ValueError(f"no table is bound to {name!r}")
        binding = self._names[name]
        if isinstance(binding, DataFrame):
            df = binding
        elif callable(binding):
            df = binding()
        elif "/" in binding:
            df = self.spark.read.parquet(binding)
        else:
            df = self.spark.table(binding)
        return require_columns(df, SOURCES[name].fieldNames(), name)

    def digest(self) -> str:
        """A digest of the bound tables' file names.

        It changes when a write adds or replaces files, as Spark names each file
        anew; not when a file is changed in place. A table without files, made in
        the application, cannot be told from another and raises.
        """
        found = hashlib.sha256()
        for name in sorted(self._names):
            files = sorted(self.get(name).inputFiles())
            if not files:
                raise ValueError(f"{name!r} is not stored in files")
            found.update("\n".join([name, *files, ""]).encode())
        return found.hexdigest()
