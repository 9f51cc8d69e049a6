"""Saved extracts."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def save_extract(df: DataFrame, target: str, mode: str = "errorifexists") -> DataFrame:
    """Create a table (or a Parquet folder, if ``target`` is a path) and read it back.

    By default an existing target is an error, as with a plain CREATE TABLE AS.
    """
    spark = df.sparkSession
    if "/" in target:
        df.write.mode(mode).parquet(target)
        return spark.read.parquet(target)
    df.write.mode(mode).saveAsTable(target)
    return spark.table(target)


@dataclass(frozen=True)
class Saves:
    """Parquet folders below ``root`` whose names come from what they were made of.

    Another application with the same ``made_from`` finds what an earlier one
    has finished, so a study goes on where a lost driver stopped. Each attempt
    writes a folder of its own and counts once it has the marker that Spark
    leaves when a write is committed; nothing is overwritten or deleted. Of
    several finished attempts the one with the least name is read.
    """

    spark: SparkSession
    root: str
    made_from: Mapping[str, Any]

    def folder(self, kind: str) -> str:
        """Where the attempts at ``kind`` are."""
        key = json.dumps([kind, dict(self.made_from)], sort_keys=True, default=str)
        return f"{self.root.rstrip('/')}/{kind}-{hashlib.sha256(key.encode()).hexdigest()[:32]}"

    def done(self, kind: str) -> DataFrame | None:
        """The table ``kind`` if some application has finished it."""
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder(kind)}/*/_SUCCESS")
        found = marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(marker)
        paths = sorted(status.getPath().getParent().toString() for status in found or ())
        return self.spark.read.parquet(paths[0]) if paths else None

    def __call__(self, df: DataFrame, kind: str) -> DataFrame:
        """The finished table, written first where there is none."""
        found = self.done(kind)
        return found if found is not None else save_extract(df, f"{self.folder(kind)}/{uuid.uuid4().hex}")
