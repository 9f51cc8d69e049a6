"""From raw documents to shards of a training mix.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns the documents it leaves, all columns. Between two stages the documents
are written and read again, so no stage's plan holds another's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retrocohort.llm.decontaminate import drop_leaking
from retrocohort.llm.mixing import mixed_documents
from retrocohort.llm.near_dedup import drop_near_duplicates
from retrocohort.llm.quality import drop_rejected
from retrocohort.llm.sharding import sharded
from retrocohort.llm.texts import table
from retrocohort.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the latest policy go."""
    return drop_rejected(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, five-word shingles and similarity 0.8 or more, the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard."""
    return sharded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: Near duplicates, fingerprints and hash draws have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table through all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
