"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from retrocohort.staging import stage_path


def _written(links: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """The links, written, and a fingerprint of the set that does not depend on order."""
    seen = Observation()
    marked = links.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x"),
    )
    path = stage_path(links.sparkSession, label)
    marked.write.parquet(path)
    table = links.sparkSession.read.schema("u long, v long").parquet(path)
    return table, (seen.get["n"], seen.get["x"])


def _stars(both: DataFrame, larger_only: bool) -> DataFrame:
    """Links each node's neighbours to the smallest node around it.

    The smallest is found by an aggregate that combines before its shuffle and
    is joined back, so a node with very many links is never held in one task.
    """
    smallest, _ = _written(
        both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("v")), "star_min"
    )
    around = both.join(smallest.withColumnRenamed("v", "m"), "u")
    if larger_only:
        linked = around.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = around.select(F.col("v").alias("u"), F.col("m").alias("v"), F.col("u").alias("own")).select(
            F.explode(F.array(F.struct("u", "v"), F.struct(F.col("own").alias("u"), "v"))).alias("e")
        ).select("e.*")
    return linked.where("u <> v").distinct()


def stars(links: DataFrame) -> DataFrame:
    """(node, component), one row for every node that is not the smallest of its component.

    ``links`` has long columns u and v; order, repeats and loops do not matter,
    rows with a NULL end are left out. Every step is written to the checkpoint
    folder. Ends when the two steps leave the links as they are.
    """
    links = links.select("u", "v").where("u <> v")
    now, mark = _written(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = _written(_stars(both, larger_only=True), "large_star")
        now, after = _written(_stars(large, larger_only=False), "small_star")
        if after == mark:
            break
        mark = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node. Links as in :func:`stars`."""
    every = stars(links)
    roots = every.select(F.col("component").alias("node"), "component").distinct()
    return every.unionByName(roots)
