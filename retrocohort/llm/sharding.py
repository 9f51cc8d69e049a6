"""Shards by a hierarchical weighted hash tree.

The tree has regions, racks and shards. At each level a document draws a
weighted hash for every child and goes to the smallest. A change of weights
moves documents only between the subtrees whose weights change: draws for the
others stay as they are. A shard that is added becomes a region of its own, so
it takes documents from all others and no other shard receives any.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retrocohort.llm.texts import unused
from retrocohort.staging import stage

# Copies of a row that one step of the numbering unfolds.
COPIES = 10_000


@dataclass(frozen=True)
class Node:
    """A shard, or a subtree with its children; weights of subtrees are sums."""

    path: str
    own_weight: float = 1.0
    children: tuple[Node, ...] = ()
    shard: int | None = None

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def shard_tree(n_shards: int, first: int = 24, racks: int = 2, per_rack: int = 4) -> Node:
    """Shards 0 to ``n_shards`` - 1, all of weight 1.

    The ``first`` ones fill regions of ``racks`` racks of ``per_rack`` shards;
    each further one is a region by itself.
    """
    regions = []
    for r, start in enumerate(range(0, min(first, n_shards), racks * per_rack)):
        stop = min(start + racks * per_rack, first, n_shards)
        shelves = []
        for k, low in enumerate(range(start, stop, per_rack)):
            name = f"region{r}/rack{k}"
            leaves = tuple(Node(f"{name}/shard{s}", shard=s) for s in range(low, min(low + per_rack, stop)))
            shelves.append(Node(name, children=leaves))
        regions.append(Node(f"region{r}", children=tuple(shelves)))
    regions += [Node(f"own{s}", shard=s) for s in range(first, n_shards)]
    return Node("", children=tuple(regions))


def weighted_draw(key: Column, path: Column, weight: Column) -> Column:
    """An exponential draw of rate ``weight`` that depends on the key and a node's path alone."""
    bits = F.shiftrightunsigned(F.xxhash64(key, path), 11)
    return -F.ln((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def _pick(values: list, at: str) -> Column:
    """The value of each row's node; the list is one literal."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(at) + 1)


def descend(df: DataFrame, key: Column, tree: Node, name: str) -> DataFrame:
    """``df`` with the shard that ``key`` descends to, as the column ``name``.

    One level is two projections: the draws of the children of the node that the
    row is at, then the child with the smallest (the first of equal ones). Paths
    and weights are looked up, so a level draws once a child of its widest node.
    """
    nodes, at = [tree], unused(f"{name}_at", df)
    out = df.withColumn(at, F.lit(0))
    while any(node.children for node in nodes):
        width = max(len(node.children) for node in nodes)
        draws = [unused(f"{name}_{j}", out) for j in range(width)]
        columns = {}
        for j, draw in enumerate(draws):
            child = [node.children[j] if j < len(node.children) else None for node in nodes]
            path = _pick([c and c.path for c in child], at)
            weight = _pick([c and float(c.weight) for c in child], at)
            columns[draw] = F.when(path.isNotNull(), weighted_draw(key, path, weight))
        out = out.withColumns(columns)
        least = F.least(*draws) if width > 1 else F.col(draws[0])
        chosen = F.lit(0)
        for j in reversed(range(1, width)):
            before = F.least(*draws[:j]) if j > 1 else F.col(draws[0])
            chosen = F.when((F.col(draws[j]) <= least) & (F.col(draws[j]) < before), j).otherwise(chosen)
        first = [sum(max(1, len(node.children)) for node in nodes[:i]) for i in range(len(nodes))]
        out = out.withColumn(at, _pick(first, at) + chosen).drop(*draws)
        nodes = [c for node in nodes for c in (node.children or (node,))]
    return out.withColumn(name, _pick([node.shard for node in nodes], at).cast("int")).drop(at)


def assign(docs: DataFrame, n_shards: int = 24, grown: int | None = None, range_rows: int = 10_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs`` (doc_id, text).

    Law ``key``: doc_id and tree decide, so rows that share a doc_id share a
    shard, rows without one too. size is the UTF-8 bytes plus 8, NULL text has
    none and the checksum of the empty text. Slots count from 0 within a shard;
    hash ranges of about ``range_rows`` unlike rows are numbered apart and put
    behind each other; equal rows have neighbouring slots. grown_shard is the shard with ``grown`` shards, one more unless
    given. Other columns are not read.
    """
    tree, larger = shard_tree(n_shards), shard_tree(n_shards + 1 if grown is None else grown)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.col("doc_id")
    sized = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    placed = stage(descend(descend(sized, key, tree, "shard"), key, larger, "grown_shard"), "placed")
    row = ["doc_id", "size", "text_crc32", "shard", "grown_shard"]
    # equal rows are one row with a number until they have their slots
    unlike = stage(placed.groupBy(*row).agg(F.count(F.lit(1)).alias("n")), "unlike")
    ranges = max(1, -(-unlike.count() // (n_shards * range_rows)))
    ranged = unlike.withColumn("range", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(ranges)))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        ranged.groupBy("shard", "range")
        .agg(F.sum("n").alias("rows"))
        .select("shard", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")),
        "slots",
    )
    inside = Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size")
    earlier = F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = ranged.withColumn("nth", earlier).join(starts, ["shard", "range"])
    first = (F.col("start") + F.col("nth")).cast("long").alias("first")
    # a row that occurs once is ready; the copies of others are dealt to all tasks
    single = numbered.where("n = 1").select(*row, first.alias("slot"))
    steps = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))
    step = numbered.where("n > 1").select(*row, first, "n", F.explode(steps).alias("step"))
    upto = F.least(F.col("step") + COPIES, F.col("n")) - 1
    copies = step.repartition(F.col("doc_id"), F.col("text_crc32"), F.col("step")).select(
        *row, F.explode(F.sequence(F.col("first") + F.col("step"), F.col("first") + upto)).alias("slot")
    )
    return single.unionByName(copies).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def sharded(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """``docs`` with the column shard; a column of that name is replaced. No shuffle."""
    kept = docs.select(*[c for c in docs.columns if c.lower() != "shard"])
    return descend(kept, F.col("doc_id").cast("long"), shard_tree(n_shards), "shard")


def write_shards(docs: DataFrame, path: str, n_shards: int = 24) -> None:
    """One folder of Parquet files per shard."""
    sharded(docs, n_shards).write.partitionBy("shard").parquet(path)
