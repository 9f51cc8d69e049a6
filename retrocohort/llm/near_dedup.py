"""Near duplicates: MinHash signatures, banding, verification, components.

1. Every document's whole word-shingle set gives minima of many universal hash
   functions. Documents with equal sets form a class; only its smallest
   doc_id goes on, so exact copies cost one row each.
2. Bands of the signature are buckets. Each bucket is described by its smallest
   document, its centre; a document joins the group of every centre it shares a
   bucket with. Groups are dealt out in blocks of bounded text.
3. Inside a block, signatures pick the pairs that can reach the threshold and
   the full sets decide. A block returns a spanning forest of its links, never
   the pairs themselves, so output grows with documents, not with their squares.
   Every block of a group that takes several also holds the centre. Members that
   are linked with it need no further comparison with each other, so a large
   group of copies costs one look at each; only the members without such a link
   are compared with the group's other blocks.
4. Alternating large-star and small-star steps join the links to components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.llm.components import stars
from retrocohort.llm.texts import unused, Words, chunks, mixed, shingle_sets
from retrocohort.staging import bloom, lookup, stage

SIGNED = "doc_id long, n_shingles long, n_bytes long, key_1 long, key_2 long, bands array<long>, signature binary"


@dataclass(frozen=True)
class NearDuplicates:
    """What counts as a near duplicate, and how it is searched.

    A pair is linked if ``percent`` * union <= 100 * intersection. The number of
    bands is the smallest with which a pair at the threshold is missed with
    probability ``miss`` at most. A pair is looked at closely if its signature
    agreement is within ``margins`` standard deviations of the threshold. A
    block holds ``block_bytes`` of text, each member counted with
    ``member_bytes`` more, which also bounds the members.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 1e-6
    margins: float = 5.0
    block_bytes: int = 4 << 20
    member_bytes: int = 2048
    seed: int = 20

    @property
    def bands(self) -> int:
        return int(np.ceil(np.log(self.miss) / np.log1p(-((self.percent / 100) ** self.rows))))

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def agreement(self) -> int:
        """Equal minima that a pair needs to be looked at closely."""
        t = self.percent / 100
        return max(0, int(np.floor(self.hashes * t - self.margins * np.sqrt(self.hashes * t * (1 - t)))))


def _signer(rule: NearDuplicates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        draw = np.random.default_rng(rule.seed)
        factor = draw.integers(0, 1 << 64, rule.hashes, dtype=np.uint64) | np.uint64(1)
        shift = draw.integers(0, 1 << 64, rule.hashes, dtype=np.uint64)
        fold = draw.integers(0, 1 << 64, rule.rows, dtype=np.uint64) | np.uint64(1)
        band_no = mixed(np.arange(1, rule.bands + 1, dtype=np.uint64))
        work = np.empty((512, rule.hashes), dtype=np.uint64)

        def minima(found: np.ndarray) -> np.ndarray:
            # Multiply-shift on 32-bit values: the high half is universal, and is taken after the minimum.
            low = np.full(rule.hashes, np.iinfo(np.uint64).max, dtype=np.uint64)
            values = (found >> np.uint64(32))[:, None]
            for a in range(0, len(values), len(work)):
                part = values[a : a + len(work)]
                out = work[: len(part)]
                np.multiply(part, factor, out=out)
                np.add(out, shift, out=out)
                np.minimum(low, out.min(axis=0), out=low)
            return low >> np.uint64(32)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, upto, data, offsets in chunks(texts):
                n, key_1, key_2, bands, signatures = [], [], [], [], []
                for found in shingle_sets(*words.hashes(data, offsets), rule.shingle):
                    n.append(len(found))
                    if not len(found):
                        key_1.append(None)
                        key_2.append(None)
                        bands.append(None)
                        signatures.append(None)
                        continue
                    low = minima(found)
                    key_1.append(int(np.bitwise_xor.reduce(mixed(found)).view(np.int64)))
                    key_2.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                    folded = (low.reshape(rule.bands, rule.rows) * fold).sum(axis=1, dtype=np.uint64)
                    bands.append(mixed(folded ^ band_no).view(np.int64))
                    signatures.append(low.astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, upto - first),
                        pa.array(n, pa.int64()),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(key_1, pa.int64()),
                        pa.array(key_2, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(signatures, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "n_bytes", "key_1", "key_2", "bands", "signature"],
                )

    return run


def signatures(docs: DataFrame, rule: NearDuplicates) -> DataFrame:
    """Set size, a 128-bit key of the set, band keys and minima of every document."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_signer(rule), SIGNED)


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; exact.

    Values in few sets are counted pair by pair, frequent ones by products of
    0/1 matrices of bounded width.
    """
    m = len(sets)
    out = np.zeros((m, m), dtype=np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    begin = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    count = np.diff(np.r_[begin, len(values)])
    few = max(2, min(8, m // 2))
    for c in range(2, few + 1):
        at = begin[count == c]
        for i in range(c):
            for j in range(i + 1, c):
                out += np.bincount(owner[at + i] * m + owner[at + j], minlength=m * m).reshape(m, m)
    often = np.flatnonzero(count > few)
    width = max(64, (4 << 20) // m)
    for a in range(0, len(often), width):
        part = often[a : a + width]
        sizes = count[part]
        where = np.repeat(begin[part], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = np.zeros((m, len(part)), dtype=np.float32)
        hit[owner[where], np.repeat(np.arange(len(part)), sizes)] = 1
        product = np.rint(hit @ hit.T).astype(np.int64)
        out += np.triu(product, 1)
    return out + out.T


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with a link and the first node of its component."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(label)).min(axis=1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(label)))
    return other, label[other]


def links_within(sets: list[np.ndarray], minima: np.ndarray, rule: NearDuplicates, asked: np.ndarray | None = None):
    """A spanning forest (v, u) of the links among some documents, u the first of each tree.

    With ``asked``, only of the links that one of those has.
    """
    m = len(sets)
    rows = np.arange(m) if asked is None else np.flatnonzero(asked)
    close = np.zeros((m, m), dtype=bool)
    step = max(1, (8 << 20) // (m * rule.hashes))
    for a in range(0, len(rows), step):
        part = rows[a : a + step]
        close[part] = (minima[part, None, :] == minima[None, :, :]).sum(axis=2) >= rule.agreement
    if asked is not None:
        close |= close.T
    np.fill_diagonal(close, False)
    some = np.flatnonzero(close.any(axis=1))
    if not len(some):
        return some, some
    close = close[np.ix_(some, some)]
    size = np.array([len(sets[i]) for i in some], dtype=np.int64)
    if len(some) <= 4:
        shared = np.zeros(close.shape, dtype=np.int64)
        for i, j in zip(*np.nonzero(np.triu(close)), strict=True):
            both = np.concatenate([sets[some[i]], sets[some[j]]])
            both.sort()
            shared[i, j] = shared[j, i] = np.count_nonzero(both[1:] == both[:-1])
    else:
        shared = _intersections([sets[i] for i in some])
    union = size[:, None] + size[None, :] - shared
    v, u = _forest(close & (100 * shared >= rule.percent * union))
    return some[v], some[u]


def _verifier(rule: NearDuplicates, rest: bool):
    """Compares blocks; gives links (u, v).

    In the first round, the marked rows that have no link with their centre
    follow as (u, NULL). In the ``rest``, only marked rows are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        key, ids, sets, minima, marks = None, [], [], [], []

        def close_block() -> Iterator[pa.RecordBatch]:
            if len(ids) < 2:
                return
            names, marked = np.array(ids), np.array(marks)
            v, u = links_within(sets, np.stack(minima), rule, marked if rest else None)
            left, right = names[v], pa.array(names[u])
            if not rest:
                root = np.arange(len(ids))
                root[v] = u
                alone = names[marked & ~np.isin(root, root[names == key[0]])]
                left = np.concatenate([left, alone])
                right = pa.concat_arrays([right, pa.nulls(len(alone), pa.int64())])
            if len(left):
                center = pa.array(np.full(len(left), key[0]))
                yield pa.RecordBatch.from_arrays([center, pa.array(left), right], names=["center", "u", "v"])

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            members, found, marked = (batch.column(n).to_pylist() for n in ("member", "signature", "marked"))
            for first, _, data, offsets in chunks(batch.column("text")):
                for row, values in enumerate(shingle_sets(*words.hashes(data, offsets), rule.shingle), first):
                    if keys[row] != key:
                        yield from close_block()
                        key, ids, sets, minima, marks = keys[row], [], [], [], []
                    ids.append(members[row])
                    sets.append(values)
                    minima.append(np.frombuffer(found[row], dtype=np.uint16))
                    marks.append(marked[row])
        yield from close_block()

    return run


def groups(signed: DataFrame) -> DataFrame:
    """(center, member): each document with the smallest of every bucket it shares, itself included."""
    rows = signed.select("doc_id", F.explode("bands").alias("bucket"))
    buckets = stage(
        rows.groupBy("bucket")
        .agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last"))
        .where("center <> last")
        .drop("last"),
        "buckets",
    )
    return rows.join(buckets, "bucket").select("center", F.col("doc_id").alias("member")).distinct()


def _member_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(member, text) of all documents in groups, written once.

    A Bloom filter of the members drops other texts where they are read, so only
    those of members, and few others, are shuffled; without one, all are.
    """
    members = lookup(pairs.select("member").distinct(), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("member"), F.col("text").cast("string"))
    known = bloom(members, "member")
    if known is not None:
        texts = known.keep(texts, "member")
    return stage(texts.join(members.table, "member", "left_semi"), "member_texts")


def _compared(placed: DataFrame, texts: DataFrame, rule: NearDuplicates, rest: bool) -> DataFrame:
    """(center, u, v) from the blocks (center, i, j) of ``placed``."""
    return (
        placed.join(texts, "member")
        .select("center", "i", "j", "member", "text", "signature", "marked")
        .repartition("center", "i", "j")
        .sortWithinPartitions("center", "i", "j")
        .mapInArrow(_verifier(rule, rest), "center long, u long, v long")
    )


def near_links(docs: DataFrame, signed: DataFrame, rule: NearDuplicates) -> DataFrame:
    """(u, v): links whose components are those of all near-duplicate pairs of ``signed``.

    Each member is in one block with its centre. A pair in different blocks of
    a group is joined by the centre if both are linked with it; if one is not,
    that one meets every block of its group in the second round.
    """
    pairs = stage(
        groups(signed).join(signed.select(F.col("doc_id").alias("member"), "n_bytes", "signature"), "member"), "groups"
    )

    def blocks(name: str):
        weight = F.sum("n_bytes") + rule.member_bytes * F.count(F.lit(1))
        return F.ceil(weight / F.lit(rule.block_bytes)).cast("int").alias(name)

    texts = _member_texts(docs, pairs)
    sizes = stage(pairs.groupBy("center").agg(blocks("parts")).where("parts > 1"), "group_sizes")
    part = F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")
    every_part = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = pairs.join(sizes, "center", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    first = dealt.select(
        "center",
        F.explode(F.when(F.col("member") == F.col("center"), every_part).otherwise(F.array(part))).alias("i"),
        F.lit(0).alias("j"),
        "member",
        "signature",
        (F.col("parts") > 1).alias("marked"),
    )
    found = stage(_compared(first, texts, rule, rest=False), "compared")
    links = found.where("v is not null").select("u", "v")
    alone = found.where("v is null").select("center", F.col("u").alias("member")).distinct()
    asking = stage(pairs.join(alone, ["center", "member"]).join(sizes, "center"), "unlinked")
    if asking.isEmpty():
        return links
    slots = stage(asking.groupBy("center").agg(blocks("slots")), "unlinked_sizes")
    slot = F.pmod(F.xxhash64("member", F.lit(1)), F.col("slots")).cast("int")
    columns = ["center", "i", "j", "member", "signature", "marked"]
    asked = asking.join(slots, "center").select(
        "*", F.explode(every_part).alias("i"), slot.alias("j"), F.lit(True).alias("marked")
    )
    answering = (
        pairs.join(sizes, "center")
        .join(slots, "center")
        .select(
            "*",
            part.alias("i"),
            F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("j"),
            F.lit(False).alias("marked"),
        )
    )
    rest = _compared(asked.select(columns).unionByName(answering.select(columns)), texts, rule, rest=True)
    return links.unionByName(rest.select("u", "v"))


def near_duplicates(docs: DataFrame, rule: NearDuplicates = NearDuplicates()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Words are taken after lower-casing A-Z. component_id is the smallest doc_id
    reachable over links, the own included; kept says that it is the own.
    NULL or empty texts have no shingles and no links. Rows without doc_id are
    in no component (NULL) and are kept. Rows that share a doc_id count as one
    document: their links are joined. Other columns are not read.
    """
    signed = stage(signatures(docs, rule), "signatures")
    keyed = signed.where("key_1 is not null and doc_id is not null")
    classes = stage(
        keyed.groupBy("key_1", "key_2")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first <> last")
        .drop("last"),
        "classes",
    )
    copies = stage(
        keyed.select("doc_id", "key_1", "key_2")
        .join(classes, ["key_1", "key_2"])
        .where("doc_id <> first")
        .select(F.col("doc_id").alias("u"), F.col("first").alias("v"), "key_1", "key_2")
        .distinct(),
        "copies",
    )
    copied = copies.select(F.col("u").alias("doc_id"), "key_1", "key_2")
    single = keyed.join(copied, ["doc_id", "key_1", "key_2"], "left_anti").select(*signed.columns)
    near = stage(near_links(docs, stage(single, "single"), rule), "near")
    joined = stars(near.unionByName(copies.select("u", "v")))
    out = signed.select("doc_id", "n_shingles").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, rule: NearDuplicates = NearDuplicates()) -> DataFrame:
    """The rows of ``docs`` of which each component keeps one: its smallest doc_id; all columns.

    A document is a doc_id and a text: unlike texts that share a doc_id, or have
    none, are documents of their own, in order of doc_id (NULL last) and of the
    text's hash. Of repeated rows one stays, that with the smallest other columns.
    """
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        found = near_duplicates(docs, rule)
        return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    key, hashes = unused("document", docs), [unused(f"version_{i}", docs) for i in (1, 2)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    versions = {hashes[0]: F.xxhash64(text), hashes[1]: F.xxhash64(F.lit(1), text)}
    marked = docs.withColumns(versions)
    order = [F.col("doc_id").asc_nulls_last(), *hashes]
    every = marked.select("doc_id", *hashes).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    # in the order of the rows, and written, so that a number never changes
    numbers = stage(every.withColumn(key, F.monotonically_increasing_id()).withColumnRenamed("doc_id", f"{key}_id"), "documents")
    same = F.col("doc_id").eqNullSafe(F.col(f"{key}_id"))
    keyed = stage(marked.join(numbers, [*hashes], "inner").where(same).select(key, *docs.columns), "keyed")
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), rule)
    kept = stage(found.where("kept").groupBy("doc_id").count(), "kept").withColumnRenamed("doc_id", key)
    single = keyed.join(kept.where("count = 1"), key, "left_semi").select(*docs.columns)
    once = (
        keyed.join(kept.where("count > 1"), key, "left_semi")
        .select(key, F.struct("text", *[c for c in docs.columns if c != "text"]).alias("row"))
        .groupBy(key)
        .agg(F.min("row").alias("row"))
        .select("row.*")
        .select(*docs.columns)
    )
    return single.unionByName(once)
