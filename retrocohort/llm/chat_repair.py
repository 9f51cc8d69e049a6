"""Repair of the turn structure of conversations by the cheapest edits.

A repaired conversation is empty, or pairs of user and assistant turns behind at
most one system turn. Rows are kept (K, 0), get another role (R, 1), are deleted
(D, 2), or a turn without text is inserted (I, 5). Blank and repeated rows must
go; a truncated row that stays costs 5 more. Iterative-deepening A* finds the
edits: depth-first in ASCII order of the edits under a bound that grows by one,
with a table of the states that failed and the budget they failed with. The
first path that ends is the cheapest, and of these the least in ASCII order.

Conversations are searched in segments of a bounded number of rows. One that has
several is searched between all states in which a segment can begin and end,
and the segments' results are chained; rows of a long conversation thus never
meet in one task but for the last pass, which streams them in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retrocohort.staging import stage

#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States by the last role: nothing yet, system, user, assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
_NEXT = {_START: ("user", _USER), _SYSTEM: ("user", _USER), _USER: ("assistant", _ASSISTANT), _ASSISTANT: ("user", _USER)}
_ENDS = (_START, _ASSISTANT)

# Faults by their letters in the codes of rows.
FAULTS = {"b": "blank", "d": "duplicate", "t": "truncated", "-": None}

_WORD = r"[^\x20\x09-\x0D]"
LEDGER = (
    "conv_id long, place long, edit string, cost int, fault string, turn long, old_role string, role string,"
    " text string, illegal boolean"
)
# Rows of one Arrow batch of the ledger.
_BATCH = 2048


def _keeps(initial: str, state: int) -> int | None:
    """The state after a kept row, None if its role cannot follow."""
    if initial == "s":
        return _SYSTEM if state == _START else None
    return _NEXT[state][1] if initial and initial == _NEXT[state][0][0] else None


@lru_cache(maxsize=1 << 16)
def _searched(codes: str, state: int, goal: int | None) -> tuple[int, str] | None:
    return search([codes[i : i + 2] for i in range(0, len(codes), 2)], state, goal)


def search(codes: list[str], state: int, goal: int | None) -> tuple[int, str] | None:
    """Cost and edits of the best way through rows, None if there is none.

    A code is a role's initial (or a space) and the letter of the row's fault.
    The way begins in ``state``. With a ``goal`` it ends in that state with its
    last row; without, it ends where a conversation may, turns inserted behind
    the last row included.
    """
    n = len(codes)
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (0 if codes[i][1] == "-" else DELETE)
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def ways(i: int, now: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order: letter, cost, next row, next state."""
        if i < n:
            yield "D", DELETE, i + 1, now
        if i < n or goal is None:
            yield "I", INSERT, i, _NEXT[now][1]
        if i < n and codes[i][1] in "-t":
            stays = TRUNCATED if codes[i][1] == "t" else 0
            kept = _keeps(codes[i][0].strip(), now)
            if kept is not None:
                yield "K", KEEP + stays, i + 1, kept
            yield "R", REROLE + stays, i + 1, _NEXT[now][1]

    def descend(i: int, now: int, budget: int) -> bool:
        if i == n and (now in _ENDS if goal is None else now == goal):
            return True
        if budget < least[i] or budget <= failed.get((i, now), -1):
            return False
        for letter, price, row, after in ways(i, now):
            if price <= budget:
                path.append(letter)
                if descend(row, after, budget - price):
                    return True
                path.pop()
        failed[i, now] = budget
        return False

    # Deleting all rows but one, and three inserted turns, reach every state that can be reached.
    for bound in range(least[0], DELETE * n + TRUNCATED + 3 * INSERT + 1):
        if descend(0, state, bound):
            return bound, "".join(path)
    return None


def replay(codes: list[str], state: int, audit: str) -> Iterator[tuple[str, int | None, str | None]]:
    """Each edit with the number of its row, if it has one, and the role that the edit gives, if it gives one."""
    row = 0
    for letter in audit:
        role = None
        if letter == "K":
            state = _keeps(codes[row][0].strip(), state)
        elif letter in "IR":
            role, state = _NEXT[state]
        yield letter, None if letter == "I" else row, role
        row += letter != "I"


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows in order by conversation, turn, role and text, each with its place ``at`` and its number in its piece.

    A conversation lies in one piece, or in pieces of consecutive partitions.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    clean = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    same = F.sha2(F.concat(F.char_length("role"), F.lit(":"), "role", "text"), 256)
    clean = clean.withColumn("same", same).withColumn("tie", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "same", "tie"]
    placed = clean.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    schema = f"{placed._jdf.schema().toDDL()}, nth long"
    return stage(placed.mapInArrow(_numbered, schema).withColumn("at", F.monotonically_increasing_id()), "turns")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds nth, the number of the row among those of its conversation in this partition."""
    last, reached = (None, None), 0
    for batch in batches:
        if not len(batch):
            continue
        column = batch.column(batch.schema.get_field_index("conv_id"))
        missing = np.asarray(column.is_null())
        value = np.asarray(column.fill_null(0))
        new = np.append(True, (value[1:] != value[:-1]) | (missing[1:] != missing[:-1]))
        goes_on = last == (int(value[0]), bool(missing[0]))
        begin = np.flatnonzero(new)
        nth = np.arange(len(batch)) - np.repeat(begin, np.diff(np.append(begin, len(batch))))
        if goes_on:
            upto = begin[1] if len(begin) > 1 else len(batch)
            nth[:upto] += reached
        last, reached = (int(value[-1]), bool(missing[-1])), int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], names=[*batch.schema.names, "nth"])


def _codes(placed: DataFrame) -> DataFrame:
    """conv_id, at, nth and code of every row: the role's initial and the letter of the first fault."""
    ends_well = F.col("text").rlike(rf"[.!?][\x20\x09-\x0D]*\z")
    rows = placed.select(
        "conv_id",
        "at",
        "nth",
        "same",
        F.rpad(F.substring("role", 1, 1), 1, " ").alias("initial"),
        F.col("text").rlike(_WORD).alias("has_word"),
        ends_well.alias("ends_well"),
    )
    first = rows.groupBy("conv_id", "same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").select(F.col("conv_id").alias("of"), F.col("same").alias("as"), "first")
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("as")), "left")
    fault = (
        F.when(~F.col("has_word"), "b").when(F.col("at") > F.col("first"), "d").when(~F.col("ends_well"), "t").otherwise("-")
    )
    return joined.select("conv_id", "at", "nth", F.concat("initial", fault).alias("code"))


def _segments(codes: DataFrame, rows: int) -> DataFrame:
    """Codes of at most ``rows`` consecutive rows of a conversation, their first place, whether they begin and end it."""
    part, segment = F.shiftright("at", 33), F.floor(F.col("nth") / rows)
    found = codes.groupBy("conv_id", part.alias("part"), segment.alias("segment")).agg(
        F.min("at").alias("start"), F.sort_array(F.collect_list(F.struct("at", "code"))).alias("codes")
    )
    order = Window.partitionBy("conv_id").orderBy("start")
    return found.select(
        "conv_id",
        "start",
        F.lag("start").over(order).isNull().alias("begins"),
        F.lead("start").over(order).isNull().alias("ends"),
        F.col("codes.code").alias("codes"),
    )


_SOLVED = "conv_id long, start long, alone boolean, codes array<string>, costs array<int>, ranks array<int>, audits array<string>"


def _solver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best edits of segments for each state before (by fours) and after; cost -1 if there are none."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            costs, ranks, audits = [], [], []
            for state in _STATES:
                found = [None] * len(_STATES)
                if state == _START or not row["begins"]:
                    goals = [None] if row["ends"] else _STATES
                    for i, goal in enumerate(goals):
                        found[i] = _searched("".join(row["codes"]), state, goal)
                edits = ["" if x is None else x[1] for x in found]
                costs += [-1 if x is None else x[0] for x in found]
                ranks += [sorted(edits).index(x) for x in edits]
                audits += edits
            alone = row["begins"] and row["ends"]
            out.append((row["conv_id"], row["start"], alone, row["codes"], costs, ranks, audits))
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.string()), *[pa.list_(pa.int32())] * 2, pa.list_(pa.string())]
        names = ["conv_id", "start", "alone", "codes", "costs", "ranks", "audits"]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else []
        if out:
            yield pa.RecordBatch.from_arrays(columns, names=names)


def chain(costs: list[list[int]], ranks: list[list[int]]) -> list[tuple[int, int]]:
    """State before and number of the way of each segment, such that all together are cheapest, then least in ASCII order."""
    n = len(costs)
    rest: list[list[int | None]] = [[None] * 4 for _ in range(n)] + [[0] * 4]
    for i in range(n - 1, -1, -1):
        for state in _STATES:
            totals = [
                costs[i][4 * state + w] + rest[i + 1][w]
                for w in _STATES
                if costs[i][4 * state + w] >= 0 and rest[i + 1][w] is not None
            ]
            rest[i][state] = min(totals, default=None)
    out, state = [], _START
    for i in range(n):
        ways = [
            (ranks[i][4 * state + w], w)
            for w in _STATES
            if costs[i][4 * state + w] >= 0
            and rest[i + 1][w] is not None
            and costs[i][4 * state + w] + rest[i + 1][w] == rest[i][state]
        ]
        out.append((state, min(ways)[1]))
        state = out[-1][1]
    return out


def _chainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            parts = row["segments"]
            ways = chain([p["costs"] for p in parts], [p["ranks"] for p in parts])
            columns = [pa.array([p["start"] for p in parts], pa.int64())]
            columns += [pa.array(c, pa.int32()) for c in zip(*ways, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "state", "way"])


def _scripts(segments: DataFrame) -> DataFrame:
    """conv_id, start, codes, state before and edits of every segment."""
    # A given number of partitions is not coalesced: rows are short, but each is a search.
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    solved = stage(segments.repartition(n, "start").mapInArrow(_solver, _SOLVED), "segments")
    several = solved.where(~F.col("alone")).groupBy("conv_id")
    several = several.agg(F.sort_array(F.collect_list(F.struct("start", "costs", "ranks"))).alias("segments"))
    ways = several.select("segments").mapInArrow(_chainer, "place long, state int, way int")
    chosen = solved.where(~F.col("alone")).join(ways, F.col("start") == F.col("place"))
    columns = [F.col("conv_id"), F.col("start").alias("at"), F.col("codes")]
    alone = solved.where("alone").select(*columns, F.lit(_START).alias("state"), F.col("audits")[0].alias("audit"))
    audit = F.col("audits")[4 * F.col("state") + F.col("way")]
    return alone.unionByName(chosen.select(*columns, "state", audit.alias("audit")))


def _replayer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows the edits of each segment, whose row comes first, over the rows behind it."""
    names = [part.split(" ")[0] for part in LEDGER.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    types = [kinds[part.split(" ")[1]] for part in LEDGER.split(", ")]
    out: list[tuple] = []
    conv_id, place, before, codes = object(), count(), None, []
    edits: Iterator = iter(())

    def full() -> pa.RecordBatch:
        batch = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(batch, names=names)

    def inserted(edit: tuple) -> tuple:
        return (conv_id, next(place), "I", INSERT, None, None, None, edit[2], "", False)

    edit = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:  # a new segment; turns behind the last row of the one before come first
                while edit is not None:
                    out.append(inserted(edit))
                    edit = next(edits, None)
                if row["conv_id"] != conv_id:
                    conv_id, place, before = row["conv_id"], count(), None
                codes = row["codes"]
                edits = replay(codes, row["state"], row["audit"])
                edit = next(edits, None)
                continue
            while edit[1] is None:
                out.append(inserted(edit))
                edit = next(edits)
            letter, number, role = edit
            fault = codes[number][1]
            cost = {"K": KEEP, "R": REROLE, "D": DELETE}[letter] + (TRUNCATED if fault == "t" and letter != "D" else 0)
            initial = row["role"][:1]
            illegal = before is not None and before + initial not in ("su", "ua", "au")
            before = initial
            kept = role if letter == "R" else row["role"]
            new = (None, None) if letter == "D" else (kept, row["text"])
            out.append((conv_id, next(place), letter, cost, FAULTS[fault], row["turn"], row["role"], *new, illegal))
            edit = next(edits, None)
            if len(out) >= _BATCH:
                yield full()
    while edit is not None:
        out.append(inserted(edit))
        edit = next(edits, None)
    if out:
        yield full()


def repair(rows: DataFrame, segment: int = 32) -> DataFrame:
    """The ledger of edits over ``rows`` (conv_id, turn, role, text): one row for each edit, in order of place.

    Rows are taken by turn, NULL first, ties by role, then by the SHA-256 of
    role and text; NULL role and text count as one space, rows without conv_id
    as one conversation. A role without initial can only be replaced. edit is
    the letter, fault the row's first one, role and text what stands there
    afterwards (NULL where deleted), illegal whether the row's initial may not
    follow that of the row before. All rows of a conversation lie in one
    partition, in order. A repeated row is a fault; other columns are not read.
    """
    placed = _sorted_rows(rows)
    scripts = _scripts(_segments(_codes(placed), segment))
    texts = placed.select("conv_id", "at", F.lit(1).alias("kind"), "turn", "role", "text")
    both = texts.unionByName(scripts.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    order = both.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    return order.mapInArrow(_replayer, LEDGER)


_AUDITS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " repaired_sha256 string"
)


def _auditor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split(" ")[0] for part in _AUDITS.replace(",  ", ", ").split(", ")]
    found: dict = {}

    def row() -> pa.RecordBatch:
        turns = found["last"] - found["first"] + 1 - found["turns"] if found["turns"] else 0
        values = [conv_id, turns, *(found[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost"))]
        values += ["".join(found["audit"]), found["hash"].hexdigest()]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    conv_id = None
    for batch in batches:
        for entry in batch.to_pylist():
            if not found or entry["conv_id"] != conv_id:
                if found:
                    yield row()
                conv_id = entry["conv_id"]
                found = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
                found |= {"first": None, "last": None, "audit": [], "hash": hashlib.sha256(), "any": False}
            found["audit"].append(entry["edit"])
            found["cost"] += entry["cost"]
            found["illegal"] += entry["illegal"]
            if entry["fault"]:
                found[entry["fault"]] += 1
            turn = entry["turn"]
            if turn is not None and turn != found["last"]:
                found["first"] = turn if found["turns"] == 0 else found["first"]
                found["last"], found["turns"] = turn, found["turns"] + 1
            if entry["edit"] != "D":
                line = f"{entry['role']}:{entry['text']}"
                found["hash"].update((f"\n{line}" if found["any"] else line).encode())
                found["any"] = True
    if found:
        yield row()


def audits(ledger: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for every conv_id of ``conversations``, from its edits in ``ledger``: faults, cost, edits, hash of the result.

    gaps are the turns missing between the first and the last. A conversation
    without edits has zeros, no edits and the hash of the empty string.
    """
    found = ledger.mapInArrow(_auditor, _AUDITS).withColumnRenamed("conv_id", "of")
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")

    def filled(name: str, value: Column) -> Column:
        return F.coalesce(F.col(name), value).alias(name)

    numbers = [filled(n, F.lit(0).cast("long")) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select("conv_id", *numbers, filled("audit", F.lit("")), filled("repaired_sha256", empty))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text), NULL role and text as one space, damaged by a hash of conv_id and turn.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 removes ``.``, ``!``
    and ``?`` from it, 3 repeats it, 4 gives it the role user. NULL conv_id and
    turn count as one space in the hash and stay NULL.
    """
    parts = [F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    drawn = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), draw.alias("draw")
    )
    times = F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1)
    without = F.regexp_replace("text", "[.!?]", "")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, without).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    repeated = drawn.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))
    )
    return repeated.drop("col")
