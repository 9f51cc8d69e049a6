"""Repair of conversations against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from itertools import pairwise

import pytest

from retrocohort.llm.chat_repair import audits, chain, damaged, repair, search
from retrocohort.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def plain_repair(rows):
    """Dijkstra over (cost, edits): the least pair that ends in a legal conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        faults.append(kind)
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, roles, lines = heapq.heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            break
        if (i, roles[-1:]) in done:
            continue
        done.add((i, roles[-1:]))
        ways = [("I", 5, i, new, "") for new in ("user", "assistant")]
        if i < len(rows):
            ways.append(("D", 2, i + 1, None, None))
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                ways += [("K", more, i + 1, rows[i][2], rows[i][3])] if rows[i][2] else []
                ways += [("R", 1 + more, i + 1, new, rows[i][3]) for new in ("user", "assistant")]
        for letter, price, j, role, text in ways:
            after = roles if role is None else roles + role[0]
            if re.fullmatch("(s?(ua)*u?)?", after):
                new = lines if role is None else (*lines, f"{role}:{text}")
                heapq.heappush(queue, (cost + price, audit + letter, j, after, new))
    turns = sorted({r[1] for r in rows if r[1] is not None})
    initials = [r[2][:1] for r in rows]
    return (
        turns[-1] - turns[0] + 1 - len(turns) if turns else 0,
        *(faults.count(kind) for kind in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in pairwise(initials)),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain_audits(rows, original):
    groups = {r[0]: [] for r in original}
    for r in rows:
        groups[r[0]].append(r)
    return sorted(((k, *plain_repair(v)) for k, v in groups.items()), key=repr)


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]
    got = QUERIES["op13_structure_repair"](spark, FOLDER).collect()
    assert sorted(map(tuple, got), key=repr) == plain_audits(plain_damage(rows), rows)


def _random_rows(n, seed, longest):
    draw = random.Random(seed)
    texts = ["yes.", "no", "", " ", "Why?", "cut off", "a\nb!", None, "end. \t"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    out = []
    for conv in [*range(n), None]:
        for _ in range(draw.randint(0, longest)):
            turn = draw.choice([None, *range(draw.randint(1, 2 * longest))])
            text = draw.choice([*texts, f"text {draw.random()}.", f"text {draw.random()}."])
            out.append((conv, turn, draw.choice(roles), text))
    return out


@pytest.mark.parametrize("segment", [1, 3, 32])
def test_random_conversations(spark, segment):
    rows = _random_rows(60, segment, 9)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'x' AS at", "1 AS place", "'y' AS edit", "2 AS nth", "'z' AS same")
    want = plain_audits([(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows], rows)
    got = audits(repair(df, segment=segment), df).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_one_long_conversation_in_many_pieces(spark):
    rows = [(1, t, random.Random(t).choice(["user", "assistant", "system"]), f"{t % 400} words.") for t in range(700)]
    rows += [(1, None, "user", "the same again.")] * 200 + [(2, 0, "user", "hello."), (2, 1, "assistant", "hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = audits(repair(df), df).collect()
    assert sorted(map(tuple, got), key=repr) == plain_audits(rows, rows)


def test_ledger_holds_the_repaired_turns(spark):
    rows = [(5, 0, "assistant", "Hello."), (5, 1, "user", "what is"), (5, 2, "user", "What is it?"), (5, 3, "user", "It is so.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ledger = repair(df).orderBy("place").collect()
    assert [r.edit for r in ledger] == ["D", "D", "K", "R"]
    assert [(r.role, r.text) for r in ledger if r.edit != "D"] == [("user", "What is it?"), ("assistant", "It is so.")]
    assert [r.fault for r in ledger] == [None, "truncated", None, None]


def test_search_takes_the_least_of_the_cheapest():
    assert search([], 0, None) == (0, "")
    assert search(["u-"], 0, None) == (2, "D")
    assert search(["u-", "at", "u-", "a-"], 0, None) == (4, "DDKK")
    assert search(["s-", "u-", "a-"], 0, None) == (0, "KKK")
    assert search([" -", "a-"], 0, None) == (1, "RK")
    assert search(["ub"], 0, 1) is None


def test_chain_equals_one_search():
    draw = random.Random(3)
    for _ in range(200):
        codes = [draw.choice("usa ") + draw.choice("bdt---") for _ in range(draw.randint(2, 9))]
        cuts = sorted({0, len(codes), *(draw.randint(1, len(codes) - 1) for _ in range(2))})
        costs, ranks, edits = [], [], []
        for i, (a, b) in enumerate(pairwise(cuts)):
            goals = [None] if b == len(codes) else range(4)
            found = [[search(codes[a:b], s, g) for g in goals] + [None] * (4 - len(goals)) for s in range(4)]
            costs.append([-1 if x is None or (i == 0 and s) else x[0] for s in range(4) for x in found[s]])
            edits.append(["" if x is None else x[1] for s in range(4) for x in found[s]])
            ranks.append([sorted(edits[-1][4 * s : 4 * s + 4]).index(edits[-1][4 * s + w]) for s in range(4) for w in range(4)])
        ways = chain(costs, ranks)
        total = sum(costs[i][4 * s + w] for i, (s, w) in enumerate(ways))
        assert (total, "".join(edits[i][4 * s + w] for i, (s, w) in enumerate(ways))) == search(codes, 0, None)


def test_damage(spark):
    rows = [(i, t, r, x) for i in range(40) for t, r, x in [(0, "user", "a.b!"), (None, None, "c?"), (2, "assistant", None)]]
    df = spark.createDataFrame([*rows, (None, None, None, None)], "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, damaged(df).collect()), key=repr)
    assert got == sorted(plain_damage([*rows, (None, None, None, None)]), key=repr)
