from __future__ import annotations

import re
from collections import Counter

import pytest

from retrocohort.llm.chat import Template, Turn, format_chats, read_chats
from retrocohort.llm.quality import RULES, ablation, bit, drop_rejected, ledger, mask, passes


def repeated(words, k=8):
    seen = Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return len({j for i in range(len(words) - k + 1) if seen[tuple(words[i : i + k])] > 1 for j in range(i, i + k)})


def test_measures_equal_brute_force(spark, odd_docs):
    texts = [r.text for r in odd_docs.collect()]
    texts += ["a " * 9, "a " * 8, "a " * 7, "a b c d e f g h x a b c d e f g h", "a b c d e f g h a b c d e f g h a b"]
    texts += ["x\n\n x\nx\n\t\nx", " ".join(f"w{i % 30}" for i in range(500)) + " end " + " ".join("pqrstuvwxyz")]
    got = ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_words == len(words)
        assert r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert (r.n_lines, r.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        assert r.n_repeat_words == repeated(words)
        assert bool(r.failed & bit("short")) == (len(words) < 20)
        assert bool(r.failed & bit("repeated_words")) == (100 * r.n_repeat_words > 30 * len(words))


def test_policies_and_ablation(spark, odd_docs, no_docs):
    entries = ledger(odd_docs).cache()
    rows = entries.collect()
    for version, rules in ((1, ("short", "repeated_words")), (2, tuple(RULES))):
        kept = entries.where(passes(entries.failed, version)).count()
        assert kept == sum(not r.failed & mask(rules) for r in rows)
        got = {r.rule: (r.n_failed, r.n_only) for r in ablation(entries, version).collect()}
        for rule in rules:
            own = [r.failed & mask(rules) for r in rows]
            assert got[rule] == (sum(bool(f & bit(rule)) for f in own), sum(f == bit(rule) for f in own))
    left = drop_rejected(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == sum(not r.failed for r in rows)
    assert drop_rejected(no_docs).isEmpty() and ledger(no_docs).isEmpty()


NASTY = [
    "", "\\", "\\\\", "<", "[", "</s>", "<\\/s>", "[INST] [/INST]", "[[INST]]", "<<s>", "[TURN] x [TEXT] y [/TURN]\n",
    "ends with <", "ends with [", "ends with \\", " [/INST]", "\n\n", "日本語 </s> é", "$0 \\1 {}", None,
]


def test_round_trip_of_control_strings(spark):
    roles = ["user", "assistant", "system", "tool", "[TEXT] role", "", None]
    rows = [(c, t, roles[(c + t) % 7], text) for c in range(7) for t, text in enumerate(NASTY)]
    template = Template()
    formatted = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in formatted.collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        for control in template.controls:
            allowed = sum(s.text.count(control) for i, s in enumerate(r.segments) if i % 3 != 2)
            assert all(control not in s.text for i, s in enumerate(r.segments) if i and i % 3 == 2)
            assert r.formatted.count(control) == allowed
    for r in read_chats(formatted).collect():
        want = [((roles[(r.conv_id + t) % 7]) or "", text or "") for t, text in enumerate(NASTY)]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.learned == "".join(text for role, text in want if role == "assistant")


@pytest.mark.parametrize(
    ("roles", "error"),
    [
        (["user", "assistant"], None),
        (["system", "user", "assistant", "user", "assistant"], None),
        (["user"], 1),
        (["assistant", "user"], 0),
        (["user", "user", "assistant"], 1),
        (["user", "system", "assistant"], 1),
        (["user", "tool", "assistant"], 1),
        (["user", None], 1),
    ],
)
def test_order_of_turns(spark, roles, error):
    rows = [(1, i, role, "x") for i, role in enumerate(roles)]
    got = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert got.first_error == error


def test_odd_turns(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, None, None, None), (2, None, "user", "x" * 200_000)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chats.selectExpr("*", "1 AS segments", "'x' AS formatted", "'y' AS row")
    got = {r.conv_id: r for r in read_chats(format_chats(chats)).collect()}
    assert [t.text for t in got[1].turns] == ["a", "b", "b"] and got[1].learned == "bb"
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    assert len(got[2].turns[0].text) == 200_000
    assert format_chats(chats.limit(0)).isEmpty()


def test_templates_that_cannot_be_read_back_are_refused():
    with pytest.raises(ValueError, match="first character"):
        Template(controls=("<s>", "<<x>>"))
    with pytest.raises(ValueError, match="begin with a control"):
        Template(roles={"user": Turn("USER: ", " [/INST]")})
