"""Chat formatting from a declarative template, and reading it back.

A finite-state machine over roles checks the order of turns. Each turn becomes
three segments, opening, text and closing, each with a flag that says whether
it counts for the training loss. Control strings inside texts are broken by an
escape character, so a formatted conversation can always be taken apart again.
Everything is built from DataFrame functions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """Text before and after a role's turns, and whether their texts are learned."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of each role, and which role may follow which.

    Roles without marks of their own are written between ``other`` marks with
    ``between`` after the role's name. ``follows`` gives the roles allowed in
    each state; a state is the role of the last turn, at first "". ``final``
    are states a conversation may end in. ``controls`` are the strings that
    texts may not contain as they are; every mark begins with one, and each has
    its first character nowhere else, so no control string can arise where a
    text and a mark meet.
    """

    begin: str = "<s>"
    roles: Mapping[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("[SYS] ", " [/SYS]\n"),
            "user": Turn("[INST] ", " [/INST] "),
            "assistant": Turn("[ANS] ", " </s>", loss=True),
        }
    )
    other: Turn = Turn("[TURN] ", " [/TURN]\n")
    between: str = "[TEXT] "
    follows: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = (
        "<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[TURN]", "[/TURN]", "[TEXT]",
    )
    escape: str = "\\"

    def __post_init__(self):
        first = {c[0] for c in self.controls}
        marks = [self.begin, self.between, self.other.open, self.other.close]
        marks += [m for turn in self.roles.values() for m in (turn.open, turn.close)]
        if any(x in c[1:] for c in self.controls for x in first) or any(self.escape in m for m in marks):
            raise ValueError("a control string's first character, or the escape character, occurs inside a mark")
        if any(m.lstrip() and not m.lstrip().startswith(self.controls) for m in marks):
            raise ValueError("every mark must begin with a control string")

    def escaped(self, text: Column) -> Column:
        by_first: dict[str, list[str]] = {}
        for c in self.controls:
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        pattern = "|".join(f"{re.escape(c)}(?={'|'.join(rest)})" for c, rest in by_first.items())
        doubled = F.replace(text, F.lit(self.escape), F.lit(self.escape * 2))
        return F.regexp_replace(doubled, pattern, f"$0{re.escape(self.escape)}")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, f"(?s){re.escape(self.escape)}(.)", "$1")

    def turn_segments(self, role: Column, text: Column) -> Column:
        """The three segments of a turn."""

        def three(opening: Column, closing: str, loss: bool) -> Column:
            parts = [(opening, False), (self.escaped(text), loss), (F.lit(closing), False)]
            return F.array(*[F.struct(p.alias("text"), F.lit(flag).alias("loss")) for p, flag in parts])

        opening = F.concat(F.lit(self.other.open), self.escaped(role), F.lit(self.between))
        found = None
        for name, turn in self.roles.items():
            own = three(F.lit(turn.open), turn.close, turn.loss)
            found = F.when(role == name, own) if found is None else found.when(role == name, own)
        rest = three(opening, self.other.close, False)
        return rest if found is None else found.otherwise(rest)

    def first_error(self, roles: Column) -> Column:
        """Number of the first turn (from 0) the machine refuses, NULL if it accepts all and may end there.

        A conversation that may not end where it does has its error after the last turn.
        """
        moves = [F.lit(f"{state}>{role}") for state, after in self.follows.items() for role in after]
        start = F.struct(F.lit("").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("error"))

        def step(at: Column, role: Column) -> Column:
            allowed = F.array_contains(F.array(*moves), F.concat(at["state"], F.lit(">"), role))
            error = F.coalesce(at["error"], F.when(~allowed, at["n"]))
            return F.struct(role.alias("state"), (at["n"] + 1).alias("n"), error.alias("error"))

        def end(at: Column) -> Column:
            return F.coalesce(at["error"], F.when(~at["state"].isin(*self.final), at["n"]))

        return F.aggregate(roles, start, step, end)

    def turns_of(self, formatted: Column) -> Column:
        """Role and text of every turn of a formatted conversation."""
        turns = {**self.roles, None: self.other}
        opens = "|".join(re.escape(turn.open) for turn in turns.values())
        body = F.substring(formatted, len(self.begin) + 1, 0x7FFFFFFF)
        pieces = F.filter(F.split(body, f"(?={opens})", -1), lambda p: p != "")

        def inner(piece: Column, turn: Turn) -> Column:
            size = F.char_length(piece) - len(turn.open) - len(turn.close)
            return F.substring(piece, F.lit(len(turn.open) + 1), size)

        def read(piece: Column) -> Column:
            rest = inner(piece, self.other)
            at = F.instr(rest, F.lit(self.between))
            found = None
            for name, turn in self.roles.items():
                own = F.struct(F.lit(name).alias("role"), self.unescaped(inner(piece, turn)).alias("text"))
                hit = F.startswith(piece, F.lit(turn.open))
                found = F.when(hit, own) if found is None else found.when(hit, own)
            other = F.struct(
                self.unescaped(F.substring(rest, F.lit(1), at - 1)).alias("role"),
                self.unescaped(F.substring(rest, at + len(self.between), F.char_length(rest))).alias("text"),
            )
            return other if found is None else found.otherwise(other)

        return F.transform(pieces, read)


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, segments, formatted, first_error for every conversation.

    ``turns`` has conv_id, turn, role and text, one row per turn; other columns
    are not read. Turns are put in order by turn, ties by role and text, NULL
    turns first; repeated rows are turns of their own. NULL role and text count
    as empty; NULL conv_id is a conversation of its own. Conversations in a
    wrong order are formatted too; ``first_error`` tells where it breaks.
    ``segments`` hold text and loss flag in order, ``formatted`` is all of it.
    One conversation is one string, and so is put together in one task.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(
        begin, F.flatten(F.transform("rows", lambda r: template.turn_segments(r["role"], r["text"])))
    )
    return ordered.select(
        "conv_id", segments.alias("segments"), template.first_error(F.transform("rows", lambda r: r["role"])).alias("first_error")
    ).select("conv_id", "segments", F.array_join(F.col("segments")["text"], "").alias("formatted"), "first_error")


def read_chats(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turns (role, text) and learned (the texts under the loss mask) read from :func:`format_chats`."""
    under = F.filter("segments", lambda s: s["loss"])
    return formatted.select(
        "conv_id",
        template.turns_of(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(under, lambda s: template.unescaped(s["text"])), "").alias("learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "first_error",
    )
