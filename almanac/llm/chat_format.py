"""Conversations as training text, by a declarative template: segments, each with its loss flag.

A template says for every role how its turns begin and end and whether they are learned, and which
role may follow which: a finite-state machine whose state is the role that spoke last. Every turn
becomes three segments, its opening mark, its text and its closing mark; only the text of learned roles is
under the loss mask. Turns of roles the template does not know get a mark that names the role.
`valid` says whether the machine may take the turn; it goes on from the role that spoke in any case, so
that one slip is one invalid turn, and all turns are formatted.

Texts cannot forge marks: in a text the escape character is doubled, and every control string has one put
after its first character. Both are undone by taking each escape character that does not follow
another away, so `turns_of` reads roles and texts back from the formatted text alone.

Only DataFrame functions are used. One shuffle by conversation serves the window that numbers turns and the
aggregate that joins them. `format_turns` is a row per turn and holds for conversations of any size;
`format_conversations` and what reads it make one value of a conversation, 2 GB of text at most.

Rows go by turn, null first, then by role and text; repeated rows are turns of their own. Null role or text counts
as empty. Rows with a null key are one conversation. Other columns are not looked at. No rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Mark:
    """How a role's turns begin and end, and whether their text is learned."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """`follows`: the roles that may speak after each role, "" being the beginning; `ends`: those that may be the last.

    `other` is for roles without a mark of their own; the role's name stands between the two parts of its opening.
    """

    marks: Mapping[str, Mark]
    other: tuple[str, str, str]
    controls: tuple[str, ...]
    follows: Mapping[str, tuple[str, ...]]
    ends: tuple[str, ...]

    def __post_init__(self):
        for c in self.controls:
            if len(c) < 2 or ESCAPE in c or any(c[i:] == d[: len(c) - i] for d in self.controls for i in range(1, len(c))):
                raise ValueError(f"control string {c!r} is short, has an escape character or may overlap another")
            if any(c != d and c in d for d in self.controls):
                raise ValueError(f"control string {c!r} is part of another")
        openings = [*(m.opening for m in self.marks.values()), self.other[0]]
        if not all(any(o.startswith(c) for c in self.controls) for o in openings) or len(set(openings)) < len(openings):
            raise ValueError("every opening must be its own and begin with a control string")
        if not all(any(c in end for c in self.controls) for end in (*(m.closing for m in self.marks.values()), *self.other[1:])):
            raise ValueError("every closing must hold a control string")


INSTRUCT = Template(
    marks={
        "system": Mark("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Mark("[INST] ", " [/INST]\n"),
        "assistant": Mark("<s>", "</s>\n", loss=True),
    },
    other=("[ROLE]", "[/ROLE] ", " [/TURN]\n"),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]"),
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)


def escaped(text: Column, template: Template = INSTRUCT) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for c in template.controls:
        text = F.replace(text, F.lit(c), F.lit(c[0] + ESCAPE + c[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _by_role(role: Column, template: Template, of_mark, otherwise: Column) -> Column:
    chain = F
    for name, mark in template.marks.items():
        chain = chain.when(role == name, of_mark(mark))
    return chain.otherwise(otherwise)


def segments(role: Column, text: Column, template: Template = INSTRUCT) -> Column:
    """array<struct<text, loss>> of one turn."""
    before, after, closing = map(F.lit, template.other)
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(
        part(_by_role(role, template, lambda m: F.lit(m.opening), F.concat(before, escaped(role, template), after)), F.lit(False)),
        part(escaped(text, template), _by_role(role, template, lambda m: F.lit(m.loss), F.lit(False))),
        part(_by_role(role, template, lambda m: F.lit(m.closing), closing), F.lit(False)),
    )


def format_turns(rows: DataFrame, template: Template = INSTRUCT, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, place, role, valid, segments) of every row; place counts from 1 in each conversation."""
    named = rows.select(F.col(key).alias("key"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    in_order = Window.partitionBy("key").orderBy("turn", "role", "text")
    state = F.lag("role").over(in_order)
    may = lambda state, roles: F.col("role").isin(*roles) & (F.col("_state").isNull() if state == "" else F.col("_state") == state)
    valid = F.lit(False)
    for one, roles in template.follows.items():
        valid = valid | F.coalesce(may(one, roles), F.lit(False))
    return (
        named.withColumns({"place": F.row_number().over(in_order), "_state": state})
        .select(F.col("key").alias(key), "place", "role", valid.alias("valid"), segments(F.col("role"), F.col("text"), template).alias("segments"))
    )


def format_conversations(rows: DataFrame, template: Template = INSTRUCT, key: str = "conv_id", **columns: str) -> DataFrame:
    """(key, valid, segments): each conversation as one list of segments."""
    turns = format_turns(rows, template, key, **columns)
    listed = turns.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("place", "segments"))).alias("_turns"),
        (F.every("valid") & F.max_by("role", "place").isin(*template.ends)).alias("valid"))
    return listed.select(key, "valid", F.flatten(F.transform("_turns", lambda t: t["segments"])).alias("segments"))


def formatted(parts: Column) -> Column:
    """The text that a list of segments is."""
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def turns_of(whole: Column, template: Template = INSTRUCT) -> Column:
    """array<struct<role, text>> read from a formatted text."""
    ends = [(m.opening, m.closing) for m in template.marks.values()]
    before, after, closing = template.other
    pattern = "|".join(f"{_literal(a)}.*?{_literal(b)}" for a, b in [*ends, (before, closing)])
    every = F.regexp_extract_all(whole, F.lit(f"(?s){pattern}"), F.lit(0))

    def read(turn: Column) -> Column:
        inside = lambda a, b: F.substring(turn, F.lit(len(a) + 1), F.char_length(turn) - len(a) - len(b))
        chain = F
        for name, mark in template.marks.items():
            own = F.struct(F.lit(name).alias("role"), unescaped(inside(mark.opening, mark.closing)).alias("text"))
            chain = chain.when(turn.startswith(mark.opening), own)
        rest = inside(before, closing)
        name = F.substring_index(rest, after, 1)
        said = F.substring(rest, F.char_length(name) + len(after) + 1, F.char_length(rest))
        return chain.otherwise(F.struct(unescaped(name).alias("role"), unescaped(said).alias("text")))

    return F.transform(every, read)


def _literal(text: str) -> str:
    return re.escape(text).replace("\\\n", "\\n")


def read_back(conversations: DataFrame, template: Template = INSTRUCT, key: str = "conv_id") -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid), all from the formatted segments."""
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    read = conversations.select(F.col(key), "valid", formatted(F.col("segments")).alias("_whole"), learned.alias("_learned"))
    read = read.withColumn("_turns", turns_of(F.col("_whole"), template))
    line = F.lit("\n")
    told = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    return read.select(
        key, F.size("_turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("_learned").cast("long").alias("loss_chars"), F.sha2("_learned", 256).alias("loss_sha256"),
        F.char_length("_whole").cast("long").alias("formatted_chars"), "valid")
