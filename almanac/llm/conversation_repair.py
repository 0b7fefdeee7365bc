"""Cheapest repair of the turns of conversations, decided by one integer per path.

A conversation is in order when the initials of its roles read `(s?(ua)+)?`: at most one opening
system turn, then user and assistant in turn. Edits in order of the rows: keep a row (0), give it
the role user or assistant (2), delete it (3; blank and repeated rows must go), insert an empty
user or assistant turn anywhere (2); a truncated row that stays adds 1. The cheapest edits win, and
of equally cheap ones those whose initials (D, I, K, R) are the least string in ASCII order.

Both are decided by the least integer over all paths of an acyclic graph, whose nodes are (row, state of
the pattern). A path's weight has its cost in the high digits. Below, each row has a slot of three
digits of three bits, in order: the letters of the inserts before the row (never more than two) and of
the row's own edit, filled up with zeros at the end. As no slot's word is the beginning of another's but in
the last slot, which holds closing inserts alone, comparing such numbers compares the strings. Weights only
add up, so the graph needs nothing but `min`; cost and edits are read from the number that is left.

For a long conversation the number is cut after every BLOCK_ROWS rows: the digits so far become
their rank among the states' paths (which orders them just as well) and are put aside. So numbers do not
grow, and a conversation of any length costs time in proportion and a few bytes a row.

Conversations are streams: each is in one task, in order, once as narrow rows that decide the edits,
then with its texts, which leave row by row; neither rows nor texts of a conversation are collected. Earlier
rows with the same role and text are found by an aggregate over digests, combined before its shuffle.

Rows go by turn, null first; rows of one turn by role, then by the SHA-256 of their text, so
repeated rows are neighbours. Null role or text counts as one space. Rows with a null key are one
conversation. Turns are whole numbers. Other columns are not looked at. No rows give no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices
from almanac.sources.stage import stage

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1  # costs
LETTERS = " DIKR"  # letter of a digit; 0 is the padding
DIGIT_BITS = 3
SLOT_BITS = 3 * DIGIT_BITS
BLOCK_ROWS = 256
#: Conversations up to this many rows are remembered by their classes: most are alike.
SHORT_ROWS = 32
#: Rows of an output batch, and about the bytes of its texts.
OUT_ROWS, OUT_BYTES = 1_000, 4 << 20
BLANKS = " \t\n\x0b\x0c\r"

#: States of the pattern: nothing yet, after the system turn, after a user turn, after an assistant turn, closed.
START, SYSTEM, USER, ASSISTANT, CLOSED = range(5)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What a row is: initial (s, u, a, other) plus 4 * fault.
INITIALS, FAULTS = "sua", ("", "blank", "duplicate", "truncated")
END = 16

Edge = tuple[int, int, int, int]  # from, to, cost, slot


def _slot(letters: str) -> int:
    number = 0
    for letter in letters.ljust(3):
        number = number << DIGIT_BITS | LETTERS.index(letter)
    return number


def _letters(slot: int) -> str:
    return "".join(LETTERS[slot >> s & 7] for s in (6, 3, 0)).rstrip()


@cache
def edges(kind: int) -> tuple[Edge, ...]:
    """The least edge between any two states for a row of this kind, or for the end."""
    best: dict[tuple[int, int], tuple[int, int]] = {}

    def offer(start: int, stop: int, cost: int, letters: str) -> None:
        word = cost, _slot(letters)
        best[start, stop] = min(best.get((start, stop), word), word)

    initial, fault = kind % 4, kind // 4
    for start in (START, SYSTEM, USER, ASSISTANT):
        state = start
        for inserts in range(3):
            before, spent = "I" * inserts, INSERT * inserts
            if kind == END:
                if state in (START, ASSISTANT):
                    offer(start, CLOSED, spent, before)
            else:
                offer(start, state, spent + DELETE, before + "D")
                if FAULTS[fault] not in ("blank", "duplicate"):
                    left = CUT_SHORT if FAULTS[fault] == "truncated" else 0
                    offer(start, _NEXT[state], spent + left + REROLE, before + "R")
                    if initial == 0 and state == START:
                        offer(start, SYSTEM, spent + left + KEEP, before + "K")
                    if initial in (1, 2) and _NEXT[state] == (USER, ASSISTANT)[initial - 1]:
                        offer(start, _NEXT[state], spent + left + KEEP, before + "K")
            state = _NEXT[state]
    return tuple((a, b, cost, slot) for (a, b), (cost, slot) in sorted(best.items()))


class Path:
    """The least weights of the paths to each state, row by row."""

    def __init__(self, block_rows: int = BLOCK_ROWS):
        self.block_rows = block_rows
        self.slots = (block_rows + 1) * SLOT_BITS  # bits below the rank of what was put aside
        self.weight: dict[int, int] = {START: 0}
        self.aside: list[dict[int, tuple[int, int]]] = []  # per block: state -> (state before the block, digits)
        self.before = [START]  # state before the block, by rank
        self.rows = 0

    def add(self, kind: int) -> None:
        if self.rows == self.block_rows and kind != END:
            self._put_aside()
        shift, cost_at = self.slots - (self.rows + 1) * SLOT_BITS, self.slots + 2
        fresh: dict[int, int] = {}
        for start, stop, cost, slot in edges(kind):
            if start in self.weight:
                total = self.weight[start] + (cost << cost_at) + (slot << shift)
                if stop not in fresh or total < fresh[stop]:
                    fresh[stop] = total
        self.weight = fresh
        self.rows += 1

    def _put_aside(self) -> None:
        low = (1 << self.slots + 2) - 1
        order = sorted(self.weight, key=lambda state: self.weight[state] & low)
        digits = (1 << self.slots) - 1
        self.aside.append({s: (self.before[self.weight[s] >> self.slots & 3], self.weight[s] & digits) for s in order})
        self.weight = {s: (self.weight[s] >> self.slots + 2 << 2 | rank) << self.slots for rank, s in enumerate(order)}
        self.before, self.rows = order, 0

    def close(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits."""
        self.add(END)
        cost = self.weight[CLOSED] >> self.slots + 2
        self._put_aside()
        words, state = [], CLOSED
        for block in reversed(self.aside):
            state, digits = block[state]
            words.append("".join(_letters(digits >> at & 0o777) for at in range(self.slots - SLOT_BITS, -1, -SLOT_BITS)))
        return cost, "".join(reversed(words))


def cheapest(kinds: bytes | bytearray) -> tuple[int, str]:
    if len(kinds) <= SHORT_ROWS:
        return _remembered(bytes(kinds))
    return _cheapest(kinds)


def _cheapest(kinds: bytes | bytearray) -> tuple[int, str]:
    path = Path()
    for kind in kinds:
        path.add(kind)
    return path.close()


@lru_cache(maxsize=1 << 14)
def _remembered(kinds: bytes) -> tuple[int, str]:
    return _cheapest(kinds)


@dataclass(frozen=True)
class Turn:
    place: int
    edit: str
    role: str
    text: str


class Conversation:
    """What is known of one conversation while its rows go by: all of them narrow, then all of them with text."""

    def __init__(self, key: object):
        self.key = key
        self.kinds, self.counts = bytearray(), [0] * len(FAULTS)
        self.illegal, self.turns, self.lowest, self.highest = 0, 0, None, None
        self._last: tuple | None = None
        self.cost, self.audit = 0, ""
        self._at, self._state, self._place, self._decided = 0, START, 0, False

    def look(self, turn: int | None, role: str, digest: bytes, fault: int, later: bool) -> None:
        if fault != 1 and (later or self._last == (turn, role, digest)):
            fault = 2
        initial = INITIALS.find(role[:1]) if role else 3
        initial = 3 if initial < 0 else initial
        if self._last is not None:
            self.illegal += (INITIALS + "-")[self.kinds[-1] % 4] + (INITIALS + "-")[initial] not in ("su", "ua", "au")
        if turn is not None and (self.highest is None or turn != self.highest):
            self.turns += 1
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
        self._last = (turn, role, digest)
        self.counts[fault] += 1
        self.kinds.append(initial + 4 * fault)

    def decide(self) -> None:
        if not self._decided:
            self.cost, self.audit = cheapest(self.kinds)
            self._decided = True

    def edited(self, role: str, text: str) -> Iterator[Turn]:
        """The turns that this row becomes, inserted ones before it included."""
        self.decide()
        yield from self._inserted()
        edit = self.audit[self._at]
        self._at += 1
        if edit == "D":
            return
        if edit == "R":
            self._state = _NEXT[self._state]
            role = _ROLE[self._state]
        else:
            self._state = (SYSTEM, USER, ASSISTANT)[INITIALS.index(role[0])]
        self._place += 1
        yield Turn(self._place, edit, role, text)

    def _inserted(self) -> Iterator[Turn]:
        while self.audit[self._at : self._at + 1] == "I":
            self._at += 1
            self._state = _NEXT[self._state]
            self._place += 1
            yield Turn(self._place, "I", _ROLE[self._state], "")

    closing = _inserted

    @property
    def gaps(self) -> int:
        return 0 if self.highest is None else self.highest - self.lowest + 1 - self.turns


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, Turn | None]]:
    """Turns of the repaired conversations in order; None ends a conversation."""
    now: Conversation | None = None
    for batch in slices(batches, "text"):
        for key, narrow, turn, role, digest, fault, later, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or key != now.key:
                if now is not None:
                    yield from ((now, t) for t in now.closing())
                    yield now, None
                now = Conversation(key)
            if narrow:
                now.look(turn, role, digest, fault, later)
            else:
                yield from ((now, t) for t in now.edited(role, text))
    if now is not None:
        yield from ((now, t) for t in now.closing())
        yield now, None


def _in_order(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation in one task: its narrow rows, then its rows with text, both in order."""
    ship(rows.sparkSession)
    one_space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    named = rows.select(F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"), one_space(role).alias("role"), one_space(text).alias("text"))
    named = named.withColumn("digest", F.unhex(F.sha2("text", 256)))
    narrow = stage(named.select("key", "turn", "role", "digest", _fault(F.col("text")).alias("fault")), "turns")

    seen = narrow.where("fault != 1").groupBy("key", "role", "digest").agg(
        F.count("*").alias("_n"), F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_first")).where("_n > 1")
    # Written, so that its true size decides between a broadcast and a join that splits frequent keys.
    seen = stage(seen.select(*[F.col(c).alias(f"_{c}") for c in ("key", "role", "digest")], "_null", "_first"), "repeated")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    later = F.coalesce(F.col("turn").isNotNull() & (F.col("_null") | (F.col("turn") > F.col("_first"))), F.lit(False))
    looked = narrow.join(seen, same, "left").select("key", F.lit(True).alias("narrow"), "turn", "role", "digest", "fault", later.alias("later"),
                                                    F.lit(None).cast("string").alias("text"))
    read = named.select("key", F.lit(False).alias("narrow"), "turn", "role", "digest", F.lit(0).alias("fault"), F.lit(False).alias("later"), "text")
    return looked.unionByName(read).repartition("key").sortWithinPartitions("key", F.desc("narrow"), "turn", "role", "digest")


def _fault(text: Column) -> Column:
    """Number of the fault that the text alone shows."""
    end = F.rtrim(text, F.lit(BLANKS))
    return F.when(end == "", F.lit(1)).when(F.right(end, F.lit(1)).isin(".", "!", "?"), F.lit(0)).otherwise(F.lit(3))


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, place, edit, role, text): the turns of the repaired conversations, numbered from 1; edit is K, R or I."""
    ordered = _in_order(rows, key, turn, role, text)
    kind = ordered.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key_type = [], 0, pa.null()

        def out() -> pa.RecordBatch:
            columns = [*zip(*held, strict=True)] or [()] * 5
            types = (key_type, pa.int64(), pa.string(), pa.string(), pa.string())
            return pa.record_batch({n: pa.array(c, t) for n, c, t in zip((key, "place", "edit", "role", "text"), columns, types, strict=True)})

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field(0).type
                yield batch

        for now, turn in _streamed(typed()):
            if turn is None:
                continue
            held.append((now.key, turn.place, turn.edit, turn.role, turn.text))
            size += len(turn.text)
            if len(held) == OUT_ROWS or size > OUT_BYTES:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return ordered.mapInArrow(run, f"`{key}` {kind}, place long, edit string, role string, text string")


def audit(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    The hash is of the repaired turns as `role:text`, joined by line breaks.
    """
    ordered = _in_order(rows, key, turn, role, text)
    kind = ordered.schema["key"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, key_type = [], hashlib.sha256(), pa.null()

        def out() -> pa.RecordBatch:
            columns = [*zip(*held, strict=True)] or [()] * 9
            types = (key_type, *[pa.int64()] * 6, pa.string(), pa.string())
            return pa.record_batch({n: pa.array(c, t) for n, c, t in zip((key, *counts, "audit", "repaired_sha256"), columns, types, strict=True)})

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field(0).type
                yield batch

        for now, turn in _streamed(typed()):
            if turn is not None:
                digest.update(("\n" if turn.place > 1 else "").encode() + f"{turn.role}:{turn.text}".encode())
                continue
            held.append((now.key, now.gaps, *now.counts[1:], now.illegal, now.cost, now.audit, digest.hexdigest()))
            digest = hashlib.sha256()
            if len(held) == OUT_ROWS or len(now.audit) > OUT_BYTES:
                yield out()
                held = []
        if held:
            yield out()

    fields = ", ".join(f"{c} long" for c in counts)
    return ordered.mapInArrow(run, f"`{key}` {kind}, {fields}, audit string, repaired_sha256 string")


def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turn, role, text) with planted faults, by the CRC-32 of `key:turn` modulo 20: 0 drops the row, 1 empties its
    text, 2 takes `[.!?]` out of it, 3 repeats the row, 4 makes it a user's; nulls are one space."""
    one_space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat(one_space(key), F.lit(":"), one_space(turn)).cast("binary")) % 20
    rows = rows.select(F.col(key), F.col(turn), one_space(role).alias(role), one_space(text).alias(text), drawn.alias("_drawn")).where("_drawn != 0")
    harmed = F.when(F.col("_drawn") == 1, F.lit("")).when(F.col("_drawn") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    return rows.select(
        key, turn, F.when(F.col("_drawn") == 4, F.lit("user")).otherwise(F.col(role)).alias(role), harmed.alias(text),
        F.explode(F.when(F.col("_drawn") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def audit_damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`audit` of the damaged rows for every key of `rows`, also for those that lost all rows."""
    found = audit(damage(rows, key, turn, role, text), key, turn, role, text)
    every = rows.select(F.col(key).alias("_every")).distinct()
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in found.columns[1:7]]
    nothing = hashlib.sha256().hexdigest()
    return every.join(found, F.col("_every").eqNullSafe(F.col(key)), "left").select(
        F.col("_every").alias(key), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
