"""Repairs against all edits tried one by one, and whole results against a plain loop."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from almanac.llm import conversation_repair as cr

PATTERN = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, key string, digest int, later int, place int"


def all_edits(rows):
    """(cost, audit, roles) of every way to edit [(initial, fault)], up to two inserts in a gap; roles by initial."""
    gaps = [(2 * n, "I" * n, list(added)) for n in range(3) for added in itertools.product("ua", repeat=n)]
    paths = [(c, a, r) for c, a, r in gaps]
    for initial, fault in rows:
        own = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            left = int(fault == "truncated")
            own += [(left, "K", [initial]), (2 + left, "R", ["u"]), (2 + left, "R", ["a"])]
        paths = [(c + d + e, a + b + g, r + s + t) for c, a, r in paths for d, b, s in own for e, g, t in gaps]
    return paths


@pytest.mark.parametrize("rows", [list(r) for n in range(3) for r in itertools.product(
    [(i, f) for i in "suax" for f in ("", "blank", "truncated")], repeat=n)])
def test_cheapest_of_all_edits(rows):
    best = min((c, a) for c, a, r in all_edits(rows) if PATTERN.fullmatch("".join(r)))
    assert cr.cheapest(bytes("suax".index(i) + 4 * cr.FAULTS.index(f) for i, f in rows)) == best


def test_cheapest_of_all_edits_of_three_rows():
    pick = random.Random(3)
    for _ in range(12):
        rows = [(pick.choice("ssuuaax"), pick.choice(["", "", "truncated", "duplicate"])) for _ in range(3)]
        best = min((c, a) for c, a, r in all_edits(rows) if PATTERN.fullmatch("".join(r)))
        assert cr.cheapest(bytes("suax".index(i) + 4 * cr.FAULTS.index(f) for i, f in rows)) == best


def least(rows):
    """The same for longer conversations: least (cost, audit) per state, as numbers and strings."""
    states = {"": (0, "")}  # by the last role put out

    def reach(found, state, word):
        found[state] = min(found.get(state, word), word)

    def inserted(states):
        found = dict(states)
        for _ in range(2):
            for state, (cost, audit) in list(found.items()):
                reach(found, "a" if state == "u" else "u", (cost + 2, audit + "I"))
        return found

    for initial, fault in rows:
        found = {}
        for state, (cost, audit) in inserted(states).items():
            follows = "a" if state == "u" else "u"
            left = int(fault == "truncated")
            reach(found, state, (cost + 3, audit + "D"))
            if fault not in ("blank", "duplicate"):
                reach(found, follows, (cost + 2 + left, audit + "R"))
                if initial == follows or initial == "s" and state == "":
                    reach(found, initial, (cost + left, audit + "K"))
        states = found
    done = inserted(states)
    return min(done[s] for s in ("", "a") if s in done)


@pytest.mark.parametrize("n, block", [(5, 1), (40, 3), (300, 7), (700, 256), (1000, 256)])
def test_long_conversations_in_blocks(n, block):
    for seed in range(6):
        pick = random.Random(seed * 1000 + n)
        rows = [(pick.choice("suauauax"), pick.choice(["", "", "", "truncated", "duplicate", "blank"])) for _ in range(n)]
        path = cr.Path(block)
        for i, f in rows:
            path.add("suax".index(i) + 4 * cr.FAULTS.index(f))
        assert path.close() == least(rows)


def test_a_hundred_thousand_rows_are_seconds():
    kinds = bytes(random.Random(1).choices(range(16), k=100_000))
    cost, audit = cr.cheapest(kinds)
    assert len(audit) >= len(kinds) and cost > 0


def plain(rows, harm=True):
    """The whole result by a loop; rows are (conv_id, turn, role, text)."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        own = talks[conv]
        role, text = " " if role is None else role, " " if text is None else text
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harm else 9
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        own += [(turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    out, turns_of = [], {}
    for conv, own in talks.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for turn, role, text in own:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role[:1], fault))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = least(marked)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        left, last, turns = iter(own), "", []
        for edit in audit:
            follows = {"u": "assistant"}.get(last, "user")
            if edit == "I":
                turns.append((follows, ""))
            else:
                _, role, text = next(left)
                if edit == "D":
                    continue
                turns.append((role if edit == "K" else follows, text))
            last = turns[-1][0][0]
        assert PATTERN.fullmatch("".join(r[0] for r, _ in turns)) and next(left, None) is None
        faults = [sum(f == name for _, f in marked) for name in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out.append((conv, gaps, *faults, illegal, cost, audit, digest))
        turns_of[conv] = turns
    return sorted(out, key=str), turns_of


def odd_rows():
    pick = random.Random(5)
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (2, None, "user", None), (2, None, None, "What?"),
        (2, 5, "tool", "x.\n\t "), (3, 0, "user", "a."), (3, 0, "user", "a."), (3, 0, "user", "b."), (3, 0, "assistant", "a."), (4, 3, "", "."),
        (None, 1, "user", "who?"), (None, 2, "assistant", "é…"), (5, 0, "assistant", "wörter " * 30_000 + "."), (6, None, "user", ""), (7, 9, None, None),
        (8, -5, "user", "one."), (8, 5, "assistant", "two."), (8, 5, "assistant", "two."), (9, 0, "system", "only."),
    ]
    rows += [(c, t, pick.choice(["user", "assistant", "assistant", "system", "User"]), pick.choice(["Yes.", "No!", "why", " ", "So?\n", "é"]))
             for c in range(20, 60) for t in range(pick.randrange(9))]
    rows += [(99, t, "ua"[t % 2].replace("u", "user").replace("a", "assistant"), f"{t % 50}.") for t in range(700)]  # one long conversation
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    rows = [(*r, "k", 1, 2, 3) for r in odd_rows()]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_odd_conversations(talks):
    got = cr.audit(talks)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(odd_rows(), harm=False)[0]


def test_damaged_conversations(talks):
    assert sorted(map(tuple, cr.audit_damaged(talks).collect()), key=str) == plain(odd_rows())[0]


def test_repaired_turns(talks):
    _, want = plain(odd_rows(), harm=False)
    got = defaultdict(list)
    for r in cr.repair(talks).orderBy("place").collect():
        got[r.conv_id].append((r.role, r.text))
        assert r.place == len(got[r.conv_id]) and r.edit in "KRI"
    assert got == {c: t for c, t in want.items() if t}


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, cr.audit_damaged(table).collect()), key=str) == plain(rows)[0]


def test_empty_table(spark, talks):
    nothing = talks.limit(0)
    assert cr.audit(nothing).count() == cr.audit_damaged(nothing).count() == cr.repair(nothing).count() == 0
