"""Conversation repair against an enumeration of all edits and a plain dynamic program."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from premia.llm import repair

COLUMNS = "conv_id long, turn long, role string, text string"
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def enumerated(turns):
    """The smallest (cost, audit) over all ways to edit, with at most four insertions."""
    best = None
    choices = [("D",) if fault in ("blank", "duplicate") else ("K", "Ru", "Ra", "D") for _, fault in turns]
    for edits in itertools.product(*choices):
        for slots in itertools.product(("", "u", "a", "ua", "au"), repeat=len(turns) + 1):
            roles, audit, cost = "", "", 0
            for n, slot in enumerate(slots):
                roles, audit, cost = roles + slot, audit + "I" * len(slot), cost + 2 * len(slot)
                if n < len(turns):
                    edit, (initial, fault) = edits[n], turns[n]
                    roles += {"K": initial, "D": ""}.get(edit, edit[-1])
                    audit += edit[0]
                    cost += {"K": 0, "D": 3}.get(edit, 2) + (fault == "truncated" and edit != "D")
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def planned(turns):
    """The same by a dynamic program over (turn, last role)."""
    ways = {0: (0, "")}

    def inserted(ways):
        for _ in range(3):
            for (state, role), after in STEPS.items():
                if role in "ua" and state in ways:
                    ways[after] = min(ways.get(after, (10**9, "")), (ways[state][0] + 2, ways[state][1] + "I"))
        return ways

    for initial, fault in turns:
        after = {}
        for state, (cost, audit) in inserted(ways).items():
            options = [(state, 3, "D")]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                options += [(STEPS[state, r], more + 2, "R") for r in "ua" if (state, r) in STEPS]
                options += [(STEPS[state, initial], more, "K")] if (state, initial) in STEPS else []
            for to, price, edit in options:
                after[to] = min(after.get(to, (10**9, "")), (cost + price, audit + edit))
        ways = after
    return min(w for s, w in inserted(ways).items() if s in (0, 3))


def plain(rows):
    """A whole conversation: rows of (turn, role, text)."""
    spaces = " \t\n\x0b\x0c\r"
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    turns, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(spaces)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        turns.append((role[:1], fault))
    cost, audit = planned(turns)
    left, lines, at = [r[1:] for r in rows], [], 0
    wanted = "user"
    for edit in audit:
        role, text = left[at] if edit != "I" else ("", "")
        at += edit != "I"
        if edit != "D":
            role = role if edit == "K" else wanted
            wanted = "assistant" if role[:1] == "u" else "user"
            lines.append(f"{role}:{text}")
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    faults = [f for _, f in turns]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        out[conv] = plain([r[1:] for r in rows if r[0] == conv])
    return out


def ours(frame, **options):
    return {r["conv_id"]: tuple(r)[1:] for r in repair.repair(frame, **options).collect()}


@pytest.mark.parametrize("size", [0, 1, 2, 3])
def test_cheapest_edits_equal_enumeration(size):
    table = repair.RoleTable(repair.GRAMMAR)
    letters = [("s", ""), ("u", ""), ("a", ""), ("x", ""), ("u", "truncated"), ("a", "blank"), ("u", "duplicate")]
    cases = list(itertools.product(letters, repeat=size))
    for turns in random.Random(size).sample(cases, min(len(cases), 60)):
        found = repair.accepted(repair.parse(turns, table), table)
        assert found == enumerated(turns) == planned(turns)


def test_parts_make_the_whole():
    table = repair.RoleTable(repair.GRAMMAR)
    rng = random.Random(5)
    for _ in range(20):
        turns = [(rng.choice("suax"), rng.choice(["", "", "truncated", "blank"])) for _ in range(30)]
        ways = {(0,): (0, "")}
        for at in range(0, 30, 7):
            ways = repair.chained(ways, {e: repair.parse(turns[at : at + 7], table, e) for e in table.stacks})
        assert repair.accepted(ways, table) == planned(turns)


def test_grammar_of_unbounded_stacks_is_refused():
    with pytest.raises(ValueError):
        repair.RoleTable((("S", "P"), ("P", "uPa"), ("P", "ua")))


def conversations():
    rng = random.Random(3)
    texts = ["Yes.", "No!", "why", "", " \t", "Well?", "Über.", "x" * 3000 + "."]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User"]), rng.choice(texts)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(50, None, "user", "a."), (50, None, "user", "a."), (50, 3, None, None), (50, 3, "user", "b."), (50, 3, "assistant", "b."), (50, 9, "user", None)]
    rows += [(None, 1, "user", "q?"), (None, 2, "assistant", "r."), (None, None, "system", "s.")]
    return rows


def test_table_equals_brute_force(llm_spark):
    rows = conversations()
    frame = llm_spark.createDataFrame(rows, COLUMNS)
    assert ours(frame) == brute(rows)
    clashing = frame.withColumns({c: F.lit("own") for c in ("kind", "key", "audit", "fault", "copies", "part", "whole", "place")})
    assert ours(clashing.repartition(7)) == brute(rows)


def test_a_long_conversation_is_spread_over_tasks(llm_spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 64)
    rng = random.Random(8)
    rows = [(7, t // 2 if t % 5 else None, rng.choice(["user", "assistant", "system"]), f"{rng.choice(['hm', 'so.', ''])}{t % 900}{rng.choice(['.', '?', ''])}") for t in range(3000)]
    rows += [(1, 0, "user", "a."), (9, 0, "assistant", "b.")]
    assert ours(llm_spark.createDataFrame(rows, COLUMNS)) == brute(rows)


def test_no_turns(llm_spark):
    assert ours(llm_spark.createDataFrame([], COLUMNS)) == {}
    listed = llm_spark.createDataFrame([(1,), (None,)], "conv_id long")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert ours(llm_spark.createDataFrame([], COLUMNS), conversations=listed) == {1: empty, None: empty}


def test_damage(llm_spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two?") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    out = sorted(map(tuple, repair.damage(llm_spark.createDataFrame(rows, COLUMNS)).collect()), key=str)
    expected = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault:
            row = (c, t, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
            expected += [row] * (2 if fault == 3 else 1)
    assert out == sorted(expected, key=str)


def test_repaired_turns_have_texts(llm_spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "user", "Hi."), (2, 0, "assistant", "Lost.")]
    frame = llm_spark.createDataFrame(rows, COLUMNS)
    turns = repair.repaired_turns(frame, repair.summaries(frame)).orderBy("conv_id", "place").collect()
    assert [tuple(r)[1:] for r in turns if r["conv_id"] == 1] == [(0, "user", "Hi.", "K"), (1, "assistant", "There.", "R")]
    assert [tuple(r)[1:] for r in turns if r["conv_id"] == 2] == [(0, "user", "", "I"), (1, "assistant", "Lost.", "K")]
