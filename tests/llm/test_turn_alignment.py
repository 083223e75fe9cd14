"""Conversation repair against an automaton that tries every edit, row by row."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from supplyprep.llm import turn_alignment as ta

STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
BLANK = re.compile("[^\x20\x09-\x0d]")


def cheapest(rows):
    """Least (cost, audit, repaired) over all edits; rows: role, text, cut off, must go."""

    def relaxed(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    put(best, STEPS.get((state, role[0])), (cost + 3, audit + "I", (*lines, f"{role}:")))
        return best

    def put(best, state, option):
        if state is not None and (state not in best or option[:2] < best[state][:2]):
            best[state] = option

    best = relaxed({0: (0, "", ())})
    for role, text, cut, gone in rows:
        fresh = {}
        for state, (cost, audit, lines) in best.items():
            put(fresh, state, (cost + 4, audit + "D", lines))
            if not gone:
                put(fresh, STEPS.get((state, role[:1])), (cost + 3 * cut, audit + "K", (*lines, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    put(fresh, STEPS.get((state, other[0])), (cost + 3 * cut + 3, audit + "R", (*lines, f"{other}:{text}")))
        best = relaxed(fresh)
    return min((best[s] for s in (0, 3) if s in best), key=lambda o: o[:2])


def expected(rows):
    """What the contract asks for, one conversation after the other; rows: conv, turn, role, text."""
    convs = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        mark = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if mark == 1 else re.sub("[.!?]", "", text) if mark == 2 else text
        held += [(turn, "user" if mark == 4 else role, text)] * (0 if mark == 0 else 2 if mark == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        blank = duplicate = truncated = 0
        seen, marked = set(), []
        for _, role, text in held:
            shown = BLANK.findall(text)
            is_blank = not shown
            again = (role, text) in seen and not is_blank
            cut = not is_blank and not again and shown[-1] not in ".!?"
            seen.add((role, text))
            blank, duplicate, truncated = blank + is_blank, duplicate + again, truncated + cut
            marked.append((role, text, cut, is_blank or again))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:], strict=False))
        cost, audit, lines = cheapest(marked)
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df, segment=ta.SEGMENT):
    rows = ta.digests(ta.repair(ta.damaged(df), times="times", segment=segment)).collect()
    found = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}
    assert len(found) == len(rows)
    return found


SCHEMA = "conv_id long, turn long, role string, text string"


def noisy(seed, conversations, longest):
    chosen = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turn = 0
        for _ in range(chosen.choice([1, 2, 3, 5, 8, longest])):
            turn += chosen.choice([1, 1, 1, 2, 5])
            role = chosen.choice(["user", "assistant"] * 6 + ["system", "tool", "", None])
            text = chosen.choice(["Yes.", "No", "", " \t", None, "Why?", "because", f"Point {turn}.", f"Point {turn}", "é…", "ok.\u0085", "end. \n"])
            rows.append((conv, turn if chosen.random() > 0.05 else None, role, text))
    return rows


@pytest.mark.parametrize("segment", [64, 1, 3])
def test_equals_the_automaton(spark, segment):
    rows = noisy(segment, 60, 150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert repaired(df, segment) == expected(rows)


def test_given_conversations(spark, data):
    df = spark.read.parquet(f"{data}/conversations.parquet")
    assert repaired(df) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_one_long_conversation_and_null_ids(spark):
    chosen = random.Random(9)
    long = [(7, t, "user" if t % 2 else "assistant", "Same words." if t % 3 else f"Turn {t}.") for t in range(900)]
    rows = long + [(None, t, "user", f"n {t}") for t in (3, None, 3, 9)] + [(1, None, None, None), (2, 1 << 40, "system", "Be kind.")]
    rows += [(4, 1, "user", "Again and again.")] * 40
    chosen.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6).selectExpr("*", "'own' AS edit", "1 AS place", "2 AS times", "'x' AS conv", "5 AS part")
    assert repaired(df) == expected(rows)


def test_edits_are_the_repaired_conversation(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi"), (1, 2, "user", "Hi"), (1, 3, "tool", "Fine.")]
    edits = ta.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    assert [r["edit"] for r in edits] == [None, "I", "K", "K", "D", "R"]
    assert [(r["role"], r["text"]) for r in edits if r["edit"] not in (None, "D")] == [("user", ""), ("assistant", "Hello."), ("user", "Hi"), ("assistant", "Fine.")]
    assert edits[0]["cost"] == 3 + 3 + 4 + 3


def test_empty_and_all_dropped(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)) == {}
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert repaired(spark.createDataFrame([(5, gone, "user", "x")], SCHEMA)) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
