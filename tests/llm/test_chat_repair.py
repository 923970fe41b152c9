"""Operator 12 against all ways to edit, and its rows on nulls, ties, repeats and empty tables."""

import random
from functools import lru_cache

import pytest

from stakeflow.llm import chat_repair
from tests.llm.test_llm_operators import empty

TURNS = "conv_id long, turn long, role string, text string, audit string, cost int"


def cheapest(initials, gone, cut):
    """The least (cost, audit) by trying every edit."""

    @lru_cache(None)
    def best(i, state, put_in=True):
        after = {"start": "a", "system": "a", "u": "a", "a": "u"}[state]
        want = "a" if state == "a" else "u"
        found = []
        if i == len(initials):
            if state in ("start", "u"):
                found.append((0, ""))
        else:
            cost, audit = best(i + 1, state)
            found.append((cost + 3, "D" + audit))
            if not gone[i]:
                cost, audit = best(i + 1, after)
                keep = initials[i] == want
                found.append((cost + cut[i] + (0 if keep else 2), ("K" if keep else "R") + audit))
                if state == "start" and initials[i] == "s":
                    cost, audit = best(i + 1, "system")
                    found.append((cost + cut[i], "K" + audit))
        if put_in:
            cost, audit = best(i, after, i == len(initials) and after == "a")
            found.append((cost + 2, "I" + audit))
        return min(found, default=(10**9, ""))

    return best(0, "start")


@pytest.mark.parametrize("held", [8_000_000, 12])
def test_alignment_is_the_cheapest_of_all_edits(monkeypatch, held):
    monkeypatch.setattr(chat_repair, "HELD_CELLS", held)
    r = random.Random(3)
    for _ in range(1500):
        initials = [r.choice("suuaax") if r.random() < 0.9 else "" for _ in range(r.randint(0, 8))]
        gone = [r.random() < 0.15 for _ in initials]
        cut = [not g and r.random() < 0.2 for g in gone]
        assert chat_repair.Alignment(initials, gone, cut).audit() == cheapest(tuple(initials), tuple(gone), tuple(cut)), (initials, gone, cut)


def test_long_conversation_held_in_parts_is_the_same():
    r = random.Random(9)
    initials = [r.choice("ua") if r.random() < 0.3 else "ua"[i % 2] for i in range(500)]
    gone = [r.random() < 0.1 for _ in initials]
    whole = chat_repair.Alignment(initials, gone, [False] * 500)
    assert whole.band < 250 and whole.audit()[0] == cheapest(tuple(initials), tuple(gone), (False,) * 500)[0]


def test_rows_of_odd_conversations(spark):
    rows = [
        (None, None, None, None, "x", 1), (None, 0, "user", "Is it.", "x", 1),  # a null conversation with a blank turn
        (1, 0, "user", "A.", "x", 1), (1, 0, "user", "A.", "x", 1), (1, 2, "assistant", "b" * 100_000, "x", 1),  # a repeated row, a gap, a cut text
        (2, 0, "assistant", "Yes.", "x", 1), (2, 0, "assistant", "No.", "x", 1),  # equal turns
        (3, 5, "tool", "\t\n", "x", 1), (4, None, "system", "S.", "x", 1),
        (5, 1, "", " x. \x0b", "x", 1),
    ]
    got = {r.conv_id: r for r in chat_repair.repair(spark.createDataFrame(rows, TURNS)).collect()}
    assert (got[None].blank, got[None].gaps, got[None].audit, got[None].cost) == (1, 0, "DKI", 5)
    assert (got[1].duplicate, got[1].truncated, got[1].gaps, got[1].audit, got[1].cost) == (1, 1, 1, "KDK", 4)
    assert [t.role for t in got[1].repaired] == ["user", "assistant"] and len(got[1].repaired[1].text) == 100_000
    assert (got[2].audit, got[2].cost, [t.text for t in got[2].repaired], got[2].illegal) == ("RK", 2, ["No.", "Yes."], 1)
    assert (got[3].audit, got[3].repaired, got[4].audit, got[4].cost) == ("D", [], "D", 3)
    assert (got[5].audit, [t.role for t in got[5].repaired]) == ("D", []) and got[5].cost == 3
    assert chat_repair.repair(empty(spark).selectExpr("doc_id as conv_id", "doc_id as turn", "key as role", "text")).count() == 0


def test_damage_keeps_each_conversation(spark):
    turns = spark.createDataFrame([(i, 0, "assistant", "One. Two!", "x", 1) for i in range(400)], TURNS)
    got = chat_repair.damaged(turns).collect()
    kinds = {"gone": sum(r.dropped for r in got), "empty": sum(r.text == "" for r in got), "bare": sum(r.text == "One Two" for r in got), "user": sum(r.role == "user" for r in got), "more": len(got) - 400}
    assert all(5 < n < 45 for n in kinds.values()), kinds
    found = chat_repair.repair(chat_repair.damaged(turns).select("*"), chat_repair.F.col("dropped")).collect()
    assert len(found) == 400 and sum(r.n_turns == 0 for r in found) == kinds["gone"] and all(r.audit == "" and r.cost == 0 for r in found if r.n_turns == 0)
