"""Conversation repair against a plain recursion over all edits."""

import hashlib
import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

repair = pytest.importorskip("playlog.llm.repair")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(turns):
    """(cost, edits) of (initial, fault) turns by trying everything; never more than three insertions in a row."""

    @cache
    def best(k, sofar, inserted):
        ways = []
        due = "a" if sofar == "u" else "u"
        if inserted < 3:
            c, e = best(k, due, inserted + 1)
            ways.append((c + 5, "I" + e))
        if k == len(turns):
            if sofar in ("", "a"):
                ways.append((0, ""))
            return min(ways, default=(10**9, ""))
        role, fault = turns[k]
        c, e = best(k + 1, sofar, 0)
        ways.append((c + 2, "D" + e))
        if fault != 1:
            more = 5 if fault == 2 else 0
            c, e = best(k + 1, due, 0)
            ways.append((c + 1 + more, "R" + e))
            if role == due or role == "s" and sofar == "":
                c, e = best(k + 1, role, 0)
                ways.append((c + more, "K" + e))
        return min(ways)

    return best(0, "", 0)


TURNS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "u", "a", "x", ""]), st.sampled_from([0, 0, 0, 1, 2])), max_size=12)


@settings(max_examples=400, deadline=None)
@given(TURNS, st.sampled_from([1, 2, 3, 5, 512]))
def test_search_in_pieces_finds_the_least(turns, piece):
    plan = repair.Plan(piece)
    for role, fault in turns:
        plan.add(role, fault)
    assert plan.edits() == cheapest(tuple(turns))


def test_a_long_conversation():
    plan, n = repair.Plan(), 40_000
    for k in range(n):
        plan.add("ua"[k % 2] if k % 1000 else "x", 0 if k % 777 else 2)
    cost, edits = plan.edits()
    assert len(edits.replace("I", "")) == n and cost > 0
    assert re.fullmatch("s?(ua)*", "".join(role[:1] for role, _ in repair.edited(edits, (("ua"[k % 2] if k % 1000 else "x", "t") for k in range(n)))))


def slow(rows):
    """The contract's row of one conversation, from (conv_id, turn, role, text)."""
    after = []
    for conv, turn, role, text in rows:
        conv, number, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        what = zlib.crc32(f"{conv}:{number}".encode()) % 20
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        after += [(turn, "user" if what == 4 else role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in after:
        bare = text.rstrip(BLANK)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    numbers = {t for t, _, _ in after if t is not None}
    cost, audit = cheapest(tuple((role[:1], {"": 0, "truncated": 2}.get(f, 1)) for (_, role, _), f in zip(after, faults, strict=True)))
    left, rest, due = [], iter(after), 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rest)[1:]
        if edit != "D":
            role = role if edit == "K" else ("user", "assistant")[due]
            left.append(f"{role}:{text}")
            due = 1 if role[:1] == "u" else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(after, after[1:], strict=False)]
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()


def rows():
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None], ["Good.", "Cut off", "Ends! \n", " \t", "", None, "Why?", "日本語。", "Same."]
    out = []
    for conv in [*range(120), None, -3]:
        for turn in range((conv or 3) % 9 + 1 if conv != -3 else 700):
            k = (conv or 0) * 31 + turn * 7
            out.append((conv, None if k % 23 == 0 else turn + (turn > 4) * 3, roles[(k * k + turn) % 8 if k % 3 == 0 else 1 + turn % 2], texts[(k * 5 + turn * turn) % 9 if k % 2 else 0] if k % 4 else f"Turn {k}."))
    return out + [(7, 1, "user", "Again."), (7, 1, "user", "Again."), (900, None, None, None), (901, 5, "user", "x" * 300_000 + ".")]


def test_query_rows(spark):
    given_rows = rows()
    df = spark.createDataFrame(given_rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("digest", "there", "audit", "is_turn", "cost", "blank", "repeated")})
    out = {r.conv_id: tuple(r)[1:] for r in repair.summarised(repair.damaged(df)).collect()}
    own = {}
    for r in given_rows:
        own.setdefault(r[0], []).append(r)
    assert len(out) == len(own)
    for conv, turns in own.items():
        if conv != -3:
            assert out[conv] == slow(turns), conv
    assert len(out[-3][-2].replace("I", "")) > 512  # a conversation of several pieces
    assert repair.summarised(repair.damaged(df.limit(0))).count() == 0


def test_repaired_turns(spark):
    df = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 0, "system", "Be kind."), (1, 2, "user", "Hello?"), (1, 3, "assistant", "Yes."), (2, 0, "tool", "What?"), (2, 1, "assistant", "That."), (3, 0, "user", " ")], "conv_id long, turn long, role string, text string")
    turns = repair.as_turns(df)
    assert sorted(tuple(r) for r in repair.repaired(turns).collect()) == [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Yes."), (2, 0, "user", "What?"), (2, 1, "assistant", "That.")]
    assert {r.conv_id: (r.cost, r.audit) for r in repair.plans(turns).collect()} == {1: (2, "KDKK"), 2: (1, "RK"), 3: (2, "D")}
    assert repair.repaired(turns.limit(0)).count() == 0
