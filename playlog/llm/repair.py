"""Repair of conversations: the cheapest edits that leave an optional system turn and then pairs of user and assistant.

A conversation's turns have at most one fault each: blank, duplicate (role and text as an earlier turn), or truncated
(it doesn't end a sentence). A turn is kept (0), given the role of user or assistant (1), or deleted (2, which blank
and duplicate turns must be); an empty turn can be inserted anywhere (5); a truncated turn that stays costs 5 more. The
edits of least cost are found by A* on the lattice of (turns passed, role that is due): each turn ahead that must go,
and each truncated one, costs at least a deletion, and the sums of these from the end make the heuristic. Nodes are
taken by (cost and heuristic, edits so far), so that the first goal has the ASCII-least edits of the cheapest.

Long conversations are searched in pieces of ``PIECE`` turns, from each role that may be due to each that may be due
next, and the pieces' results are joined from the end; a node's edits never grow beyond a piece, and a conversation
costs its task some twenty bytes a turn. Turns are shuffled by conversation and pass a task in order, as Spark sorts
them; neither they nor their texts are gathered: once for the faults, as digests, and once behind their edits.

Turns go by turn number, nulls first; equal ones by role, then by the digest of the text. Defined results: nulls in any
column are one space; conversations without turns left have no edits; a null conversation is one of its own;
equal rows are duplicates of each other; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_BYTES, BATCH_ROWS, map_arrow

#: Turns of a piece of a long conversation.
PIECE = 512
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: Characters that end a sentence, and blank ones.
SENTENCE_ENDS, BLANKS = ".!?", " \t\n\x0b\x0c\r"
#: Faults of a turn.
SOUND, GOES, TRUNCATED = range(3)

# What is left so far: nothing, a system turn, up to a user turn, whole pairs.
NONE, SYSTEM, USER, PAIRS = range(4)
_KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (PAIRS, "u"): USER, (USER, "a"): PAIRS}
#: What follows when a turn is given the role that is due, and that role.
_FILLED = {NONE: USER, SYSTEM: USER, PAIRS: USER, USER: PAIRS}
_DUE = {NONE: "user", SYSTEM: "user", PAIRS: "user", USER: "assistant"}
_ENDS = (NONE, PAIRS)
_LEGAL = {"su", "ua", "au"}

Turn = tuple[str, int]


def search(turns: list[Turn], start: int, goals: Iterable[int], last: bool) -> dict[int, tuple[int, str]]:
    """The least (cost, edits) from ``start`` to each of ``goals`` that can be reached over (role's initial, fault) turns.

    The first goal reached comes first. Only the last piece takes insertions behind its turns: those before a turn
    belong to the turn's piece, so that each way through a conversation is one way through its pieces.
    """
    n, goals = len(turns), set(goals)
    ahead = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        ahead[k] = ahead[k + 1] + (min(COST[DELETE], TRUNCATED_COST) if turns[k][1] else 0)
    heap, settled, found = [(ahead[0], "", 0, start)], set(), {}
    while heap and len(found) < len(goals):
        bound, edits, k, state = heappop(heap)
        if (k, state) in settled:
            continue
        settled.add((k, state))
        cost = bound - ahead[k]
        if k == n and state in goals:
            found[state] = (cost, edits)
        if k == n and not last:
            continue
        steps = [(INSERT, k, _FILLED[state], 0)]
        if k < n:
            role, fault = turns[k]
            steps.append((DELETE, k + 1, state, 0))
            if fault != GOES:
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                steps.append((REROLE, k + 1, _FILLED[state], more))
                if (state, role) in _KEPT:
                    steps.append((KEEP, k + 1, _KEPT[state, role], more))
        for edit, to, then, more in steps:
            if (to, then) not in settled:
                heappush(heap, (cost + COST[edit] + more + ahead[to], edits + edit, to, then))
    return found


class Plan:
    """The search over turns that come one by one."""

    def __init__(self, piece: int = PIECE):
        self.piece, self.turns, self.ways = piece, [], []

    def _search(self, last: bool) -> None:
        starts = range(4) if self.ways else (NONE,)
        self.ways.append({s: search(self.turns, s, _ENDS if last else range(4), last) for s in starts})
        self.turns = []

    def add(self, role: str, fault: int) -> None:
        if len(self.turns) == self.piece:
            self._search(last=False)
        self.turns.append((role[:1], fault))

    def edits(self) -> tuple[int, str]:
        """(cost, edits) of the whole."""
        self._search(last=True)
        rest = dict.fromkeys(_ENDS, 0)
        onward = []
        for ways in reversed(self.ways):
            sums = {s: {t: cost + rest[t] for t, (cost, _) in own.items() if t in rest} for s, own in ways.items()}
            onward.append(sums)
            rest = {s: min(own.values()) for s, own in sums.items() if own}
        state, edits = NONE, []
        for ways, sums in zip(self.ways, reversed(onward), strict=True):
            least = min(sums[state].values())
            edit, state = min((ways[state][t][1], t) for t, c in sums[state].items() if c == least)
            edits.append(edit)
        return rest[NONE], "".join(edits)


def edited(edits: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) after the edits, one turn at a time."""
    state = NONE
    for edit in edits:
        if edit == INSERT:
            yield _DUE[state], ""
            state = _FILLED[state]
            continue
        role, text = next(turns)
        if edit == REROLE:
            yield _DUE[state], text
            state = _FILLED[state]
        elif edit == KEEP:
            yield role, text
            state = _KEPT[state, role[:1]]


def _spaced(name: str, kind: str = "string") -> Column:
    return F.coalesce(F.col(name).cast(kind), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there) with faults put in by a digest of conv_id and turn, to try repairs on.

    Of twenty values one drops the turn (``there`` is false), one empties its text, one takes its sentence ends, one
    repeats it behind itself, and one gives it to the user.
    """
    what = F.crc32(F.concat_ws(":", _spaced("conv_id"), _spaced("turn")).cast("binary")) % 20
    text, role = _spaced("text"), _spaced("role")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(what == 4, "user").otherwise(role).alias("role"),
        F.when(what == 1, "").when(what == 2, F.regexp_replace(text, f"[{SENTENCE_ENDS}]", "")).otherwise(text).alias("text"),
        (what != 0).alias("there"),
        F.explode(F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    )
    return rows.drop("__copy")


def as_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there) of a table as it is."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _spaced("role").alias("role"), _spaced("text").alias("text"), F.lit(True).alias("there"))


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


#: What is known of a conversation before its turns are edited.
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLAN_SCHEMA = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
_PLAN = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of PLAN_SCHEMA for each conversation of the sorted turns."""
    faults = ("blank", "duplicate", "truncated", "illegal")
    own, out = None, []

    def done(own: dict) -> dict:
        plan, numbers = own.pop("plan"), own.pop("numbers")
        own["cost"], own["audit"] = plan.edits() if own["before"] is not None else (0, "")
        own["gaps"] = own["most"] - own["least"] + 1 - numbers if numbers else 0
        return own

    for batch in batches:
        names = ("conv_id", "there", "turn", "role", "blank", "repeated", "ends")
        for conv, there, turn, role, blank, repeated, ends in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
            if own is None or conv != own["conv_id"]:
                if own:
                    out.append(done(own))
                own = {"conv_id": conv, "numbers": 0, "least": None, "most": None, "before": None, "plan": Plan()} | dict.fromkeys(faults, 0)
            if not there:
                continue
            if turn is not None and turn != own["most"]:  # sorted, so another number is a new one
                own["numbers"] += 1
                own["least"], own["most"] = turn if own["least"] is None else own["least"], turn
            fault = "blank" if blank else "duplicate" if repeated else "truncated" if not ends else None
            if fault:
                own[fault] += 1
            if own["before"] is not None and own["before"] + role[:1] not in _LEGAL:
                own["illegal"] += 1
            own["before"] = role[:1]
            own["plan"].add(role, SOUND if fault is None else TRUNCATED if fault == "truncated" else GOES)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_PLAN)
            out = []
    if own:
        yield pa.RecordBatch.from_pylist([done(own)], schema=_PLAN)


def plans(turns: DataFrame) -> DataFrame:
    """For each conversation its counts of faults, the least cost, and the edits' initials; ``turns`` as ``damaged`` or ``as_turns`` give them."""
    text = F.col("text")
    bare = F.rtrim(text, F.lit(BLANKS))
    compact = turns.select("conv_id", "turn", "role", "there", F.sha2(text.cast("binary"), 256).alias("digest"), (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(*SENTENCE_ENDS).alias("ends"))
    same = Window.partitionBy("conv_id", "there", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    marked = compact.repartition("conv_id").withColumn("repeated", F.row_number().over(same) > 1)
    return map_arrow(marked.sortWithinPartitions(F.asc_nulls_first("conv_id"), *_order(), "repeated"), _planned, PLAN_SCHEMA)


def _behind_plans(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """Each conversation's plan, and then its turns in order, within one partition."""
    rows = turns.filter("there").select("conv_id", "turn", "role", "text", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.lit(True).alias("is_turn"))
    both = planned.withColumn("is_turn", F.lit(False)).unionByName(rows, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "is_turn", *_order())


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """(plan, repaired turns) of one conversation after another, each used up before the next one is asked for."""
    source = (row for batch in batches for row in batch.to_pylist())
    plan = next(source, None)

    def turns() -> Iterator[tuple[str, str]]:
        nonlocal plan
        for row in source:
            if not row["is_turn"]:
                plan = row
                return
            yield row["role"], row["text"]
        plan = None

    while plan is not None:
        own = turns()
        yield plan, edited(plan["audit"], own)
        for _ in own:  # the next plan stands behind the last turn
            pass


def repaired(turns: DataFrame, planned: DataFrame | None = None) -> DataFrame:
    """(conv_id, position, role, text): the turns that are left, reroled or inserted, in order from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        out, held = [], 0
        for plan, left in _conversations(batches):
            for k, (role, text) in enumerate(left):
                out.append({"conv_id": plan["conv_id"], "position": k, "role": role, "text": text})
                held += len(text)
                if len(out) == BATCH_ROWS or held > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return map_arrow(_behind_plans(turns, plans(turns) if planned is None else planned), run, "conv_id long, position long, role string, text string")


def summarised(turns: DataFrame) -> DataFrame:
    """A row for each conversation: its plan, and the digest of its repaired turns as ``role:text`` lines, which are hashed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, held = _PLAN.append(pa.field("repaired_sha256", pa.string())), [], 0
        for plan, left in _conversations(batches):
            digest = hashlib.sha256()
            for k, (role, text) in enumerate(left):
                digest.update(f"{chr(10) if k else ''}{role}:{text}".encode())
            out.append({c: plan[c] for c in _PLAN.names} | {"repaired_sha256": digest.hexdigest()})
            held += len(plan["audit"])
            if len(out) == BATCH_ROWS or held > BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return map_arrow(_behind_plans(turns, plans(turns)), run, f"{PLAN_SCHEMA}, repaired_sha256 string")
