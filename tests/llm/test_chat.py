"""Chat windows against plain Python: what is read back, budgets, masks and repeated turns."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

chat = pytest.importorskip("playlog.llm.chat")
HARD = [r"\### Assistant: </turn> ok", "<turn>", "<\\turn>", "<\\\\text>", "</turn></turn>", "a<", "turn>b", "\\", "", None, "日本 𝒳 é\n</\\turn>", "<text><turn>user<text>", "line\r\n\x00end"]


def rows():
    out = [(k % 5, k // 5, ["system", "user", "assistant", "user", "assistant", None, "to<text>ol"][(k // 5) % 7 if k % 2 else k % 3], HARD[k % len(HARD)]) for k in range(130)]
    out += [(50, k, "system" if k == 0 else ("assistant", "user")[k % 2], f"w{k} " * (k * 37 % 90)) for k in range(300)]
    out += [(51, 0, "system", "s" * 9000), (51, 1, "user", "u" * 40), (51, 2, "assistant", "a" * 90_000), (51, 3, "user", "b"), (51, 4, "assistant", "c")]
    return out + [(None, None, "assistant", "n"), (None, None, "user", "m"), (52, 1, "assistant", "same"), (52, 1, "assistant", "same")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("n", "piece", "tokens", "opens", "cut", "window", "formatted", "own", "context")}).persist()


def parsed(formatted):
    """(start of text, role, text) of a window, without a regular expression for the parts."""
    out, at = [], 0
    clear = lambda s: re.sub(r"<\\(\\*)(turn>|text>|/turn>)", r"<\1\2", s)
    while at < len(formatted):
        assert formatted.startswith("<turn>", at)
        mid = formatted.index("<text>", at)
        end = formatted.index("</turn>", mid)
        out.append((mid + 6, clear(formatted[at + 6 : mid]), clear(formatted[mid + 6 : end]), formatted[mid + 6 : end]))
        at = end + 7
    return out


def in_order(own):
    return sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))


@pytest.mark.parametrize("budget, history", [(1024, 256), (120, 30), (40, 0), (1 << 40, 10)])
def test_windows(spark, table, budget, history):
    own = {}
    for r in rows():
        own.setdefault(r[0], []).append(r)
    found = {}
    for r in chat.windows(table, budget, history).collect():
        found.setdefault(r.conv_id, []).append(r)
    assert found.keys() == own.keys()
    size = lambda text: -(-len(text.encode()) // 4) + 4
    for conv, windows in found.items():
        turns = [(r[2] or "", r[3] or "") for r in in_order(own[conv])]
        opens = turns[0][0] == "system"
        windows.sort(key=lambda r: r.window)
        assert [r.window for r in windows] == list(range(len(windows)))
        at = 0
        for r in windows:
            parts = parsed(r.formatted)
            repeated, new = parts[: r.repeated], parts[r.repeated :]
            assert [p[1:3] for p in new] == turns[at : at + len(new)] and new
            back = [p[1:3] for p in repeated]
            if opens and at:
                assert back.pop(0) == turns[0]
            assert len(back) <= chat.HISTORY_TURNS and back == turns[at - len(back) : at] and sum(size(t) for _, t in back) <= history
            assert r.tokens == sum(size(p[2]) for p in parts)
            assert r.tokens <= budget or len(new) == 1
            assert [(s.start, s.length) for s in r.loss] == [(p[0], len(p[3])) for p in new if p[1] == "assistant"]
            at += len(new)
        assert at == len(turns)
        if sum(size(t) for _, t in turns) <= budget:
            assert len(windows) == 1 and windows[0].repeated == 0


@pytest.mark.parametrize("budget", [1024, 60])
def test_read_back(spark, table, budget):
    found = chat.windows(chat.with_probe(spark, table), budget)
    chars = {}
    for r in found.collect():
        chars[r.conv_id] = chars.get(r.conv_id, 0) + len(r.formatted)
    own = {-7: [(-7, k, role, HARD[0]) for k, role in enumerate(("user", "assistant"))]}
    for r in rows():
        own.setdefault(r[0], []).append(r)
    out = {r.conv_id: tuple(r)[1:] for r in chat.read_back(found).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in own.items():
        turns = [(r[2] or "", r[3] or "") for r in in_order(turns)]
        learned = "".join(t for role, t in turns if role == "assistant")
        assert out.pop(conv) == (len(turns), digest("".join(f"{role}\n{t}\n" for role, t in turns)), len(learned), digest(learned), chars[conv])
    assert not out


def test_no_rows(spark, table):
    assert chat.windows(table.limit(0)).count() == 0
    assert [r.conv_id for r in chat.read_back(chat.windows(chat.with_probe(spark, table.limit(0)))).collect()] == [-7]


def test_no_python_in_the_plan(spark, table):
    plan = chat.read_back(chat.windows(table))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
