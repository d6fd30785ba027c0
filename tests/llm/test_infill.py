"""Fill-in-the-middle against slices of whole lists of units."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

infill = pytest.importorskip("playlog.llm.infill")


def expected(text, key, seed=1):
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    head, middle, tail = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, a, b - a, f"<S>{tail}<P>{head}<M>{middle}" if form == "spm" else f"<P>{head}<S>{tail}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab <>PSM\n\x00é日𝒳"), max_size=30), st.integers(0, 400))
def test_code_points(text, key):
    assert infill.arranged(text, key, infill.Units()) == expected(text, key)


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("ab, .\né日"), max_size=40), st.sampled_from([infill.CODE_POINT, r"\w+", r"\w\w?|.", r"\w+|[^\w\s]", r"(?<=a)b|[^b]"]), st.integers(1, 60))
def test_walks_pass_the_matches_of_any_pattern(text, pattern, times):
    """However long the runs that are passed in strides."""
    units, text = infill.Units(pattern), text * times
    ends = [m.end() for m in re.finditer(pattern, text)]
    assert units.count(text) == len(ends)
    walk = units.walk(text)
    for rank in range(0, len(ends) + 1, 7):
        assert walk.to(rank) == (ends[rank - 1] if rank else 0) and walk.passed == rank


def test_long_text_and_refused_pattern():
    text = "é日𝒳 \n" * 50_000
    units = infill.Units()
    walk = units.walk(text)
    assert units.count(text) == len(text) and (walk.to(513), walk.to(200_001)) == (513, 200_001)
    with pytest.raises(ValueError):
        infill.Units("a*")


def test_rows_and_restored_texts(spark):
    texts = [None, "", "x", "<P>", "a<S>b", "<", "<S", "S>", "ab<M", "M>x", "\x00 a\rb", "日本語 é 𝒳"] + [f"text {k} with < and <S and P> in it" * (k % 5) for k in range(200)] + ["lang " * 60_000]
    rows = [(None if k == 5 else k, t, "clash") for k, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, output string").withColumns({"n": F.lit(1), "form": F.lit("x"), "__key": F.lit(2), "__text": F.lit(3)})
    out = infill.infilled(df).withColumn("again", infill.restored()).collect()
    assert len(out) == len(rows)
    want = sorted((repr((k, *expected(t or "", k), t or "")) for k, t, _ in rows))
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again)) for r in out) == want
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert infill.infilled(df.limit(0)).count() == 0


def test_words_as_units(spark):
    df = spark.createDataFrame([(k, "one, two  three! four five.") for k in range(40)], "doc_id long, text string")
    out = infill.infilled(df, r"\w+|[^\w\s]").withColumn("again", infill.restored()).collect()
    ends = {m.end() for m in re.finditer(r"\w+|[^\w\s]", "one, two  three! four five.")} | {0}
    assert all(r.n == 8 and r.again == "one, two  three! four five." for r in out)
    cut = [r for r in out if r.form != "plain"]
    assert cut and all(r.prefix_chars in ends and r.prefix_chars + r.middle_chars in ends for r in cut)
