"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and laid out in the order that a model is to learn.

A text is cut between units, the matches of a pattern from left to right; what lies between two units goes with the
later one, and what follows the last one with the suffix. A matcher walks over the text twice: the first walk counts
the units, the second advances to both ranks and stops there. A walk holds a count and a position, and strides over
units that touch each other; no list of units, matches or offsets is ever stored, so a text costs its own length.

Ranks and forms are drawn from a digest of seed and id, so a row gets the same form wherever and however often it is
computed. Defined results: a null text is an empty one, and an empty text is plain, as is one that holds a mark; a null
id is drawn for as an empty one; repeated rows get equal results; whole texts are read, a very long one by itself; an
empty table gives no rows; further columns are not read unless they are to be kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, map_arrow, texts

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
CODE_POINT = r"(?s:.)"
#: Units that touch each other and are passed in one match.
STRIDE = 512


class Units:
    """The matches of ``pattern``; flags are stated within it, as in ``(?s:.)``, and it must not match an empty string."""

    def __init__(self, pattern: str = CODE_POINT):
        self.one = re.compile(pattern)
        if self.one.match(""):
            raise ValueError(f"a unit can't be empty: {pattern}")
        # each unit is settled before the next one is tried, as when they are matched one by one
        self.many = re.compile(f"(?>{pattern}){{{STRIDE}}}")

    def walk(self, text: str) -> Walk:
        return Walk(self, text)

    def count(self, text: str) -> int:
        """The first pass."""
        walk = self.walk(text)
        walk.to(None)
        return walk.passed


class Walk:
    """A place between two units of a text, which only moves on."""

    def __init__(self, units: Units, text: str):
        self.units, self.text, self.passed, self.at = units, text, 0, 0

    def to(self, rank: int | None) -> int:
        """Where the unit of that rank ends, 0 for none; without a rank, where the last one ends."""
        while rank is None or self.passed < rank:
            far = rank is None or rank - self.passed >= STRIDE
            found = self.units.many.match(self.text, self.at) if far else None
            step = STRIDE if found else 1
            found = found or self.units.one.search(self.text, self.at)
            if not found:
                break
            self.passed, self.at = self.passed + step, found.end()
        return self.at


def draws(seed: int, key: object) -> list[int]:
    """Four numbers below 2 ** 32 for a key."""
    own = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(own[k : k + 8], 16) for k in range(0, 32, 8)]


def arranged(text: str, key: object, units: Units, seed: int = 1, rate: int = 90, spm: int = 20) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of the prefix, of the middle, output): of a hundred texts ``rate`` are cut, and of these ``spm`` have the suffix first."""
    n = units.count(text)
    h = draws(seed, key)
    if not text or any(mark in text for mark in MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    walk = units.walk(text)
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = walk.to(first), walk.to(second)
    head, middle, tail = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, "".join((SUFFIX, tail, PREFIX, head, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, head, SUFFIX, tail, MIDDLE, middle))


def infilled(docs: DataFrame, pattern: str = CODE_POINT, seed: int = 1, rate: int = 90, spm: int = 20, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., n, form, prefix_chars, middle_chars, output) for each row of (doc_id, text); lengths are null where the form is plain."""
    Units(pattern)  # a pattern that can't serve is refused before any task runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(pattern)
        for batch in batches:
            rows = [arranged(text, key, units, seed, rate, spm) for text, key in zip(texts(batch, "__text"), batch.column("__key").to_pylist(), strict=True)]
            n, form, head, middle, output = zip(*rows, strict=True) if rows else ([],) * 5
            own = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(head, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *own], names=[*keep, "n", "form", "prefix_chars", "middle_chars", "output"])

    given = docs.select(*(F.col(c) for c in keep), F.col("doc_id").cast("string").alias("__key"), F.col("text").alias("__text"))
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n long, form string, prefix_chars long, middle_chars long, output string"])
    return map_arrow(given, run, schema, BATCH_BYTES // 2)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made of: no part holds a mark, so the marks alone tell the parts."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(F.substr(output, F.lit(len(PREFIX) + 1)), "|".join(map(re.escape, MARKS)), 3)
    order = {"psm": (0, 2, 1), "spm": (1, 2, 0)}
    cut = F.when(form == "psm", F.concat(*(F.get(parts, F.lit(k)) for k in order["psm"])))
    return cut.when(form == "spm", F.concat(*(F.get(parts, F.lit(k)) for k in order["spm"]))).otherwise(output)
