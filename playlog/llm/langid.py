"""Language identification by rank-order profiles.

A language's profile is the ranking of the most frequent character n-grams (one to three characters, words
padded by spaces) of its training texts. A document's own ranking is held against each profile: an n-gram adds
the distance between its two ranks, one that the profile lacks adds the most there is, and the language of the
smallest sum wins.

Profiles are fitted on a bounded sample of training rows (about ``SAMPLE`` rows of each language); prediction
reads whole texts only. Defined results: a null text, or one without a letter, is ``und`` with score 0, as is
every text if nothing can be learned; equal sums go to the first language by name, equal counts to the smaller
n-gram; repeated rows get equal predictions; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, texts, with_row_id

PROFILE, SAMPLE, UNKNOWN = 400, 600, "und"
_LETTER, _OTHER = re.compile(r"[^\W\d_]"), re.compile(r"[\W\d_]+")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams, packed 21 bits a character, and their counts; letters only, lower case, words padded by a space."""
    clean = " " + _OTHER.sub(" ", text.lower()).strip() + " "
    c = np.frombuffer(clean.encode("utf-32-le"), np.uint32).astype(np.int64)
    two = c[:-1] << 21 | c[1:]
    three = two[:-1] << 21 | c[2:]
    grams = np.sort(np.concatenate([c[c != 32], two, three[c[1:-1] != 32]]))
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[starts], np.diff(np.append(starts, len(grams)))


def ranking(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order; equal counts by n-gram."""
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))][:size]


def out_of_place(own: np.ndarray, profile: np.ndarray, rank: np.ndarray, size: int = PROFILE) -> int:
    """Sum of rank distances of ``own`` to a profile given as sorted n-grams and their ranks."""
    at = np.minimum(np.searchsorted(profile, own), max(len(profile) - 1, 0))
    if not len(profile):
        return size * len(own)
    there = profile[at] == own
    return int(np.where(there, np.abs(rank[at] - np.arange(len(own))), size).sum())


def profiles(docs: DataFrame, size: int = PROFILE, sample: int = SAMPLE) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams and ranks for each language of ``docs`` (text, lang), null languages left out."""
    known = docs.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return {}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample / n)).otherwise(share)
    # drawn by row, so that rows that repeat an id, or have none, don't enter all together
    mix = F.xxhash64("__row", F.lit(5)).bitwiseAND(F.lit(0xFFFFFFFF))
    some = with_row_id(known.select("lang", "text"), "__row").filter(mix < share * 2**32).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text"), strict=True):
                if _LETTER.search(text):
                    grams, n = gram_counts(text)
                    parts.append(pd.DataFrame({"lang": lang, "gram": grams, "n": n}))
            if parts:
                yield pa.RecordBatch.from_pandas(pd.concat(parts).groupby(["lang", "gram"], as_index=False)["n"].sum(), preserve_index=False)

    totals = map_arrow(some, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))  # bounded by the sample
    rows = totals.withColumn("rank", place - 1).filter(F.col("rank") < size).collect()
    out = {}
    for lang in sorted({r["lang"] for r in rows}):
        own = sorted((r["gram"], r["rank"]) for r in rows if r["lang"] == lang)
        out[lang] = (np.array([g for g, _ in own], np.int64), np.array([k for _, k in own], np.int64))
    return out


def predict_one(text: str, known: dict[str, tuple[np.ndarray, np.ndarray]], size: int = PROFILE) -> tuple[str, float]:
    """Language and score: how much nearer the best profile is than the mean of the others, 0 to 1."""
    if not known or not _LETTER.search(text):
        return UNKNOWN, 0.0
    own = ranking(*gram_counts(text), size)
    sums = sorted((out_of_place(own, *p, size), lang) for lang, p in known.items())
    best, lang = sums[0]
    worst = size * len(own)
    rest = sum(s for s, _ in sums[1:]) / (len(sums) - 1) if len(sums) > 1 else worst
    return lang, float(min(1.0, max(0.0, 1 - best / rest))) if rest else 0.0


def identify(docs: DataFrame, known: dict[str, tuple[np.ndarray, np.ndarray]], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., lang_pred, score) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict_one(t, known) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*keep, "lang_pred", "score"])

    kinds = dict(docs.dtypes)
    return map_arrow(docs.select(*dict.fromkeys([*keep, "text"])), run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string, score double"]))
