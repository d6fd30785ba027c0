"""URL verdicts by a Bloom filter cascade.

Level 0 holds the listed keys, level 1 those unlisted keys of the corpus that level 0 lets through by mistake,
level 2 the listed keys that level 1 lets through, and so on until none are left. As every level's mistakes over
the corpus's complete key universe are encoded by the next, a key of the corpus is listed exactly if the first
level that lacks it is odd. Only keys that level 0 lets through are told apart by a join, once, to build the rest.
Levels are built in parallel as partial bit maps, merged by chunk, and they travel to the tasks instead of any join.

A cascade holds at most ``MOST_KEYS`` listed keys, some 50 MB. Longer lists are parted by a hash of the key into
cascades of that size; the urls' keys then pass one cascade after the other, and a task holds one at a time.

A key is a host or parent domain, followed by a path prefix or nothing; only as many labels and characters as some
listed key has are tried, so long hosts and paths cost no more than their length. Defined results: a null url, or
one without ``://``, has an empty host and path; equal urls get equal verdicts; an empty table gives no rows; no
listed keys list nothing; null keys count as no key; further columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from .common import map_arrow, stage

#: Listed keys of a cascade; bytes of a merged chunk; least rate of mistakes of a level.
MOST_KEYS, CHUNK, LEAST_RATE = 15_000_000, 1 << 15, 1e-6
_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z lowered, and path of a url."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    ends = [k for k in (rest.find(c) for c in "/?#") if k >= 0]
    cut = min(ends, default=len(rest))
    path = rest[cut:]
    for c in "?#":
        path = path.partition(c)[0]
    return rest[:cut].translate(_LOWER), path


def keys_of(host: str, path: str, lengths: list[int], depths: list[int]) -> list[str]:
    """The keys that can be listed for a url, longest first: its host's last labels, as many as ``depths`` names, with path prefixes of ``lengths``."""
    labels = host.rsplit(".", max(depths, default=0))
    n = host.count(".") + 1
    hosts = [".".join(labels[-d:]) for d in depths if 0 < d <= n]
    tails = ["", *(path[:k] for k in lengths if 0 < k <= len(path))]
    return sorted({h + t for h in hosts for t in tails}, key=lambda k: (-len(k), k))


@dataclass
class Bloom:
    """A Bloom filter; ``level`` seeds its hashes."""

    level: int
    bits: int
    hashes: int
    data: np.ndarray

    @classmethod
    def sized(cls, level: int, n: int, rate: float) -> Bloom:
        bits = max(64, math.ceil(1.4427 * n * math.log2(1 / rate)))
        return cls(level, bits, max(1, round(math.log2(1 / rate))), np.zeros(-(-bits // 8), np.uint8))

    def places(self, key: str) -> list[int]:
        h = xxh3_128_intdigest(key, self.level)
        a, b = h >> 64, (h & (2**64 - 1)) | 1
        return [(a + k * b) % 2**64 % self.bits for k in range(self.hashes)]

    def holds(self, key: str) -> bool:
        data = self.data
        return all(data[p >> 3] >> (p & 7) & 1 for p in self.places(key))


def listed_by(levels: list[Bloom], key: str) -> bool:
    """Whether a key of the universe is listed."""
    for k, level in enumerate(levels):
        if not level.holds(key):
            return k % 2 == 1
    return len(levels) % 2 == 1


def _filled(keys: DataFrame, bloom: Bloom) -> Bloom:
    """``bloom`` with the column ``key`` of ``keys`` put in: partial maps of each task, merged by chunk."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.zeros(len(bloom.data), np.uint8)
        for batch in batches:
            for key in batch.column("key").to_pylist():
                for p in bloom.places(key):
                    data[p >> 3] |= 1 << (p & 7)
        for at in range(0, len(data), CHUNK):
            if data[at : at + CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([at // CHUNK], pa.int32()), pa.array([data[at : at + CHUNK].tobytes()], pa.binary())], ["chunk", "bits"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pdf["bits"]])
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "bits": [bits.tobytes()]})

    merged = map_arrow(keys.select("key"), parts, "chunk int, bits binary").groupBy("chunk").applyInPandas(merge, "chunk int, bits binary")
    for r in merged.toLocalIterator():  # as many bytes as the filter has, which sized() bounds
        own = np.frombuffer(r["bits"], np.uint8)
        bloom.data[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(own)] = own
    return bloom


def _passing(keys: DataFrame, levels: list[Bloom]) -> DataFrame:
    """The keys that every level holds."""
    made = tuple(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [k for k in batch.column("key").to_pylist() if k is not None and all(b.holds(k) for b in made)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string())], ["key"])

    return map_arrow(keys.select("key"), run, "key string")


def build_cascade(universe: DataFrame, listed: DataFrame, expected: int | None = None) -> list[Bloom]:
    """The levels for column ``key`` of ``listed`` over that of ``universe``, whose rows may repeat; ``expected``: about how many keys it has."""
    marks = stage(listed.select("key").filter("key is not null").distinct(), "url-listed")
    inside = marks.count()
    if not inside:
        return []
    outside = max(1, universe.count() if expected is None else expected)
    rate = min(0.5, max(LEAST_RATE, inside / outside / math.sqrt(2)))
    levels = [_filled(marks, Bloom.sized(0, inside, rate))]
    passed = _passing(universe, levels).distinct()
    tagged = stage(passed.join(marks.withColumn("hit", F.lit(True)), "key", "left").select("key", F.coalesce("hit", F.lit(False)).alias("listed")), "url-keys")
    while True:
        side = len(levels) % 2 == 0
        keys = _passing(tagged.filter(F.col("listed") == side), levels)
        left = keys.count()
        if not left:
            return levels
        levels.append(_filled(keys, Bloom.sized(len(levels), left, 0.5)))
        if len(levels) > 200:
            raise RuntimeError("the cascade doesn't end")


def url_keys(pages: DataFrame, lengths: list[int], depths: list[int]) -> DataFrame:
    """The complete universe: column ``key``, each url's keys, distinct within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {k for u in batch.column("url").to_pylist() for k in keys_of(*split_url(u), lengths, depths)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(own), pa.string())], ["key"])

    return map_arrow(pages.select("url"), run, "key string")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], blocked: list[str] | DataFrame, default: str = "allow", most_keys: int = MOST_KEYS) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed_key).

    ``rules``: (verdict, host, path prefix), a stated list of which the longest that fits wins; ``blocked``: further
    listed hosts, stated or a column ``key`` of any length, which block themselves and their subdomains where no rule
    fits. The keys of a url go through the cascade; those that it lists are then looked up among the rules by name.
    """
    verdicts = {h + p: v for v, h, p in rules}
    lengths = sorted({len(p) for _, _, p in rules})
    spark = pages.sparkSession
    stated = spark.createDataFrame([(k,) for k in sorted(verdicts if isinstance(blocked, DataFrame) else {*verdicts, *blocked})], "key string")
    listed = stated.unionByName(blocked.select("key").filter("key is not null")).distinct() if isinstance(blocked, DataFrame) else stated
    more = listed.join(stated, "key", "left_anti") if isinstance(blocked, DataFrame) else spark.createDataFrame([(h,) for h in blocked], "key string")
    labels = {h.count(".") + 1 for _, h, _ in rules} | {r[0] for r in more.select((F.size(F.split("key", r"\.")).alias("n"))).distinct().collect()}  # as many as there are lengths of hosts
    depths = sorted(labels)
    n, parts = pages.count() * max(1, len(depths)), max(1, -(-listed.count() // most_keys))
    if parts == 1:
        levels = build_cascade(url_keys(pages, lengths, depths), listed, n)
        known = lambda keys: [k for k in keys if listed_by(levels, k)]
        return _verdicts(pages, known, verdicts, lengths, depths, default)
    return _parted(pages, listed, verdicts, lengths, depths, default, parts, n)


def _verdict(hits: list[str], verdicts: dict[str, str], default: str) -> tuple[str | None, str, str | None]:
    rule = next((k for k in hits if k in verdicts), None)
    return rule, verdicts[rule] if rule else "block" if hits else default, hits[0] if hits else None


def _verdicts(pages: DataFrame, known, verdicts: dict[str, str], lengths: list[int], depths: list[int], default: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                rows.append((host, path, *_verdict(known(keys_of(host, path, lengths, depths)), verdicts, default)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array(c, pa.string()) for c in cols)], ["page_id", "host", "path", "rule", "verdict", "listed_key"])

    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"), run, "page_id long, host string, path string, rule string, verdict string, listed_key string")


def _parted(pages: DataFrame, listed: DataFrame, verdicts: dict[str, str], lengths: list[int], depths: list[int], default: str, parts: int, n: int) -> DataFrame:
    """``judge`` for lists that one cascade can't hold: each part's cascade adds the listed keys that it has to every url's ``hits``."""
    part = F.crc32(F.col("key").cast("binary")) % parts
    rows = stage(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.array().cast("array<string>").alias("hits")), "url-hits")
    for k in range(parts):
        own = listed.filter(part == k)
        levels = build_cascade(url_keys(pages, lengths, depths).filter(part == k), own, n // parts)

        def run(batches: Iterator[pa.RecordBatch], levels: list[Bloom] = levels, k: int = k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for url, hits in zip(batch.column("url").to_pylist(), batch.column("hits").to_pylist(), strict=True):
                    found.append([*hits, *(x for x in keys_of(*split_url(url), lengths, depths) if x not in hits and zlib.crc32(x.encode()) % parts == k and listed_by(levels, x))])
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.list_(pa.string()))], ["page_id", "url", "hits"])

        rows = stage(map_arrow(rows, run, "page_id long, url string, hits array<string>"), "url-hits")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for url, hits in zip(batch.column("url").to_pylist(), batch.column("hits").to_pylist(), strict=True):
                out.append((*split_url(url), *_verdict(sorted(hits, key=lambda x: (-len(x), x)), verdicts, default)))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array(c, pa.string()) for c in cols)], ["page_id", "host", "path", "rule", "verdict", "listed_key"])

    return map_arrow(rows, last, "page_id long, host string, path string, rule string, verdict string, listed_key string")
