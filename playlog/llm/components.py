"""Connected components of a table of links.

Up to ``SMALL`` links are joined by one task, which holds some 50 MB for them. Beyond, alternating star operations
replace every link by links to the smallest neighbour, first upwards, then downwards, until nothing changes; rounds
grow with the logarithm of the longest chain. Every step is a grouped minimum (combined before the shuffle) and an
equi-join whose hot keys adaptive execution can split; each round is written to the shared folder. Only a count and a
checksum come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage

#: Links that one task joins.
SMALL = 1 << 18


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, root) of each end, by a forest whose roots are the smallest ends."""
    above: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = above[up]
            x = above[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    ends = list(above)
    for at in range(0, len(ends), 1 << 16):
        some = ends[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(map(find, some), pa.int64())], ["a", "root"])


def components(links: DataFrame, small: int = SMALL) -> DataFrame:
    """(a, root) for each end of a link, root the smallest end that is reachable; ``links`` has longs a and b.

    Nulls and links of an end to itself are left out, repeated links count once, and no links give no rows.
    """
    now = stage(links.select("a", "b").filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.expr("cast(xxhash64(a, b) as decimal(20,0))"))).first())
    before = mark(now)
    if before[0] <= small:
        return stage(map_arrow(now.coalesce(1), _joined, "a long, root long"), "roots")
    while True:
        now = stage(_small_star(_large_star(now)), "links")
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.select("a", F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("a"), F.col("b").alias("root")).distinct())
