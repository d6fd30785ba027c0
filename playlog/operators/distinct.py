"""Several exact distinct counts of a group, each row read once for each chain of columns instead of once for each column of one wide aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (name of the count, values), coarse to fine where a value determines the one before it, such as a day its year.
Chain = list[tuple[str, Column]]


def distinct_counts(df: DataFrame, keys: list[str], measures: dict[str, tuple[str, Column]], *chains: Chain) -> DataFrame:
    """(keys..., measures..., counts...): ``measures`` are (sum, min or max, values); a chain's values are counted, nulls left out.

    Each chain has its own aggregate over (keys, values), combined before its shuffle, so that a group that holds a
    third of all rows is spread by its values; the first one carries the measures along. From there on a group has a
    row for each distinct value, then for each value one step coarser, and in the end all chains' counts and measures
    meet in one sum by ``keys``, which is combined before its shuffle too. Nothing is copied for each count.
    """
    kinds = {"sum": F.sum, "min": F.min, "max": F.max}
    names = [n for chain in chains for n, _ in chain]
    parts = []
    for k, chain in enumerate(chains):
        values = [f"__v{j}" for j in range(len(chain))]
        own = measures if k == 0 else {}
        rows = df.select(*keys, *(v.alias(c) for c, (_, v) in zip(values, chain, strict=True)), *(v.alias(f"__m_{n}") for n, (_, v) in own.items()))
        rows = rows.groupBy(*keys, *values).agg(*(kinds[how](f"__m_{n}").alias(n) for n, (how, _) in own.items())) if own else rows.distinct()
        found: list[str] = []
        for j in range(len(chain) - 1, 0, -1):
            sums = [F.sum(c).alias(c) for c in found] + [kinds[how](n).alias(n) for n, (how, _) in own.items()]
            rows = rows.groupBy(*keys, *values[:j]).agg(F.count(values[j]).alias(chain[j][0]), *sums)
            found.append(chain[j][0])
        parts.append(rows.select(*keys, *own, *found, F.when(F.col(values[0]).isNotNull(), 1).otherwise(0).cast("long").alias(chain[0][0])))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    ends = [kinds[how](n).alias(n) for n, (how, _) in measures.items()] + [F.sum(n).alias(n) for n in names]
    return both.groupBy(*keys).agg(*ends)
