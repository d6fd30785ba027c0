"""Shuffles whose tasks stay as large as they are while rows grow."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a task, about.
TASK_ROWS = 500_000


def spread(df: DataFrame, rows: int, *keys: str, each: int | None = None) -> DataFrame:
    """``df`` shuffled by ``keys`` into a partition for each ``TASK_ROWS`` (or ``each``) of ``rows``, if those are more than a shuffle has.

    An aggregate by ``keys`` (and others) then needs no shuffle of its own. Below that, ``df`` is left alone.
    """
    parts = -(-rows // (each or TASK_ROWS))
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
