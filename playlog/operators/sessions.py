"""Sessions: a play starts one if none came before it or the gap is at least the limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exactmath import minutes

GAP_MINUTES = 30


def _starts(previous: Column, ts: str, gap: int) -> Column:
    elapsed = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(previous.cast("timestamp"))
    return F.when(previous.isNull() | (elapsed >= gap * 60_000_000), 1).otherwise(0)


def number_naive(df: DataFrame, ts: str = "played_at", gap: int = GAP_MINUTES) -> DataFrame:
    """``df`` with ``session_id``, by windows over all rows in one task: the definition, for tests and small tables."""
    order = Window.orderBy(ts)
    return df.withColumn("__new", _starts(F.lag(ts).over(order), ts, gap)).withColumn("session_id", F.sum("__new").over(order)).drop("__new")


def number_slots(slots: DataFrame, keys: list[str], slot: str, first: str, last: str, gap: int) -> DataFrame:
    """A row for each slot (within ``keys``) with ``session_id``."""
    order = Window.partitionBy(*keys).orderBy(slot)
    return slots.withColumn("__new", _starts(F.lag(last).over(order), first, gap)).withColumn("session_id", F.sum("__new").over(order)).drop("__new")


def _slotted(df: DataFrame, keys: list[str], ts: str, gap: int) -> DataFrame:
    """``df`` with ``session_id`` within ``keys``, without a window over its rows.

    Times are cut into slots as long as the limit: times of one slot are less than the limit apart, so a session
    can only begin with a slot's first play. Slots are counted before the shuffle, one row for each with its first
    and last time; sessions are numbered over that table, which grows with the span of time and not with the
    plays, and each row takes its slot's number by a join. Neither a busy hour nor a busy key meets in one task.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    cut = df.withColumn("__slot", micros - F.pmod(micros, F.lit(max(1, gap * 60_000_000))))
    slots = cut.filter(F.col(ts).isNotNull()).groupBy(*keys, "__slot").agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"))
    slots = number_slots(slots, keys, "__slot", "__first", "__last", gap)
    right = slots.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__slot").alias("__s"), "session_id")
    on = [cut[k].eqNullSafe(right[f"__k{i}"]) for i, k in enumerate(keys)] + [cut["__slot"] == right["__s"]]
    return cut.join(right, on, "left").select(*df.columns, "session_id")


def number_by_key(df: DataFrame, key: str, ts: str = "played_at", gap: int = GAP_MINUTES) -> DataFrame:
    """``df`` with ``session_id`` counted within each ``key``; rows without a time get no session."""
    return _slotted(df, [key], ts, gap)


def number_global(df: DataFrame, ts: str = "played_at", gap: int = GAP_MINUTES) -> DataFrame:
    """``df`` with ``session_id`` over the one global order; rows without a time get no session."""
    return _slotted(df, [], ts, gap)


def summarise(numbered: DataFrame, *keys: str) -> DataFrame:
    """One row for each session (within ``keys``): bounds, whole minutes, plays, artists, albums and minutes of music."""
    out = numbered.groupBy(*keys, "session_id").agg(
        F.min("played_at").alias("session_start"),
        F.max("played_at").alias("session_end"),
        F.count(F.lit(1)).alias("streams"),
        F.count_distinct("artist_name").alias("artists"),
        F.count_distinct("album_name").alias("albums"),
        F.sum("ms_played").alias("__ms"),
    )
    length = F.expr("timestampdiff(MINUTE, session_start, session_end)").alias("session_length_minutes")
    return out.select(*keys, "session_id", "session_start", "session_end", length, "streams", "artists", "albums", minutes(F.col("__ms")).alias("music_minutes"))
