"""The five analytics over the event table, each one grouped aggregate or one windowed pass.

Input columns: played_at, artist_name, track_name, album_name, ms_played, and track_id and track_uri for repeats.
Ratios are exact and round half up; a rate over no days is null. Results come sorted as the report shows them;
pass ``ordered=False`` to leave that shuffle out where another step follows.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_parts
from ..functions.exactmath import minutes, ratio
from ..operators import sessions
from ..operators.distinct import distinct_counts


def _plays() -> Column:
    return F.count(F.lit(1))


def discovery(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Each artist's first play, its calendar parts, and lifetime totals."""
    return discovery_of(events.groupBy("artist_name").agg(F.min("played_at").alias("first_listened"), _plays().alias("total_streams"), F.count_distinct("track_name").alias("unique_tracks"), F.sum("ms_played").alias("total_ms")), ordered)


def discovery_of(totals: DataFrame, ordered: bool = True) -> DataFrame:
    """``discovery`` from ``artist_totals``."""
    own = totals.withColumnsRenamed({"total_streams": "lifetime_streams", "total_ms": "lifetime_ms_played"})
    at = calendar_parts("first_listened")
    out = own.select(
        "artist_name",
        "first_listened",
        at["date"].alias("first_listened_date"),
        at["year"].alias("discovery_year"),
        at["quarter"].alias("discovery_quarter"),
        at["month_number"].alias("discovery_month_number"),
        at["month_name"].alias("discovery_month_name"),
        at["week"].alias("discovery_week"),
        at["day"].alias("discovery_day"),
        at["weekday_name"].alias("discovery_weekday"),
        at["hour"].alias("discovery_hour"),
        at["hour_label"].alias("discovery_hour_label"),
        "lifetime_streams",
        "unique_tracks",
        "lifetime_ms_played",
        minutes(F.col("lifetime_ms_played")).alias("lifetime_minutes"),
    )
    return out.orderBy("first_listened") if ordered else out


def artist_totals(events: DataFrame) -> DataFrame:
    """What the reports on artists rest on, a row for each artist."""
    day = F.to_date("played_at")
    measures = {"first_listened": ("min", F.col("played_at")), "most_recent_listened": ("max", F.col("played_at")), "total_streams": ("sum", F.lit(1)), "__ms": ("sum", F.col("ms_played"))}
    own = distinct_counts(events, ["artist_name"], measures, [("unique_tracks", F.col("track_name"))], [("unique_albums", F.col("album_name"))], [("active_years", F.year("played_at")), ("active_days", day)])
    return own.withColumnRenamed("__ms", "total_ms")


def loyalty(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Each artist's span, breadth and rates."""
    return loyalty_of(artist_totals(events), ordered)


def loyalty_of(totals: DataFrame, ordered: bool = True) -> DataFrame:
    """``loyalty`` from ``artist_totals``."""
    span = F.datediff("most_recent_listened", "first_listened")
    out = totals.withColumnRenamed("total_ms", "__ms").select(
        "artist_name",
        "first_listened",
        "most_recent_listened",
        span.alias("listening_span_days"),
        "total_streams",
        "unique_tracks",
        "unique_albums",
        "active_days",
        "active_years",
        minutes(F.col("__ms")).alias("total_minutes"),
        ratio(F.col("total_streams"), F.col("active_years")).alias("avg_streams_per_year"),
        ratio(F.col("__ms"), F.col("active_days") * 60_000).alias("avg_minutes_per_active_day"),
        ratio(F.col("total_streams"), span).alias("avg_streams_per_day"),
    )
    return out.orderBy(F.desc("total_minutes")) if ordered else out


def forgotten(events: DataFrame, as_of: datetime.date | Column | None = None, min_streams: int = 25, min_days: int = 90, ordered: bool = True) -> DataFrame:
    """Artists played at least ``min_streams`` times whose last play is at least ``min_days`` calendar days before ``as_of`` (today, if left out)."""
    measures = {"total_streams": ("sum", F.lit(1)), "total_ms": ("sum", F.col("ms_played")), "first_listened": ("min", F.col("played_at")), "most_recent_listened": ("max", F.col("played_at"))}
    own = distinct_counts(events, ["artist_name"], measures, [("unique_tracks", F.col("track_name"))], [("unique_albums", F.col("album_name"))], [("active_days", F.to_date("played_at"))])
    return forgotten_of(own, as_of, min_streams, min_days, ordered)


def forgotten_of(totals: DataFrame, as_of: datetime.date | Column | None = None, min_streams: int = 25, min_days: int = 90, ordered: bool = True) -> DataFrame:
    """``forgotten`` from ``artist_totals``."""
    day = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    own = totals.withColumnsRenamed({"total_streams": "lifetime_streams", "total_ms": "__ms", "most_recent_listened": "last_listened"})
    out = own.select(
        "artist_name",
        "lifetime_streams",
        minutes(F.col("__ms")).alias("lifetime_minutes"),
        "first_listened",
        "last_listened",
        F.datediff(day, "last_listened").alias("days_since_last_listened"),
        "unique_tracks",
        "unique_albums",
        "active_days",
        ratio(F.col("lifetime_streams"), F.col("active_days")).alias("avg_streams_per_active_day"),
    ).filter((F.col("lifetime_streams") >= min_streams) & (F.col("days_since_last_listened") >= min_days))
    return out.orderBy(F.desc("lifetime_minutes"), F.desc("days_since_last_listened")) if ordered else out


def listening_sessions(events: DataFrame, gap: int = sessions.GAP_MINUTES, ordered: bool = True) -> DataFrame:
    """Sessions over the one global order of plays."""
    out = sessions.summarise(sessions.number_global(events, gap=gap))
    return out.orderBy("session_start") if ordered else out


def listening_sessions_by(events: DataFrame, key: str, gap: int = sessions.GAP_MINUTES) -> DataFrame:
    """Sessions within each value of ``key``."""
    return sessions.summarise(sessions.number_by_key(events, key, gap=gap), key)


REPEAT_KEYS = ["track_id", "track_uri", "track_name", "artist_name", "album_name"]


def repeats(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Plays of each exact (id, uri, track, artist, album); a null album is a value of its own."""
    return repeats_of(events.groupBy(*REPEAT_KEYS).agg(_plays().alias("total_streams"), F.sum("ms_played").alias("total_ms"), F.min("played_at").alias("first_listened"), F.max("played_at").alias("last_listened"), F.count_distinct(F.to_date("played_at")).alias("active_days")), ordered)


def repeats_of(totals: DataFrame, ordered: bool = True) -> DataFrame:
    """``repeats`` from totals of each key."""
    own = totals.withColumnRenamed("total_ms", "__ms")
    span = F.datediff("last_listened", "first_listened")
    out = own.select(
        *REPEAT_KEYS,
        "total_streams",
        minutes(F.col("__ms")).alias("total_minutes"),
        "first_listened",
        "last_listened",
        span.alias("listening_span_days"),
        "active_days",
        ratio(F.col("total_streams"), F.col("active_days")).alias("avg_streams_per_active_day"),
        ratio(F.col("total_streams"), span, 4).alias("avg_streams_per_day"),
    )
    # most keys are played equally often: by the count alone, one task would sort them all
    return out.orderBy(F.desc("total_streams"), *REPEAT_KEYS) if ordered else out
