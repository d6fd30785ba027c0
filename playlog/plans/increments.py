"""The analytics kept up to date from partial sums, without reading the event table again.

What the analytics need of the events is kept as partial sums that add up: for artists by track, album and day; for
repeated plays by key and day; for sessions by slots as long as the gap, and by slot and artist or album. The events
that were added since the last refresh, as the event table's log names their files, become one more lot of partial
sums, which is appended. From the sums of the artists and plays that the lot touches, their totals are computed anew
and put in place of the old ones, or all totals are, if the lot touches many; the reports are projections of the
totals. A lot counts once its mark is written, which comes last: a refresh that breaks off leaves sums that nothing
reads, and is done anew.

If the log can't tell what was added (rows were replaced or compacted, or it is the first time), all is derived from
all events, which also merges the lots.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exactmath import minutes
from ..operators import merge, sessions
from ..operators.commit import TableLog
from ..operators.spread import spread
from . import analytics

ARTISTS, REPEATS, SLOTS, MARKS = "artist_sums", "repeat_sums", "slot_sums", "refresh_marks"
ARTIST_TOTALS, REPEAT_TOTALS = "artist_totals", "repeat_totals"
MARK = "number long, lot string, marked_at timestamp_ntz"
#: Keys that a lot touches: so many at most, and one of so many of the totals, travel to where totals and sums are read.
TOUCHED_KEYS, TOUCHED_PART = 100_000, 4
#: Rows of a task that aggregates repeated plays.
KEY_ROWS = 200_000


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("streams"), F.sum("ms_played").alias("ms"), F.min("played_at").alias("first"), F.max("played_at").alias("last")]


def _again() -> list[Column]:
    return [F.sum("streams").alias("streams"), F.sum("ms").alias("ms"), F.min("first").alias("first"), F.max("last").alias("last")]


def _by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` shuffled by keys that seldom repeat, before any aggregate: nothing is gained by combining them first. Up to four aggregates then share a task, some kilobyte a row."""
    return spread(df, df.count(), *keys, each=KEY_ROWS)


def artist_sums(events: DataFrame) -> DataFrame:
    """(artist_name, kind, value, streams, ms, first, last): plays by track, which add up to all, and which albums and days there are."""
    part = lambda kind, value, own: own.groupBy("artist_name", F.lit(kind).alias("kind"), value.alias("value")).agg(*_sums())
    return part("track", F.col("track_name"), events).unionByName(part("album", F.col("album_name"), events)).unionByName(part("day", F.to_date("played_at").cast("string"), events))


def artist_totals(sums: DataFrame) -> DataFrame:
    """``analytics.artist_totals`` from sums of any number of lots.

    Read once and shuffled by value, so that a hot artist is spread; from there on an artist has a row for each kind
    and year, which are combined before their shuffle.
    """
    is_a = lambda kind: F.col("kind") == kind
    tracks = lambda c: F.when(is_a("track"), F.col(c)).alias(c)
    values = sums.select("artist_name", "kind", "value", *(tracks(c) for c in ("streams", "ms", "first", "last"))).groupBy("artist_name", "kind", "value").agg(*_again())
    years = values.groupBy("artist_name", "kind", F.when(is_a("day"), F.year(F.col("value").cast("date"))).alias("year")).agg(F.count("value").alias("n"), *_again())
    return years.groupBy("artist_name").agg(
        F.min("first").alias("first_listened"), F.max("last").alias("most_recent_listened"), F.sum("streams").alias("total_streams"), F.sum("ms").alias("total_ms"),
        F.sum(F.when(is_a("track"), F.col("n")).otherwise(0)).alias("unique_tracks"), F.sum(F.when(is_a("album"), F.col("n")).otherwise(0)).alias("unique_albums"),
        F.count("year").alias("active_years"), F.sum(F.when(is_a("day"), F.col("n")).otherwise(0)).alias("active_days"),
    )


def repeat_sums(events: DataFrame) -> DataFrame:
    plays = events.select(*analytics.REPEAT_KEYS, F.to_date("played_at").alias("day"), "played_at", "ms_played")
    return _by_key(plays, [*analytics.REPEAT_KEYS, "day"]).groupBy(*analytics.REPEAT_KEYS, "day").agg(*_sums())


def repeat_totals(sums: DataFrame) -> DataFrame:
    """Totals of each repeated key, from sums of any number of lots."""
    days = _by_key(sums, analytics.REPEAT_KEYS).groupBy(*analytics.REPEAT_KEYS, "day").agg(*_again())
    return days.groupBy(*analytics.REPEAT_KEYS).agg(F.sum("streams").alias("total_streams"), F.sum("ms").alias("total_ms"), F.min("first").alias("first_listened"), F.max("last").alias("last_listened"), F.count("day").alias("active_days"))


def slot_sums(events: DataFrame, gap: int = sessions.GAP_MINUTES) -> DataFrame:
    """(slot, kind, value, streams, ms, first, last): plays of each slot, and which artists and albums it has."""
    micros = F.unix_micros(F.col("played_at").cast("timestamp"))
    own = events.filter("played_at IS NOT NULL").withColumn("slot", micros - F.pmod(micros, F.lit(max(1, gap * 60_000_000))))
    part = lambda kind, value: own.groupBy("slot", F.lit(kind).alias("kind"), value.alias("value")).agg(*_sums())
    return part("play", F.lit(None).cast("string")).unionByName(part("artist", F.col("artist_name"))).unionByName(part("album", F.col("album_name")))


def session_summary(sums: DataFrame, gap: int = sessions.GAP_MINUTES) -> DataFrame:
    """``analytics.listening_sessions`` from slots of any number of lots."""
    slots = sums.filter("kind = 'play'").groupBy("slot").agg(*_again())
    numbered = sessions.number_slots(slots, [], "slot", "first", "last", gap)
    own = numbered.groupBy("session_id").agg(F.min("first").alias("session_start"), F.max("last").alias("session_end"), F.sum("streams").alias("streams"), F.sum("ms").alias("ms"))
    kinds = sums.filter("kind != 'play' AND value IS NOT NULL").select("slot", "kind", "value").join(numbered.select("slot", "session_id"), "slot")
    found = kinds.select("session_id", "kind", "value").distinct().groupBy("session_id").agg(F.count_if(F.col("kind") == "artist").alias("artists"), F.count_if(F.col("kind") == "album").alias("albums"))
    length = F.expr("timestampdiff(MINUTE, session_start, session_end)").alias("session_length_minutes")
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return own.join(found, "session_id", "left").select("session_id", "session_start", "session_end", length, "streams", none("artists"), none("albums"), minutes(F.col("ms")).alias("music_minutes"))


def _renewed(totals: DataFrame, sums: DataFrame, keys: list[str], batch: DataFrame, make) -> DataFrame:
    """``totals`` with those of the keys of ``batch`` made anew from their sums; all of them, if these are more than travel, since a join would shuffle the sums just so, and the totals too."""
    own = batch.select(*(F.col(k).alias(f"__{k}") for k in keys))
    n = own.agg(F.approx_count_distinct(F.struct(*own.columns))).first()[0]
    if n > TOUCHED_KEYS or n * TOUCHED_PART > totals.count():
        return make(sums)
    touched = F.broadcast(own.distinct())
    on = lambda df: [df[k].eqNullSafe(touched[f"__{k}"]) for k in keys]
    return totals.join(touched, on(totals), "left_anti").unionByName(make(sums.join(touched, on(sums), "left_semi")))


def refresh(spark: SparkSession, events: str, as_of: datetime.date | None = None) -> list[str]:
    """Bring the analytics tables up to date with the event table; returns the tables that were written."""
    log = TableLog(spark, events)
    number, lot = log.settle(), uuid.uuid4().hex
    known = spark.catalog.tableExists(MARKS) and merge.recover_table(spark, MARKS)
    last = spark.table(MARKS).orderBy(F.desc("number"), F.desc("marked_at")).first() if known else None
    schema = spark.table(events).schema
    added = log.added_since(last["number"], schema) if last and last["number"] <= number else None
    whole = added is None
    batch = spark.table(events) if whole else added
    lots = None if whole else spark.table(MARKS).select("lot").unionByName(spark.createDataFrame([(lot,)], "lot string"))
    makers = {ARTISTS: artist_sums, REPEATS: repeat_sums, SLOTS: slot_sums}
    if not whole and batch.limit(1).count() == 0:
        lots = spark.table(MARKS).select("lot")
    else:
        for name, make in makers.items():
            own = make(batch).withColumn("lot", F.lit(lot))
            merge.replace_table(own, name) if whole else merge.append(own, name)
    sums = lambda name: spark.table(name).drop("lot") if whole else spark.table(name).join(F.broadcast(lots), "lot", "left_semi").drop("lot")
    for name, total, keys, make in ((ARTISTS, ARTIST_TOTALS, ["artist_name"], artist_totals), (REPEATS, REPEAT_TOTALS, analytics.REPEAT_KEYS, repeat_totals)):
        if whole:
            merge.replace_table(make(sums(name)), total)
        else:
            merge.replace_table(_renewed(spark.table(total), sums(name), keys, batch, make), total)
    reports = {
        "artist_discovery": lambda: analytics.discovery_of(spark.table(ARTIST_TOTALS)),
        "artist_loyalty": lambda: analytics.loyalty_of(spark.table(ARTIST_TOTALS)),
        "forgotten_favorites": lambda: analytics.forgotten_of(spark.table(ARTIST_TOTALS), as_of),
        "listening_session_summary": lambda: session_summary(sums(SLOTS)).orderBy("session_start"),
        "repeat_behavior": lambda: analytics.repeats_of(spark.table(REPEAT_TOTALS)),
    }
    for name, make in reports.items():
        merge.replace_table(make(), name)
    mark = spark.createDataFrame([(number, lot, datetime.datetime.now(datetime.UTC).replace(tzinfo=None))], MARK)
    if whole:
        merge.replace_table(mark, MARKS)
    elif last["number"] < number:
        merge.append(mark, MARKS)
    return list(reports)
