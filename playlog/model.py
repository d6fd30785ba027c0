"""Schemas and keys of the library's tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B, _N = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


#: One listening event; times are UTC wall time.
EVENT = _struct(
    played_at=_N, date=T.DateType(), year=_I, quarter=_I, month_number=_I, month_name=_S, week=_I, day=_I, weekday_number=_I, weekday_name=_S, hour=_I, hour_label=_S, time=_S,
    ms_played=T.LongType(), duration_ms=T.LongType(), shuffle_state=_B, skipped=_B, track_name=_S, artist_name=_S, album_name=_S, track_id=_S, track_uri=_S, is_liked=_B,
    primary_genre=_S, secondary_genre=_S, album_art_url=_S, dominant_color=_S, source=_S, imported_at=_N,
)
EVENT_KEY = ("played_at", "track_id")
EVENT_REQUIRED = ("played_at", "ms_played", "track_name", "artist_name", "track_id")
SOURCES = ("export", "api")
#: The longest names, ids, addresses and colours that the tables take.
LENGTHS = {
    "track_name": 255,
    "artist_name": 255,
    "album_name": 255,
    "track_id": 50,
    "track_uri": 100,
    "primary_genre": 100,
    "secondary_genre": 100,
    "album_art_url": 500,
    "dominant_color": 7,
}
#: Columns that the key determines, by which files are clustered and looked up.
EVENT_LOCATED = ("date",)

#: The newest plays, as the service last reported them.
RECENT = _struct(played_at=_N, track_id=_S, track_uri=_S, track_name=_S, artist_name=_S, album_name=_S, duration_ms=T.LongType())
RECENT_KEY = EVENT_KEY

LIKED = _struct(track_id=_S, track_uri=_S, track_name=_S, artist_name=_S, album_name=_S, release_date=T.DateType(), added_to_library=_N, duration_ms=T.LongType(), popularity=_I)
LIKED_KEY = ("track_id",)

RUN_LOG = _struct(
    run_id=T.LongType(), pipeline_name=_S, start_time=_N, end_time=_N, runtime_seconds=T.DecimalType(10, 2), status=_S,
    liked_downloaded=T.LongType(), liked_inserted=T.LongType(), recent_downloaded=T.LongType(), recent_inserted=T.LongType(), error_message=_S,
)

#: Rows that no table could take, as JSON, and why.
REJECTED = _struct(row=_S, reason=_S, seen_at=_N)

#: Raw items of the service's pages.
_ALBUM = T.StructType([T.StructField("name", _S), T.StructField("release_date", _S)])
_TRACK = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("uri", _S),
        T.StructField("name", _S),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("popularity", _I),
        T.StructField("artists", T.ArrayType(T.StructType([T.StructField("name", _S)]))),
        T.StructField("album", _ALBUM),
    ]
)
RAW_RECENT = T.StructType([T.StructField("played_at", _S), T.StructField("track", _TRACK)])
RAW_LIKED = T.StructType([T.StructField("added_at", _S), T.StructField("track", _TRACK)])

#: Rows of an older import, before the event schema.
LEGACY_EXPORT = _struct(Time_stamp=_N, Seconds=T.LongType(), Shuffle=_B, Skipped=_B, track_name=_S, artist_name=_S, album_name=_S, track_uri=_S)


def names(schema: T.StructType) -> list[str]:
    return schema.fieldNames()


def empty(spark, schema: T.StructType):
    """A typed table without rows."""
    return spark.createDataFrame([], schema)
