"""Raw rows of either source as the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model
from ..functions.calendar import parse_zulu, to_second, widen_date, with_calendar
from ..functions.text import join_names, track_id
from ..operators.merge import dedup_first, flag_members

#: Field names of the exported history; its uri field is the one that ends in EXPORT_URI_SUFFIX.
EXPORT_FIELDS = {
    "ts": "played_at",
    "ms_played": "ms_played",
    "master_metadata_track_name": "track_name",
    "master_metadata_album_artist_name": "artist_name",
    "master_metadata_album_album_name": "album_name",
    "shuffle": "shuffle_state",
    "skipped": "skipped",
}
EXPORT_URI_SUFFIX = "_track_uri"


def as_events(df: DataFrame, source: str, imported_at: Column | None) -> DataFrame:
    """Fill in what a source lacks, and bring the columns into the event table's order and types."""
    df = with_calendar(df).withColumns({"source": F.lit(source), "imported_at": (F.current_timestamp() if imported_at is None else imported_at).cast("timestamp_ntz")})
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in model.EVENT))


def valid(events: DataFrame) -> DataFrame:
    """Rows that hold every required column and a known source."""
    ok = F.col("source").isin(*model.SOURCES)
    for name in model.EVENT_REQUIRED:
        ok &= F.col(name).isNotNull()
    return events.filter(ok)


def rejected(events: DataFrame) -> DataFrame:
    """The rows that ``valid`` leaves out, for quarantine."""
    ok = F.col("source").isin(*model.SOURCES)
    for name in model.EVENT_REQUIRED:
        ok &= F.col(name).isNotNull()
    return events.filter(~F.coalesce(ok, F.lit(False)))


def from_export(raw: DataFrame, imported_at: Column | None = None, uri_field: str | None = None, order: list[str | Column] | None = None) -> DataFrame:
    """Exported history as events: tracks only, the first row of each key. ``order`` says which row is first; by default input file, then all columns."""
    found = [c for c in raw.columns if c.endswith(EXPORT_URI_SUFFIX)]
    if uri_field is None and len(found) != 1:
        raise ValueError(f"name the uri field, one of {found}" if found else f"no column ends in {EXPORT_URI_SUFFIX}")
    uri = uri_field or found[0]
    service = uri.removesuffix(EXPORT_URI_SUFFIX) if uri.endswith(EXPORT_URI_SUFFIX) else None
    df = raw.filter(F.col(uri).isNotNull())
    order = order or ([F.col("_metadata.file_path")] if _has_files(df) else [])
    df = df.select(*(F.col(k).alias(v) for k, v in EXPORT_FIELDS.items()), F.col(uri).alias("track_uri"), *(o if isinstance(o, Column) else F.col(o) for o in order))
    tail = df.columns[len(EXPORT_FIELDS) + 1 :]
    df = df.toDF(*df.columns[: len(EXPORT_FIELDS) + 1], *(f"__order{k}" for k in range(len(tail))))
    df = df.withColumns({"played_at": to_second(parse_zulu("played_at")), "track_id": track_id("track_uri", service or None), "is_liked": F.lit(False)})
    rest = [c for c in df.columns if not c.startswith("__order") and c not in model.EVENT_KEY]
    first = dedup_first(df, model.EVENT_KEY, [*(f"__order{k}" for k in range(len(tail))), *rest])
    return as_events(first, "export", imported_at)


def _has_files(df: DataFrame) -> bool:
    try:
        df.select("_metadata.file_path")
    except Exception:  # not a file source: there is no such column
        return False
    return True


def flatten_recent(items: DataFrame) -> DataFrame:
    """Items of the service's recent-plays pages as flat rows."""
    t = F.col("track")
    return items.select(
        to_second(parse_zulu("played_at")).alias("played_at"), t["id"].alias("track_id"), t["uri"].alias("track_uri"), t["name"].alias("track_name"),
        join_names(t["artists"]).alias("artist_name"), t["album"]["name"].alias("album_name"), t["duration_ms"].alias("duration_ms"),
    )


def flatten_liked(items: DataFrame) -> DataFrame:
    """Items of the service's library pages as flat rows."""
    t = F.col("track")
    return items.select(
        t["id"].alias("track_id"), t["uri"].alias("track_uri"), t["name"].alias("track_name"), join_names(t["artists"]).alias("artist_name"), t["album"]["name"].alias("album_name"),
        widen_date(t["album"]["release_date"]).alias("release_date"), parse_zulu("added_at").alias("added_to_library"), t["duration_ms"].alias("duration_ms"), t["popularity"].alias("popularity"),
    )


def from_recent(rows: DataFrame, liked: DataFrame | None = None, imported_at: Column | None = None) -> DataFrame:
    """Flat recent plays as events: the playing time is the track's length, and liked tracks are flagged."""
    df = rows.withColumns({"played_at": to_second("played_at"), "ms_played": F.col("duration_ms")})
    df = flag_members(df, liked, "track_id", "track_id", "is_liked") if liked is not None else df.withColumn("is_liked", F.lit(False))
    return as_events(df, "api", imported_at)


def from_legacy_export(rows: DataFrame, service: str, imported_at: Column | None = None) -> DataFrame:
    """Rows of the older export table as events; ``service`` is the uri's first part."""
    df = rows.select(
        to_second("Time_stamp").alias("played_at"), (F.col("Seconds") * 1000).alias("ms_played"), F.col("Shuffle").alias("shuffle_state"), F.col("Skipped").alias("skipped"), "track_name", "artist_name", "album_name",
        F.col("track_uri").alias("track_id"), F.concat(F.lit(f"{service}:track:"), F.col("track_uri")).alias("track_uri"), F.lit(False).alias("is_liked"),
    )
    return as_events(df, "export", imported_at)


def migrate(legacy_export: DataFrame, legacy_api: DataFrame, liked: DataFrame, service: str, imported_at: Column | None = None) -> DataFrame:
    """Both older tables as one event table: export rows first, each key once, then every liked track flagged."""
    from ..operators.merge import union_first

    export = from_legacy_export(legacy_export, service, imported_at)
    api = from_recent(legacy_api, liked, imported_at)
    both = union_first(model.EVENT_KEY, export, api, order=["source", "ms_played", "track_name"])
    flagged = flag_members(both, liked, "track_id", "track_id", "__liked")
    return flagged.withColumn("is_liked", F.col("is_liked") | F.col("__liked")).select(*model.names(model.EVENT))
