"""Queries that go through files, tables and streams, and the same in DuckDB SQL.

Each writes rows of the test tables the way a source would hold them, in the shared folder or in a database of its
own, loads them with the library, and returns the loaded rows.
"""

from __future__ import annotations

import atexit
import datetime
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import model
from .functions import text
from .functions.calendar import to_second
from .operators import merge
from .operators.commit import TableLog
from .operators.order import with_place
from .plans import analytics, increments, normalize, pipeline
from .session import arrow_uri, shared_path
from .sources import export, files, paged, sqlite, sqlscript
from .streaming import ingest
from .streaming import sessions as stream_sessions_of

#: Rows of a written file or page, about.
FILE_ROWS = 2000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_databases: list[str] = []


@contextmanager
def _database(spark: SparkSession, tag: str) -> Iterator[str]:
    """A database of this call's own, used while the block runs; lazy results read it later, so it goes when the process ends, or with ``drop_databases``."""
    name, before = f"playlog_{tag}_{uuid.uuid4().hex[:12]}", spark.catalog.currentDatabase()
    if not _databases:
        atexit.register(_drop_at_end, spark)
    _databases.append(name)
    merge.ensure_database(spark, name)
    try:
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)


def drop_databases(spark: SparkSession) -> int:
    """Drop the databases of the queries called so far; returns how many."""
    gone, _databases[:] = list(_databases), []
    for name in gone:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return len(gone)


def _drop_at_end(spark: SparkSession) -> None:
    try:
        if spark._jsc is not None:
            drop_databases(spark)
    except Exception:  # the session may be gone; what is left then goes with the warehouse
        pass


def _write_files(rows: DataFrame, folder: str, suffix: str = ".json") -> str:
    """Write (name, value) as files ``folder``/name, one value each: by the tasks that hold the rows, and a task that runs again writes the same."""
    uri = arrow_uri(rows.sparkSession, folder, make=True)

    def put(own) -> None:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(uri)
        for row in own:
            with fs.open_output_stream(f"{base}/{row.name}{suffix}") as f:
                f.write(row.value.encode() + b"\n")

    rows.select(F.col("name").cast("string"), "value").foreachPartition(put)
    return folder


def _zulu(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


# exported history
_EXPORT_COLUMNS = "played_at date hour_label time ms_played shuffle_state skipped track_name artist_name album_name track_id track_uri is_liked source".split()


def _export_folder(spark: SparkSession, sf_dir: str) -> str:
    """Two overlapping exports of the events as files of arrays; the later one's playing times are a millisecond longer, and every fifth play is no track."""
    events = _read(spark, sf_dir, "events")
    chunks = max(1, events.count() // FILE_ROWS)
    k = F.col("event_id")
    ms = F.round(F.col("value") * 1000).cast("long")
    fields = [
        F.when(k % 2 == 0, _zulu(F.col("ts"))).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ts"),
        (ms + F.col("part")).alias("ms_played"),
        F.col("event_type").alias("master_metadata_track_name"),
        F.col("user_id").cast("string").alias("master_metadata_album_artist_name"),
        F.when(k % 3 != 0, F.get_json_object("props", "$.k")).alias("master_metadata_album_album_name"),
        F.when(k % 5 != 0, F.concat(F.lit("svc:track:"), k.cast("string"))).alias("svc_track_uri"),
        (k % 2 == 0).alias("shuffle"),
        F.when(k % 7 != 0, k % 7 == 1).alias("skipped"),
    ]
    parts = events.filter(k % 10 < 6).withColumn("part", F.lit(0)).unionByName(events.filter(k % 10 >= 4).withColumn("part", F.lit(1)))
    named = parts.select(F.concat_ws("-", "part", k % chunks).alias("name"), F.struct(*fields).alias("row"))
    arrays = named.groupBy("name").agg(F.to_json(F.collect_list("row")).alias("value"))  # FILE_ROWS rows or so each
    return _write_files(arrays, shared_path(spark, "export"))


_EXPORT_SQL = """H AS (
  SELECT date_trunc('second', CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END + INTERVAL 500 MILLISECONDS) AS played_at,
         CAST(round(value * 1000) AS BIGINT) + CASE WHEN event_id % 10 < 6 THEN 0 ELSE 1 END AS ms_played, event_id % 2 = 0 AS shuffle_state, CASE WHEN event_id % 7 <> 0 THEN event_id % 7 = 1 END AS skipped,
         event_type AS track_name, CAST(user_id AS VARCHAR) AS artist_name, CASE WHEN event_id % 3 <> 0 THEN json_extract_string(props, '$.k') END AS album_name, CAST(event_id AS VARCHAR) AS track_id
  FROM events WHERE event_id % 5 <> 0
)"""
_EXPORT_ROWS_SQL = """SELECT played_at, CAST(played_at AS DATE) AS date, strftime(played_at, '%-I %p') AS hour_label, strftime(played_at, '%H:%M:%S') AS time, ms_played, shuffle_state, skipped, track_name,
       artist_name, album_name, track_id, 'svc:track:' || track_id AS track_uri, FALSE AS is_liked, 'export' AS source, TRUE AS dated FROM H"""


def _dated() -> Column:
    """Whether the import time is about now."""
    return (F.abs(F.unix_micros(F.col("imported_at").cast("timestamp")) - F.unix_micros(F.current_timestamp())) < 86_400_000_000).alias("dated")


def export_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = normalize.from_export(files.read_export(spark, _export_folder(spark, sf_dir), "svc"))
    return events.select(*_EXPORT_COLUMNS, _dated())


def history_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table after the same import twice."""
    folder = _export_folder(spark, sf_dir)
    with _database(spark, "history") as db:
        for _ in range(2):
            pipeline.import_history(spark, folder, "svc")
    return spark.table(f"{db}.{pipeline.EVENTS}").select(*_EXPORT_COLUMNS, _dated())


def import_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of two imports and one of a folder without files."""
    folder = _export_folder(spark, sf_dir)
    with _database(spark, "log") as db:
        for place in (folder, folder, shared_path(spark, "nothing")):
            try:
                pipeline.import_history(spark, place, "svc")
            except FileNotFoundError:
                pass
    timed = (F.col("runtime_seconds") >= 0) & (F.col("end_time") >= F.col("start_time"))
    return spark.table(f"{db}.{pipeline.RUN_LOG}").select("run_id", "pipeline_name", "status", "recent_downloaded", "recent_inserted", timed.alias("timed"), F.col("error_message").isNotNull().alias("has_error"))


def history_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loyalty as the rebuilt table has it."""
    folder = _export_folder(spark, sf_dir)
    with _database(spark, "rebuild") as db:
        pipeline.import_history(spark, folder, "svc")
        pipeline.rebuild(spark, only=["artist_loyalty", "artist_discovery"])
        pipeline.rebuild(spark, only=["artist_loyalty"])
    return spark.table(f"{db}.artist_loyalty")


def history_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables as CSV files and one of them read back, column by column."""
    folder = _export_folder(spark, sf_dir)
    with _database(spark, "export") as db:
        pipeline.import_history(spark, folder, "svc")
        pipeline.rebuild(spark, only=["artist_loyalty"])
        schema = spark.table("artist_loyalty").schema
        _, path = export.export_tables(spark, [pipeline.EVENTS, "artist_loyalty"], shared_path(spark, db))
    return files.read_csv(spark, path, schema)


# pages of the service
def _pages(items: DataFrame, page: Column, pages: int, folder: str) -> str:
    """(item) rows as page files; ``page`` numbers from 0, and items keep the order of column ``at`` within a page."""
    body = F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias("items"), F.when(F.col("page") < pages - 1, F.lit("more")).alias("next")))
    rows = items.withColumn("page", page.cast("int")).groupBy("page").agg(body.alias("value"))  # FILE_ROWS rows or so each
    return _write_files(rows.select(F.concat(F.lit("page-"), F.col("page")).alias("name"), "value"), folder)


def _recent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = F.array(*(F.struct(c.cast("string").alias("name")) for c in (F.col("user_id"), F.col("event_type"))))
    track = F.struct(
        (F.col("event_id") % 500).cast("string").alias("id"), F.concat(F.lit("svc:track:"), (F.col("event_id") % 500).cast("string")).alias("uri"), F.col("event_type").alias("name"),
        F.round(F.col("value") * 1000).cast("long").alias("duration_ms"), artists.alias("artists"), F.struct(F.get_json_object("props", "$.k").alias("name")).alias("album"),
    )
    return _read(spark, sf_dir, "events").select(F.col("event_id").alias("at"), F.struct(_zulu(F.col("ts")).alias("played_at"), track.alias("track")).alias("item"))


def _recent_folder(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    items = _recent_items(spark, sf_dir)
    pages = max(1, items.count() // FILE_ROWS)
    return _pages(items, F.col("at") % pages, pages, shared_path(spark, "recent")), pages


def _liked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").filter("p_size <= 10").select(F.col("p_partkey").cast("string").alias("track_id"))


_API_COLUMNS = "played_at date year quarter month_number month_name week day weekday_number weekday_name hour hour_label time ms_played duration_ms track_name artist_name album_name track_id track_uri is_liked source".split()
_CALENDAR_SQL = """CAST(played_at AS DATE) AS date, CAST(year(played_at) AS INTEGER) AS year, CAST(quarter(played_at) AS INTEGER) AS quarter, CAST(month(played_at) AS INTEGER) AS month_number,
       monthname(played_at) AS month_name, CAST(week(played_at) AS INTEGER) AS week, CAST(day(played_at) AS INTEGER) AS day, CAST(isodow(played_at) AS INTEGER) AS weekday_number, dayname(played_at) AS weekday_name,
       CAST(hour(played_at) AS INTEGER) AS hour, strftime(played_at, '%-I %p') AS hour_label, strftime(played_at, '%H:%M:%S') AS time"""
_RECENT_SQL = """R AS (
  SELECT event_id, date_trunc('second', ts + INTERVAL 500 MILLISECONDS) AS played_at, CAST(round(value * 1000) AS BIGINT) AS duration_ms, event_type AS track_name,
         CAST(user_id AS VARCHAR) || ', ' || event_type AS artist_name, json_extract_string(props, '$.k') AS album_name, CAST(event_id % 500 AS VARCHAR) AS track_id, 'svc:track:' || CAST(event_id % 500 AS VARCHAR) AS track_uri
  FROM events
)"""
_API_SQL = f"""WITH {_RECENT_SQL}
SELECT played_at, {_CALENDAR_SQL}, duration_ms AS ms_played, duration_ms, track_name, artist_name, album_name, track_id, track_uri,
       EXISTS (SELECT 1 FROM part WHERE p_size <= 10 AND CAST(p_partkey AS VARCHAR) = track_id) AS is_liked, 'api' AS source FROM R"""


def api_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of plays as events."""
    folder, _ = _recent_folder(spark, sf_dir)
    return normalize.from_recent(normalize.flatten_recent(paged.read_items(spark, model.RAW_RECENT, path=folder)), _liked(spark, sf_dir)).select(*_API_COLUMNS)


def recent_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page only, as the snapshot that replaces an earlier one."""
    folder, _ = _recent_folder(spark, sf_dir)
    with _database(spark, "recent") as db:
        pipeline.create_tables(spark)
        page = normalize.flatten_recent(paged.read_items(spark, model.RAW_RECENT, path=folder, single="true"))
        merge.replace_table(normalize.flatten_recent(paged.read_items(spark, model.RAW_RECENT, path=folder)), pipeline.RECENT)
        merge.replace_table(merge.dedup_first(page, model.RECENT_KEY, ["duration_ms", "track_name", "artist_name", "album_name"]), pipeline.RECENT)
    return spark.table(f"{db}.{pipeline.RECENT}")


_ADDED = datetime.datetime(2020, 1, 1)


def liked_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Library items newer than a mark; they come newest first, so reading stops there."""
    part = _read(spark, sf_dir, "part")
    n = part.agg(F.max("p_partkey")).first()[0] or 0
    pages = max(1, n // 100)
    day = F.date_format(F.date_add(F.lit(_ADDED.date()), F.col("p_size")), "yyyy-MM-dd")
    k = F.col("p_partkey")
    album = F.struct(F.col("p_brand").alias("name"), F.substring(day, 1, F.element_at(F.array(F.lit(4), F.lit(7), F.lit(10)), (k % 3 + 1).cast("int"))).alias("release_date"))
    track = F.struct(
        k.cast("string").alias("id"), F.concat(F.lit("svc:track:"), k.cast("string")).alias("uri"), F.col("p_name").alias("name"), F.round(F.col("p_retailprice") * 100).cast("long").alias("duration_ms"),
        F.when(k % 4 != 0, F.col("p_size")).alias("popularity"), F.array(F.struct(F.col("p_type").alias("name"))).alias("artists"), album.alias("album"),
    )
    added = F.lit(_ADDED) + F.make_dt_interval(F.lit(0), F.lit(0), k.cast("int"))
    items = part.select((-k).alias("at"), F.struct(F.date_format(added, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("added_at"), track.alias("track")).alias("item"))
    folder = _pages(items, F.floor((F.lit(n) + F.col("at")) * pages / (n + 1)), pages, shared_path(spark, "liked"))
    return normalize.flatten_liked(paged.read_items(spark, model.RAW_LIKED, _ADDED + datetime.timedelta(minutes=n // 3), path=folder))


_LIKED_SQL = f"""WITH p AS (
  SELECT *, TIMESTAMP '{_ADDED}' + to_minutes(p_partkey) AS added, CAST(DATE '{_ADDED.date()}' + CAST(p_size AS INTEGER) AS VARCHAR) AS day FROM part
)
SELECT CAST(p_partkey AS VARCHAR) AS track_id, 'svc:track:' || CAST(p_partkey AS VARCHAR) AS track_uri, p_name AS track_name, p_type AS artist_name, p_brand AS album_name,
       CAST(CASE p_partkey % 3 WHEN 0 THEN substr(day, 1, 4) || '-01-01' WHEN 1 THEN substr(day, 1, 7) || '-01' ELSE day END AS DATE) AS release_date, added AS added_to_library,
       CAST(round(p_retailprice * 100) AS BIGINT) AS duration_ms, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS INTEGER) END AS popularity
FROM p WHERE added > TIMESTAMP '{_ADDED}' + to_minutes((SELECT max(p_partkey) // 3 FROM part))"""


# keyed loading
_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads that overlap: orders up to 60 hundredths, and from 40 on."""
    lines = _read(spark, sf_dir, "lineitem").select(*_LINE_KEY, *_LINE_REST)
    return lines.filter("l_orderkey % 100 < 60").withColumn("load", F.lit(1)), lines.filter("l_orderkey % 100 >= 40").withColumn("load", F.lit(2))


def insert_ignore_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after two overlapping loads, the second one repeated."""
    first, second = _halves(spark, sf_dir)
    with _database(spark, "ignore") as db:
        for load in (first, second, second):
            merge.insert_ignore(load, "lines", _LINE_KEY, _LINE_REST)
    return spark.table(f"{db}.lines")


def insert_ignore_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What insert-ignore reports for the second load, and for the same again."""
    first, second = _halves(spark, sf_dir)
    with _database(spark, "counts"):
        _, inserted, again = (merge.insert_ignore(load, "lines", _LINE_KEY, _LINE_REST) for load in (first, second, second))
    n = second.count()
    return spark.createDataFrame([(n, inserted, n - inserted, again)], "processed long, inserted long, skipped long, again long")


def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends by name, with other column orders, and how many rows each reported."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    with _database(spark, "append") as db:
        counts = [merge.append(df, "orders_twice") for df in (orders, orders.filter("o_orderkey % 2 = 0").select("o_custkey", "o_orderkey"))]
    return spark.table(f"{db}.orders_twice").withColumn("appended", F.lit(counts[1]).cast("long"))


def update_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's flag after the update: true already, or true now."""
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "R").alias("is_liked"))
    with _database(spark, "update") as db:
        merge.append(lines, "lines")
        merge.update_flag("lines", _read(spark, sf_dir, "part").filter("p_size <= 10"), "l_partkey", "p_partkey", "is_liked")
    return spark.table(f"{db}.lines")


def replace_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by some of its own rows, and again by a writer that went away once its commit was taken."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    with _database(spark, "replace") as db:
        merge.replace_table(orders, "snap")
        merge.replace_table(spark.table("snap").filter("o_orderkey % 3 != 0"), "snap")
        log = TableLog(spark, "snap")
        seen, left = log.settle(), spark.table("snap").filter("o_orderkey % 5 != 0")
        left.write.parquet(path := log.fresh("data", seen))
        log.take(seen, "replace", path, left.schema)
        merge.recover_table(spark, "snap")
    return spark.table(f"{db}.snap")


def global_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(merge.watermark(_read(spark, sf_dir, "events"), "ts"),)], "latest timestamp_ntz")


def flag_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return merge.flag_exists(lines, _read(spark, sf_dir, "part").filter("p_size <= 10"), "l_partkey", "p_partkey", "is_liked")


# older tables
def migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the older export, half of them and more as older plays; liked tracks are small parts."""
    orders = _read(spark, sf_dir, "orders")
    key = (F.col("o_orderkey") % 700).cast("string")
    export_rows = orders.filter("o_orderkey % 10 < 6").select(
        F.col("o_orderdate").alias("Time_stamp"), F.floor("o_totalprice").cast("long").alias("Seconds"), (F.col("o_orderkey") % 2 == 0).alias("Shuffle"), F.lit(None).cast("boolean").alias("Skipped"),
        F.col("o_orderpriority").alias("track_name"), F.col("o_custkey").cast("string").alias("artist_name"), F.lit(None).cast("string").alias("album_name"), key.alias("track_uri"),
    )
    api_rows = orders.filter("o_orderkey % 10 >= 4").select(
        F.col("o_orderdate").alias("played_at"), key.alias("track_id"), F.concat(F.lit("svc:track:"), key).alias("track_uri"), F.col("o_orderpriority").alias("track_name"),
        F.col("o_custkey").cast("string").alias("artist_name"), F.lit("L").alias("album_name"), F.floor("o_totalprice").cast("long").alias("duration_ms"),
    )
    return normalize.migrate(export_rows, api_rows, _liked(spark, sf_dir), "svc").select("played_at", "track_id", "track_uri", "ms_played", "duration_ms", "track_name", "is_liked", "source", "hour_label")


_MIGRATION_SQL = """WITH b AS (
  SELECT date_trunc('second', o_orderdate + INTERVAL 500 MILLISECONDS) AS played_at, CAST(o_orderkey % 700 AS VARCHAR) AS track_id, CAST(floor(o_totalprice) AS BIGINT) AS n, o_orderpriority AS track_name, o_orderkey % 10 AS d FROM orders
), u AS (
  SELECT played_at, track_id, n * 1000 AS ms_played, CAST(NULL AS BIGINT) AS duration_ms, track_name, 'export' AS source, 0 AS s FROM b WHERE d < 6
  UNION ALL SELECT played_at, track_id, n, n, track_name, 'api', 1 FROM b WHERE d >= 4
), f AS (
  SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY played_at, track_id ORDER BY s, ms_played, track_name) = 1
)
SELECT played_at, track_id, 'svc:track:' || track_id AS track_uri, ms_played, duration_ms, track_name,
       EXISTS (SELECT 1 FROM part WHERE p_size <= 10 AND CAST(p_partkey AS VARCHAR) = f.track_id) AS is_liked, source, strftime(played_at, '%-I %p') AS hour_label FROM f"""


# scripts, backups, definitions, guards
def script_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script of three statements with comments and semicolons in quotes."""
    with _database(spark, "script") as db:
        script = f"""-- orders; by customer
CREATE TABLE {db}.by_customer USING parquet AS SELECT o_custkey, count(*) AS n, 'a;b' AS mark FROM parquet.`{sf_dir}/orders.parquet` GROUP BY o_custkey; /* ; */
INSERT INTO {db}.by_customer VALUES (-1, 0, 'it''s; so');  # the last row;
SELECT o_custkey, n, mark FROM {db}.by_customer;;"""
        return sqlscript.run_script(spark, script)[-1]


def csv_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with quotes, commas and line ends as CSV parts and back."""
    df = _read(spark, sf_dir, "part").select("p_partkey", F.concat(F.col("p_name"), F.lit(', "x"\n'), F.col("p_brand")).alias("label"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("p_type"), "p_size")
    path = shared_path(spark, "backup")
    files.write_csv(df, path)
    return files.read_csv(spark, path, df.schema)


def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the core tables in a new database into which the exported events were loaded, and how many rows hold a value in each."""
    folder = _export_folder(spark, sf_dir)
    with _database(spark, "ddl") as db:
        pipeline.create_tables(spark)
        pipeline.import_history(spark, folder, "svc")
        found = None
        for name in (pipeline.EVENTS, pipeline.LIKED, pipeline.RECENT, pipeline.RUN_LOG, pipeline.REJECTED):
            own = spark.table(f"{db}.{name}")
            about = F.array(*(F.struct(F.lit(k).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("kind"), F.col(f"c{k}").alias("filled")) for k, f in enumerate(own.schema)))
            one = own.agg(*(F.count(f.name).alias(f"c{k}") for k, f in enumerate(own.schema))).select(F.lit(name).alias("name"), F.inline(about))
            found = one if found is None else found.unionByName(one)
    return found


_COLUMNS = {
    "listening_events": """played_at timestamp_ntz, date date, year int, quarter int, month_number int, month_name string, week int, day int, weekday_number int, weekday_name string, hour int, hour_label string, time string,
        ms_played bigint, duration_ms bigint, shuffle_state boolean, skipped boolean, track_name string, artist_name string, album_name string, track_id string, track_uri string, is_liked boolean,
        primary_genre string, secondary_genre string, album_art_url string, dominant_color string, source string, imported_at timestamp_ntz""",
    "liked_tracks": "track_id string, track_uri string, track_name string, artist_name string, album_name string, release_date date, added_to_library timestamp_ntz, duration_ms bigint, popularity int",
    "recent_snapshot": "played_at timestamp_ntz, track_id string, track_uri string, track_name string, artist_name string, album_name string, duration_ms bigint",
    "run_log": """run_id bigint, pipeline_name string, start_time timestamp_ntz, end_time timestamp_ntz, runtime_seconds decimal(10,2), status string,
        liked_downloaded bigint, liked_inserted bigint, recent_downloaded bigint, recent_inserted bigint, error_message string""",
    "rejected_events": "row string, reason string, seen_at timestamp_ntz",
}
_EMPTY_COLUMNS = ["duration_ms", "primary_genre", "secondary_genre", "album_art_url", "dominant_color"]
_COLUMNS_SQL = (
    f"WITH {_EXPORT_SQL}, n AS (SELECT count(*) AS c, count(skipped) AS skipped, count(album_name) AS albums FROM H) "
    "SELECT name, position, \"column\", kind, CASE WHEN name = 'run_log' THEN CASE \"column\" WHEN 'error_message' THEN 0 ELSE 1 END WHEN name <> 'listening_events' OR \"column\" IN ("
    + ", ".join(f"'{c}'" for c in _EMPTY_COLUMNS)
    + ") THEN 0 WHEN \"column\" = 'skipped' THEN skipped WHEN \"column\" = 'album_name' THEN albums ELSE c END AS filled FROM n, (VALUES "
    + ", ".join(f"('{t}', {k}, '{c.split()[0]}', '{c.split()[1]}')" for t, cols in _COLUMNS.items() for k, c in enumerate(x.strip() for x in cols.replace("\n", " ").split(", ")))
    + ') AS t(name, position, "column", kind)'
)


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What raises over the exported events (a folder without files, a cut file, a page that isn't there, a setting that isn't there), and the rows that are read without the fault."""
    folder, empty, pages = _export_folder(spark, sf_dir), shared_path(spark, "empty"), shared_path(spark, "gap")
    value = lambda rows: spark.createDataFrame(rows, "name string, value string")
    _write_files(value([("x", "{}")]), empty, ".txt")
    whole = files.read_export(spark, folder, "svc").count()
    _write_files(value([("cut", '[{"ts": "2024-01-01T00:00:00Z"')]), folder)
    items = _recent_items(spark, sf_dir)
    n = max(1, items.count() // FILE_ROWS)
    _pages(items, F.col("at") % n, n + 1, pages)  # the last one names another page
    read = lambda df: df.write.format("noop").mode("overwrite").save()

    def paged_rows() -> int:
        """With the page that was missing, which is empty."""
        _write_files(value([(f"page-{n}", '{"items": [], "next": null}')]), pages)
        return paged.read_items(spark, model.RAW_RECENT, path=pages).count()

    attempts = {
        "empty folder": (lambda: files.read_export(spark, empty, "svc"), lambda: 0),
        "cut file": (lambda: read(files.read_export(spark, folder, "svc")), lambda: files.split_corrupt(files.read_export(spark, folder, "svc", corrupt="__bad"), "__bad")[0].agg(F.count("ts")).first()[0]),
        "missing page": (lambda: read(paged.read_items(spark, model.RAW_RECENT, path=pages)), paged_rows),
        "missing setting": (lambda: files.settings(["URL"], {"USER": "me"}), lambda: whole),
    }
    rows = []
    for name, (attempt, mended) in attempts.items():
        try:
            attempt()
            raised = False
        except Exception:
            raised = True
        rows.append((name, raised, mended()))
    return spark.createDataFrame(rows, "name string, raised boolean, rows long")


_GUARDS_SQL = """WITH n AS (SELECT count(*) AS plays, count(*) + count(*) FILTER (event_id % 10 BETWEEN 4 AND 5) AS exported FROM events)
SELECT name, TRUE AS raised, CASE kind WHEN 0 THEN 0 WHEN 1 THEN exported ELSE plays END AS rows FROM n, (VALUES ('empty folder', 0), ('cut file', 1), ('missing page', 2), ('missing setting', 1)) AS t(name, kind)"""


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an import that keeps going puts aside: plays without a name, and a file that is cut off."""
    orders = _read(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))
    row = F.struct(_zulu(F.col("o_orderdate")).alias("ts"), F.lit(5).alias("ms_played"), name.alias("master_metadata_track_name"), F.lit("A").alias("master_metadata_album_artist_name"), F.concat(F.lit("svc:track:"), F.col("o_orderkey").cast("string")).alias("svc_track_uri"))
    chunks = max(1, orders.count() // FILE_ROWS)
    arrays = orders.groupBy((F.col("o_orderkey") % chunks).cast("string").alias("name")).agg(F.to_json(F.collect_list(row)).alias("value"))
    folder = _write_files(arrays.unionByName(spark.createDataFrame([("cut", '[{"ts": "20')], "name string, value string")), shared_path(spark, "aside"))
    with _database(spark, "quarantine") as db:
        pipeline.import_history(spark, folder, "svc", strict=False)
    return spark.table(f"{db}.{pipeline.REJECTED}").select("reason", F.get_json_object("row", "$.track_id").alias("track_id"))


# increments
def _refreshed(spark: SparkSession, sf_dir: str, tag: str, table: str) -> DataFrame:
    """An analytics table after three lots of plays, the last of them late, with a refresh after each."""
    plays = _read(spark, sf_dir, "events").select(
        to_second("ts").alias("played_at"), F.round(F.col("value") * 1000).cast("long").alias("ms_played"), F.col("event_type").alias("track_name"), F.col("user_id").cast("string").alias("artist_name"),
        F.get_json_object("props", "$.k").alias("album_name"), F.col("event_id").cast("string").alias("track_id"), (F.col("event_id") % 10).alias("lot"),
    )
    with _database(spark, tag) as db:
        pipeline.create_tables(spark)
        for lot in ("lot < 8", "lot = 8", "lot = 9"):
            merge.load(normalize.as_events(plays.filter(lot), "api", None), pipeline.EVENTS, model.EVENT_KEY, ["ms_played"], model.EVENT_LOCATED)
            increments.refresh(spark, pipeline.EVENTS)
    return spark.table(f"{db}.{table}")


def loyalty_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "loyalty_refresh", "artist_loyalty")


def sessions_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "session_refresh", "listening_session_summary")


# keys, constraints, databases
def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large table after a small load, whose keys it mostly holds and whose ranges and keys reach its scan."""
    lines = _read(spark, sf_dir, "lineitem").select(*_LINE_KEY, *_LINE_REST)
    with _database(spark, "lookup") as db:
        merge.load(lines.filter("l_orderkey % 100 >= 2").withColumn("load", F.lit(1)), "lines", _LINE_KEY, _LINE_REST)
        merge.load(lines.filter("l_orderkey % 100 < 4").withColumn("load", F.lit(2)), "lines", _LINE_KEY, _LINE_REST)
    return spark.table(f"{db}.lines")


_LOOKUP_SQL = f"""SELECT {", ".join([*_LINE_KEY, *_LINE_REST])}, CASE WHEN l_orderkey % 100 >= 2 THEN 1 ELSE 2 END AS load FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE_REST)}) = 1"""


def checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a table takes and what goes aside, by reason: missing values, unknown ones, and such as are too long."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderpriority", F.repeat(F.lit("x"), (F.col("o_orderkey") % 8).cast("int")).alias("note"))
    checks = merge.Checks(required=("o_orderkey", "o_custkey"), one_of={"o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")}, at_most={"note": 6})
    with _database(spark, "checked") as db:
        pipeline.create_tables(spark)
        merge.load(orders, "taken", ["o_orderkey"], ["note"], checks=checks, rejects=pipeline.REJECTED)
        merge.append(orders.filter("o_orderkey % 2 = 0"), "twice", checks, pipeline.REJECTED)
    aside = spark.table(f"{db}.{pipeline.REJECTED}").select(F.get_json_object("row", "$.o_orderkey").cast("long").alias("o_orderkey"), "reason")
    return spark.table(f"{db}.taken").unionByName(spark.table(f"{db}.twice")).select("o_orderkey", F.lit("taken").alias("reason")).unionByName(aside)


_CHECKED_SQL = """WITH o AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 'o_custkey is missing' WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN 'o_orderpriority is none of 1-URGENT, 2-HIGH, 3-MEDIUM, 5-LOW'
         WHEN o_orderkey % 8 > 6 THEN 'note is longer than 6' ELSE 'taken' END AS reason FROM orders
) SELECT * FROM o UNION ALL SELECT * FROM o WHERE o_orderkey % 2 = 0"""


def database_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database's table after two overlapping loads, the first of them sent twice."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    path = f"{shared_path(spark, 'orders')}/plays.db"  # a database that executors reach too; Derby's in memory is one process's own
    for load, rows in ((1, orders.filter("o_orderkey % 10 < 6")), (1, orders), (2, orders.filter("o_orderkey % 10 >= 4"))):
        rows = rows.withColumn("source", F.lit(load))
        sqlite.insert_sqlite(rows, path, "orders", ["o_orderkey"], ["o_custkey"], f"load-{load}")
    return sqlite.read_sqlite(spark, path, "orders", rows.schema, "o_orderkey")


# order
def _placed(df: DataFrame, *order: str, key: list[str] | None = None) -> DataFrame:
    """The columns by which a report is sorted, with the place at which each row comes out; a minus marks those that descend. ``key`` tells rows apart that are equal by them."""
    columns = [c.removeprefix("-") for c in order]
    rows = df.select(*columns, F.xxhash64(*(key or columns)).alias("__row"))
    return with_place(rows, [F.desc(c) if o.startswith("-") else F.asc(c) for o, c in zip(order, columns, strict=True)]).drop("__row").withColumn("place", F.col("place").cast("int"))


def _order_sql(source: str, order: str, columns: str) -> str:
    return f"SELECT {columns}, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place FROM ({source})"


# streams
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays that arrive as files, some of them twice."""
    items, folder = _recent_items(spark, sf_dir), shared_path(spark, "arrivals")
    with _database(spark, "stream") as db:
        for share in ("at % 10 < 6", "at % 10 >= 4"):
            items.filter(share).select("item.*").write.mode("append").json(folder)
            ingest.ingest_recent(ingest.stream_files(spark, folder, model.RAW_RECENT), f"{db}.plays", shared_path(spark, "stream-state") if share == "at % 10 < 6" else f"{folder}-state").awaitTermination()
    return spark.table(f"{db}.plays").select("played_at", "track_id", "source", "hour_label")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user that are final once the stream has been read: those that ended over a day before the last play."""
    folder, out = shared_path(spark, "plays"), shared_path(spark, "sessions")
    events = _read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("artist_name"), F.col("ts").alias("played_at"), F.round(F.col("value") * 1000).cast("long").alias("ms_played"))
    events.write.parquet(folder)
    sessions = ingest.session_windows(ingest.stream_files(spark, folder, events.schema, "parquet"), "artist_name")
    sessions.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(sessions.schema).parquet(out)


_STREAM_SESSIONS_SQL = """WITH g AS (
  SELECT CAST(user_id AS VARCHAR) AS artist_name, ts, CAST(round(value * 1000) AS BIGINT) AS ms, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS new FROM events
), s AS (
  SELECT *, sum(new) OVER (PARTITION BY artist_name ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM g
)
SELECT artist_name, min(ts) AS session_start, max(ts) AS session_end, count(*) AS streams, CAST(sum(ms) AS BIGINT) AS ms_played FROM s GROUP BY artist_name, k
HAVING max(ts) + INTERVAL 30 MINUTES - INTERVAL 1 MICROSECOND <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 DAY"""


def late_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user after plays that came in two lots, the older half of them late: as if all had come in order."""
    folder = shared_path(spark, "late")
    events = _read(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("artist_name"), F.col("ts").alias("played_at"), F.round(F.col("value") * 1000).cast("long").alias("ms_played"))
    with _database(spark, "late") as db:
        for share in ("event_id % 3 = 0", "event_id % 3 != 0"):
            events.filter(share).drop("event_id").write.mode("append").parquet(folder)
            stream_sessions_of.keep_sessions(ingest.stream_files(spark, folder, events.drop("event_id").schema, "parquet"), f"{db}.changes", "artist_name", f"{folder}-state").awaitTermination()
    return stream_sessions_of.current_sessions(spark.table(f"{db}.changes"), "artist_name")


_LATE_SQL = _STREAM_SESSIONS_SQL[: _STREAM_SESSIONS_SQL.index("HAVING")]


def library_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Library items newer than a mark, streamed in two runs between which newer ones have come."""
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    n = part.agg(F.max("p_partkey")).first()[0] or 0
    added = F.lit(_ADDED) + F.make_dt_interval(mins=F.col("p_partkey").cast("int"))
    items = part.select("p_partkey", (-F.col("p_partkey")).alias("at"), F.struct(F.date_format(added, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("added_at"), F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name")).alias("track")).alias("item"))
    folder, out = shared_path(spark, "service"), shared_path(spark, "library")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    for upto in (n * 2 // 3, n):
        here = items.filter(F.col("p_partkey") <= upto).drop("p_partkey")
        pages = max(1, upto // 100)
        Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(Path(folder), True)
        _pages(here, F.floor((F.lit(upto) + F.col("at")) * pages / (upto + 1)), pages, folder)
        stream = paged.stream_items(spark, model.RAW_LIKED, _ADDED + datetime.timedelta(minutes=n // 3), path=folder)
        stream.select("added_at", "track.id", "track.name").writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("added_at string, id string, name string").parquet(out)


_LIBRARY_STREAM_SQL = f"""SELECT strftime(TIMESTAMP '{_ADDED}' + to_minutes(p_partkey), '%Y-%m-%dT%H:%M:%SZ') AS added_at, CAST(p_partkey AS VARCHAR) AS id, p_name AS name
FROM part WHERE p_partkey > (SELECT max(p_partkey) // 3 FROM part)"""


def loyalty_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loyalty where names compare without regard to case."""
    name = F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    plays = _read(spark, sf_dir, "events").select(name.alias("artist_name"), name.alias("track_name"), name.alias("album_name"), F.col("ts").alias("played_at"), F.lit(1).cast("long").alias("ms_played"))
    own = analytics.loyalty(text.fold_case(plays, "artist_name", "track_name", "album_name"))
    return own.select(F.lower(F.collate("artist_name", "UTF8_BINARY")).alias("artist_name"), "total_streams", "unique_tracks", "unique_albums", "active_days")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "export_history": export_history,
    "history_import": history_import,
    "import_log": import_log,
    "history_rebuild": history_rebuild,
    "history_export": history_export,
    "api_history": api_history,
    "recent_snapshot": recent_snapshot,
    "liked_library": liked_library,
    "insert_ignore_table": insert_ignore_table,
    "insert_ignore_counts": insert_ignore_counts,
    "append_table": append_table,
    "update_join": update_join,
    "replace_snapshot": replace_snapshot,
    "global_max_watermark": global_watermark,
    "flag_exists": flag_exists,
    "migration": migration,
    "script_run": script_run,
    "csv_backup": csv_backup,
    "table_columns": table_columns,
    "guards": guards,
    "loyalty_refreshed": loyalty_refreshed,
    "sessions_refreshed": sessions_refreshed,
    "keyed_lookup": keyed_lookup,
    "checked_load": checked_load,
    "database_insert": database_insert,
    "late_sessions": late_sessions,
    "library_stream": library_stream,
    "quarantine": quarantine,
    "stream_ingest": stream_ingest,
    "stream_sessions": stream_sessions,
    "artist_loyalty_folded": loyalty_folded,
}
