"""The library's own queries over the test tables, and the same in DuckDB SQL.

View E is ``events`` as plays: the user is the artist, the event type the track, a property the album. View L is
``lineitem`` with its order, part and supplier. Money and values are integers before any sum, so that sums are
exact; SQL ratios round half up by whole-number arithmetic.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog_tables as tables
from .functions import calendar, exactmath, text
from .operators import merge, sessions
from .operators.spread import spread
from .plans import analytics

AS_OF = datetime.date(2001, 8, 1)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View E."""
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("track_id"),
        calendar.to_second("ts").alias("played_at"),
        F.col("user_id").cast("string").alias("artist_name"),
        F.col("event_type").alias("track_name"),
        F.get_json_object("props", "$.k").alias("album_name"),
        F.round(F.col("value") * 1000).cast("long").alias("ms_played"),
    )


def star(spark: SparkSession, sf_dir: str, artist: str = "s_name") -> DataFrame:
    """View L; the dimensions are joined by key, and Catalyst broadcasts those that are small. Those that aren't come in as many partitions as the lines need, which the joins then shuffle likewise."""
    lines = _read(spark, sf_dir, "lineitem")
    n = lines.count()
    dim = lambda name, key: spread(_read(spark, sf_dir, name), n, key)
    df = lines.join(dim("orders", "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(dim("part", "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    if artist == "s_name":
        df = df.join(dim("supplier", "s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return df.select(
        F.col("l_partkey").cast("string").alias("track_id"),
        F.concat(F.lit("part:track:"), F.col("l_partkey").cast("string")).alias("track_uri"),
        F.col("o_orderdate").alias("played_at"),
        F.col(artist).cast("string").alias("artist_name"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("album_name"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("ms_played"),
    )


E_SQL = """E AS (
  SELECT CAST(event_id AS VARCHAR) AS track_id, date_trunc('second', ts + INTERVAL 500 MILLISECONDS) AS played_at, CAST(user_id AS VARCHAR) AS artist_name,
         event_type AS track_name, json_extract_string(props, '$.k') AS album_name, CAST(round(value * 1000) AS BIGINT) AS ms_played
  FROM events
)"""


def _l_sql(artist: str = "s_name") -> str:
    supplier = "JOIN supplier ON l_suppkey = s_suppkey" if artist == "s_name" else ""
    return f"""E AS (
  SELECT CAST(l_partkey AS VARCHAR) AS track_id, 'part:track:' || CAST(l_partkey AS VARCHAR) AS track_uri, o_orderdate AS played_at, CAST({artist} AS VARCHAR) AS artist_name,
         p_name AS track_name, p_brand AS album_name, CAST(round(l_extendedprice * 100) AS BIGINT) AS ms_played
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey {supplier}
)"""


def _ratio(over: str, under: str, scale: int = 2) -> str:
    return f"CAST(((2 * CAST({over} AS HUGEINT) * {10**scale} + {under}) // (2 * nullif({under}, 0))) AS DOUBLE) / {10**scale}"


_SPAN = "date_diff('day', CAST(min(played_at) AS DATE), CAST(max(played_at) AS DATE))"
_DAYS = "count(DISTINCT CAST(played_at AS DATE))"
_MS = "CAST(sum(ms_played) AS BIGINT)"
_MINUTES = _ratio("sum(ms_played)", "60000")


def _discovery_sql(view: str) -> str:
    return f"""WITH {view}
SELECT artist_name, min(played_at) AS first_listened, CAST(min(played_at) AS DATE) AS first_listened_date, CAST(year(min(played_at)) AS INTEGER) AS discovery_year,
       CAST(quarter(min(played_at)) AS INTEGER) AS discovery_quarter, CAST(month(min(played_at)) AS INTEGER) AS discovery_month_number, monthname(min(played_at)) AS discovery_month_name,
       CAST(week(min(played_at)) AS INTEGER) AS discovery_week, CAST(day(min(played_at)) AS INTEGER) AS discovery_day, dayname(min(played_at)) AS discovery_weekday,
       CAST(hour(min(played_at)) AS INTEGER) AS discovery_hour, strftime(min(played_at), '%-I %p') AS discovery_hour_label,
       count(*) AS lifetime_streams, count(DISTINCT track_name) AS unique_tracks, {_MS} AS lifetime_ms_played, {_MINUTES} AS lifetime_minutes
FROM E GROUP BY artist_name"""


def _loyalty_sql(view: str) -> str:
    return f"""WITH {view}
SELECT artist_name, min(played_at) AS first_listened, max(played_at) AS most_recent_listened, CAST({_SPAN} AS INTEGER) AS listening_span_days, count(*) AS total_streams,
       count(DISTINCT track_name) AS unique_tracks, count(DISTINCT album_name) AS unique_albums, {_DAYS} AS active_days, count(DISTINCT year(played_at)) AS active_years,
       {_MINUTES} AS total_minutes, {_ratio("count(*)", "count(DISTINCT year(played_at))")} AS avg_streams_per_year,
       {_ratio("sum(ms_played)", f"({_DAYS} * 60000)")} AS avg_minutes_per_active_day, {_ratio("count(*)", _SPAN)} AS avg_streams_per_day
FROM E GROUP BY artist_name"""


def _forgotten_sql(view: str) -> str:
    return f"""WITH {view}
SELECT artist_name, count(*) AS lifetime_streams, {_MINUTES} AS lifetime_minutes, min(played_at) AS first_listened, max(played_at) AS last_listened,
       CAST(date_diff('day', CAST(max(played_at) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_listened, count(DISTINCT track_name) AS unique_tracks,
       count(DISTINCT album_name) AS unique_albums, {_DAYS} AS active_days, {_ratio("count(*)", _DAYS)} AS avg_streams_per_active_day
FROM E GROUP BY artist_name
HAVING count(*) >= 25 AND date_diff('day', CAST(max(played_at) AS DATE), DATE '{AS_OF}') >= 90"""


def _numbered_sql(view: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""{view}, gaps AS (
  SELECT *, lag(played_at) OVER ({part} ORDER BY played_at) AS previous FROM E
), marks AS (
  SELECT *, CASE WHEN previous IS NULL OR played_at - previous >= INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS new FROM gaps
), numbered AS (
  SELECT *, CAST(sum(new) OVER ({part} ORDER BY played_at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id FROM marks
)"""


def _sessions_sql(view: str, by: str = "") -> str:
    return f"""WITH {_numbered_sql(view, by)}
SELECT {by + "," if by else ""} session_id, min(played_at) AS session_start, max(played_at) AS session_end, CAST(date_sub('minute', min(played_at), max(played_at)) AS BIGINT) AS session_length_minutes,
       count(*) AS streams, count(DISTINCT artist_name) AS artists, count(DISTINCT album_name) AS albums, {_MINUTES} AS music_minutes
FROM numbered GROUP BY {by + "," if by else ""} session_id"""


_REPEATS_SQL = f"""WITH {_l_sql()}
SELECT track_id, track_uri, track_name, artist_name, album_name, count(*) AS total_streams, {_MINUTES} AS total_minutes, min(played_at) AS first_listened, max(played_at) AS last_listened,
       CAST({_SPAN} AS INTEGER) AS listening_span_days, {_DAYS} AS active_days, {_ratio("count(*)", _DAYS)} AS avg_streams_per_active_day, {_ratio("count(*)", _SPAN, 4)} AS avg_streams_per_day
FROM E GROUP BY track_id, track_uri, track_name, artist_name, album_name"""


def _orders_as_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("played_at"), F.col("o_custkey").cast("string").alias("artist_name"), F.col("o_orderpriority").alias("album_name"), F.round(F.col("o_totalprice") * 100).cast("long").alias("ms_played")
    )


_ORDERS_SQL = """E AS (
  SELECT o_orderdate AS played_at, CAST(o_custkey AS VARCHAR) AS artist_name, o_orderpriority AS album_name, CAST(round(o_totalprice * 100) AS BIGINT) AS ms_played FROM orders
)"""


def calendar_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = calendar.with_calendar(plays(spark, sf_dir).select("track_id", "played_at"))
    return parts


def hour_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays(spark, sf_dir).select("track_id", calendar.hour_label("played_at").alias("by_format"), calendar.hour_label_by_cases("played_at").alias("by_cases"))


_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.dedup_first(_read(spark, sf_dir, "lineitem").select(*_LINE_KEY, *_LINE_REST), _LINE_KEY, _LINE_REST)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads that overlap: orders up to 60 hundredths, and from 40 on."""
    lines = _read(spark, sf_dir, "lineitem").select(*_LINE_KEY, *_LINE_REST)
    return lines.filter("l_orderkey % 100 < 60"), lines.filter("l_orderkey % 100 >= 40")


def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _halves(spark, sf_dir)
    base = merge.dedup_first(first, _LINE_KEY, _LINE_REST).withColumn("load", F.lit(1))
    return base.unionByName(merge.new_rows(second.withColumn("load", F.lit(2)), base, _LINE_KEY, _LINE_REST))


_KEPT_SQL = """first AS (
  SELECT * FROM lineitem WHERE l_orderkey % 100 < 60 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {rest}) = 1
), second AS (
  SELECT * FROM lineitem WHERE l_orderkey % 100 >= 40 AND NOT EXISTS (SELECT 1 FROM first f WHERE f.l_orderkey = lineitem.l_orderkey AND f.l_linenumber = lineitem.l_linenumber)
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {rest}) = 1
)""".format(rest=", ".join(_LINE_REST))
_LINE_COLS = ", ".join([*_LINE_KEY, *_LINE_REST])


def snapshot_latest_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest(_read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"), 50, F.desc("ts"), "event_id")


_MARK = datetime.datetime(2024, 1, 15, 12, 0, 0)


def watermark_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return merge.newer_than(events, "ts", merge.watermark(events.filter(F.col("ts") <= F.lit(_MARK)), "ts"))


def _liked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").filter("p_size <= 10").select("p_partkey")


def flag_member_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return merge.flag_members(lines, _liked(spark, sf_dir), "l_partkey", "p_partkey", "is_liked")


_FLAG_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, EXISTS (SELECT 1 FROM part WHERE p_size <= 10 AND p_partkey = l_partkey) AS is_liked FROM lineitem"


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping sources of orders; the first wins."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    one = orders.filter("o_orderkey % 10 < 6").withColumn("source", F.lit("export"))
    two = orders.filter("o_orderkey % 10 >= 4").withColumn("source", F.lit("api"))
    return merge.union_first(["o_orderkey"], one, two, order=["o_custkey", "o_orderdate"])


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select("event_id", F.when(k % 3 != 0, k).alias("k")).filter(F.col("k").isNotNull())


def case_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratio whose divisor is often zero, and cases over the value."""
    cents = F.round(F.col("value") * 100).cast("long")
    k = F.get_json_object("props", "$.k").cast("long") % 4
    level = F.when(F.col("value") < 100, "low").when(F.col("value") < 300, "middle").otherwise("high")
    return _read(spark, sf_dir, "events").select("event_id", level.alias("level"), exactmath.ratio(cents, k).alias("share"), exactmath.half_up(cents, k).alias("share_whole"))


def date_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cut = F.when(F.col("o_orderkey") % 3 == 0, F.substring(day, 1, 4)).when(F.col("o_orderkey") % 3 == 1, F.substring(day, 1, 7)).otherwise(day)
    return _read(spark, sf_dir, "orders").select("o_orderkey", cut.alias("given")).select("o_orderkey", "given", calendar.widen_date("given").alias("release_date"))


def strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat(F.lit("part:track:"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))
    return _read(spark, sf_dir, "part").select("p_partkey", text.track_id(uri).alias("id"), text.strip_zeros(text.track_id(uri)).alias("short_id"), F.concat(F.col("p_brand"), F.lit(" / "), F.col("p_type")).alias("label"), F.length("p_name").cast("long").alias("name_length"))


def join_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of each order, named in order, in one text."""
    lines = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", F.struct(F.col("s_name").alias("name")).alias("artist"))
    own = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("artist")).alias("artists"))  # an order has a few lines
    return own.select("l_orderkey", text.join_names("artists").alias("names"))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN as null: a value that is not a number has no place in a sum."""
    from .sources.files import without_nan

    df = _read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return without_nan(df)


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report table as one CSV file and back, with texts that need quotes, and whether the file begins with its mark and header."""
    from .session import shared_path
    from .sources.export import export_csv
    from .sources.files import read_csv

    report = analytics.discovery(plays(spark, sf_dir)).withColumn("note", F.concat(F.lit('a,"'), F.col("artist_name"), F.lit('"')))
    path = export_csv(report, f"{shared_path(spark, 'export')}.csv")
    marked = spark.read.format("binaryFile").load(path).select(F.hex(F.substring("content", 1, 3)) == "EFBBBF").first()[0]
    return read_csv(spark, path, report.schema).withColumn("marked", F.lit(marked))


def yearly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and minutes by year and hour, as the reports show them."""
    df = calendar.with_calendar(star(spark, sf_dir, "o_custkey")).groupBy("year", "hour_label").agg(F.count(F.lit(1)).alias("streams"), F.sum("ms_played").alias("ms"))
    return df.select("year", "hour_label", "streams", exactmath.minutes(F.col("ms")).alias("total_minutes"))


def top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most played artists of each year, ties by name."""
    from pyspark.sql import Window

    own = star(spark, sf_dir).groupBy(F.year("played_at").alias("year"), "artist_name").agg(F.count(F.lit(1)).alias("streams"))
    rank = F.row_number().over(Window.partitionBy("year").orderBy(F.desc("streams"), "artist_name"))
    return own.withColumn("place", rank).filter("place <= 10")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "artist_discovery": lambda s, d: analytics.discovery(plays(s, d)),
    "artist_discovery_star": lambda s, d: analytics.discovery(star(s, d)),
    "artist_loyalty": lambda s, d: analytics.loyalty(plays(s, d)),
    "artist_loyalty_star": lambda s, d: analytics.loyalty(star(s, d)),
    "forgotten_favorites": lambda s, d: analytics.forgotten(star(s, d, "o_custkey"), AS_OF),
    "listening_sessions": lambda s, d: analytics.listening_sessions(plays(s, d)),
    "listening_sessions_ties": lambda s, d: analytics.listening_sessions(_orders_as_plays(s, d)),
    "listening_sessions_by_user": lambda s, d: analytics.listening_sessions_by(plays(s, d), "artist_name"),
    "session_ids": lambda s, d: sessions.number_global(plays(s, d).select("track_id", "played_at")),
    "repeat_behavior": lambda s, d: analytics.repeats(star(s, d)),
    "calendar_dims": calendar_dims,
    "hour_label": hour_labels,
    "dedup_first": dedup_first,
    "insert_ignore": insert_ignore,
    "snapshot_latest_50": snapshot_latest_50,
    "watermark_increment": watermark_increment,
    "flag_member_join": flag_member_join,
    "union_sources": union_sources,
    "filter_not_null": filter_not_null,
    "case_guard": case_guard,
    "date_widen": date_widen,
    "strings": strings,
    "join_names": join_names,
    "nan_to_null": rejected_rows,
    "export_roundtrip": export_roundtrip,
    "yearly_summary": yearly_summary,
    "top_artists": top_artists,
    "discovery_order": lambda s, d: tables._placed(analytics.discovery(plays(s, d), ordered=False), "first_listened", key=["artist_name"]),
    "loyalty_order": lambda s, d: tables._placed(analytics.loyalty(plays(s, d), ordered=False), "-total_minutes", key=["artist_name"]),
    "forgotten_order": lambda s, d: tables._placed(analytics.forgotten(star(s, d, "o_custkey"), AS_OF, ordered=False), "-lifetime_minutes", "-days_since_last_listened", key=["artist_name"]),
    "sessions_order": lambda s, d: tables._placed(analytics.listening_sessions(plays(s, d), ordered=False), "session_start"),
    "repeats_order": lambda s, d: tables._placed(analytics.repeats(star(s, d), ordered=False), "-total_streams", key=analytics.REPEAT_KEYS),
    **tables.QUERIES,
}

ORACLE_SQL: dict[str, str] = {
    "artist_discovery": _discovery_sql(E_SQL),
    "artist_discovery_star": _discovery_sql(_l_sql()),
    "artist_loyalty": _loyalty_sql(E_SQL),
    "artist_loyalty_star": _loyalty_sql(_l_sql()),
    "forgotten_favorites": _forgotten_sql(_l_sql("o_custkey")),
    "listening_sessions": _sessions_sql(E_SQL),
    "listening_sessions_ties": _sessions_sql(_ORDERS_SQL),
    "listening_sessions_by_user": _sessions_sql(E_SQL, "artist_name"),
    "session_ids": f"WITH {_numbered_sql(E_SQL)} SELECT track_id, played_at, session_id FROM numbered",
    "repeat_behavior": _REPEATS_SQL,
    "calendar_dims": f"""WITH {E_SQL}
SELECT track_id, played_at, CAST(played_at AS DATE) AS date, CAST(year(played_at) AS INTEGER) AS year, CAST(quarter(played_at) AS INTEGER) AS quarter, CAST(month(played_at) AS INTEGER) AS month_number,
       monthname(played_at) AS month_name, CAST(week(played_at) AS INTEGER) AS week, CAST(day(played_at) AS INTEGER) AS day, CAST(isodow(played_at) AS INTEGER) AS weekday_number, dayname(played_at) AS weekday_name,
       CAST(hour(played_at) AS INTEGER) AS hour, strftime(played_at, '%-I %p') AS hour_label, strftime(played_at, '%H:%M:%S') AS time
FROM E""",
    "hour_label": f"WITH {E_SQL} SELECT track_id, strftime(played_at, '%-I %p') AS by_format, strftime(played_at, '%-I %p') AS by_cases FROM E",
    "dedup_first": f"SELECT {_LINE_COLS} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_REST)}) = 1",
    "insert_ignore": f"WITH {_KEPT_SQL} SELECT {_LINE_COLS}, 1 AS load FROM first UNION ALL SELECT {_LINE_COLS}, 2 AS load FROM second",
    "insert_ignore_counts": f"WITH {_KEPT_SQL}, n AS (SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey % 100 >= 40) AS processed, (SELECT count(*) FROM second) AS inserted) SELECT processed, inserted, processed - inserted AS skipped, CAST(0 AS BIGINT) AS again FROM n",
    "snapshot_latest_50": "SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 50",
    "watermark_increment": f"SELECT event_id, ts, user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{_MARK}')",
    "global_max_watermark": "SELECT max(ts) AS latest FROM events",
    "flag_member_join": _FLAG_SQL,
    "flag_exists": _FLAG_SQL,
    "update_join": "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag = 'R' OR EXISTS (SELECT 1 FROM part WHERE p_size <= 10 AND p_partkey = l_partkey) AS is_liked FROM lineitem",
    "union_sources": "SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderkey % 10 < 6 THEN 'export' ELSE 'api' END AS source FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey, o_orderdate) = 1",
    "filter_not_null": "SELECT event_id, k FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) WHERE k % 3 <> 0",
    "case_guard": f"""WITH c AS (SELECT event_id, value, CAST(round(value * 100) AS BIGINT) AS cents, CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS k FROM events)
SELECT event_id, CASE WHEN value < 100 THEN 'low' WHEN value < 300 THEN 'middle' ELSE 'high' END AS level, {_ratio("cents", "k")} AS share, {_ratio("cents", "k")} AS share_whole FROM c""",
    "date_widen": """WITH g AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS given FROM orders)
SELECT o_orderkey, given, CAST(CASE length(given) WHEN 4 THEN given || '-01-01' WHEN 7 THEN given || '-01' ELSE given END AS DATE) AS release_date FROM g""",
    "strings": "SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS id, CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS short_id, p_brand || ' / ' || p_type AS label, CAST(length(p_name) AS BIGINT) AS name_length FROM part",
    "join_names": "SELECT l_orderkey, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS names FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey",
    "nan_to_null": "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events",
    "export_roundtrip": f"""SELECT *, 'a,"' || artist_name || '"' AS note, TRUE AS marked FROM ({_discovery_sql(E_SQL)})""",
    "yearly_summary": f"WITH {_l_sql('o_custkey')} SELECT CAST(year(played_at) AS INTEGER) AS year, strftime(played_at, '%-I %p') AS hour_label, count(*) AS streams, {_MINUTES} AS total_minutes FROM E GROUP BY 1, 2",
    "top_artists": f"""WITH {_l_sql()}, n AS (SELECT CAST(year(played_at) AS INTEGER) AS year, artist_name, count(*) AS streams FROM E GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY streams DESC, artist_name) AS INTEGER) AS place FROM n QUALIFY place <= 10""",
    "discovery_order": tables._order_sql(_discovery_sql(E_SQL), "first_listened", "first_listened"),
    "loyalty_order": tables._order_sql(_loyalty_sql(E_SQL), "total_minutes DESC", "total_minutes"),
    "forgotten_order": tables._order_sql(_forgotten_sql(_l_sql("o_custkey")), "lifetime_minutes DESC, days_since_last_listened DESC", "lifetime_minutes, days_since_last_listened"),
    "sessions_order": tables._order_sql(_sessions_sql(E_SQL), "session_start", "session_start"),
    "repeats_order": tables._order_sql(_REPEATS_SQL, "total_streams DESC", "total_streams"),
    "export_history": f"WITH {tables._EXPORT_SQL} {tables._EXPORT_ROWS_SQL}",
    "history_import": f"WITH {tables._EXPORT_SQL} {tables._EXPORT_ROWS_SQL}",
    "import_log": """WITH n AS (SELECT count(*) AS c FROM events WHERE event_id % 5 <> 0)
SELECT CAST(id AS BIGINT) AS run_id, 'history' AS pipeline_name, CASE WHEN id < 3 THEN 'Success' ELSE 'Failed' END AS status, CASE WHEN id < 3 THEN c ELSE 0 END AS recent_downloaded,
       CASE WHEN id = 1 THEN c ELSE 0 END AS recent_inserted, TRUE AS timed, id = 3 AS has_error FROM n, (VALUES (1), (2), (3)) AS t(id)""",
    "history_rebuild": _loyalty_sql(f"{tables._EXPORT_SQL}, E AS (SELECT * FROM H)"),
    "history_export": _loyalty_sql(f"{tables._EXPORT_SQL}, E AS (SELECT * FROM H)"),
    "api_history": tables._API_SQL,
    "recent_snapshot": f"""WITH {tables._RECENT_SQL}, p AS (SELECT *, event_id % greatest(1, (SELECT count(*) FROM events) // {tables.FILE_ROWS}) AS page FROM R)
SELECT played_at, track_id, track_uri, track_name, artist_name, album_name, duration_ms FROM p WHERE page = 0
QUALIFY row_number() OVER (PARTITION BY played_at, track_id ORDER BY duration_ms, track_name, artist_name, album_name) = 1""",
    "liked_library": tables._LIKED_SQL,
    "insert_ignore_table": f"WITH {_KEPT_SQL} SELECT {_LINE_COLS}, 1 AS load FROM first UNION ALL SELECT {_LINE_COLS}, 2 AS load FROM second",
    "append_table": "WITH o AS (SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS appended FROM orders) SELECT * FROM o UNION ALL SELECT * FROM o WHERE o_orderkey % 2 = 0",
    "replace_snapshot": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0",
    "migration": tables._MIGRATION_SQL,
    "script_run": "SELECT o_custkey, count(*) AS n, 'a;b' AS mark FROM orders GROUP BY o_custkey UNION ALL SELECT -1, 0, 'it''s; so'",
    "csv_backup": """SELECT p_partkey, p_name || ', "x"' || chr(10) || p_brand AS label, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS p_type, p_size FROM part""",
    "table_columns": tables._COLUMNS_SQL,
    "guards": tables._GUARDS_SQL,
    "loyalty_refreshed": _loyalty_sql(E_SQL),
    "sessions_refreshed": _sessions_sql(E_SQL),
    "keyed_lookup": tables._LOOKUP_SQL,
    "checked_load": tables._CHECKED_SQL,
    "database_insert": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 < 6 THEN 1 ELSE 2 END AS source FROM orders",
    "late_sessions": tables._LATE_SQL,
    "library_stream": tables._LIBRARY_STREAM_SQL,
    "quarantine": "SELECT 'incomplete' AS reason, CAST(o_orderkey AS VARCHAR) AS track_id FROM orders WHERE o_orderkey % 4 = 0 GROUP BY o_orderkey, date_trunc('second', o_orderdate) UNION ALL SELECT 'unreadable', NULL",
    "stream_ingest": f"WITH {tables._RECENT_SQL} SELECT DISTINCT played_at, track_id, 'api' AS source, strftime(played_at, '%-I %p') AS hour_label FROM R",
    "stream_sessions": tables._STREAM_SESSIONS_SQL,
    "artist_loyalty_folded": "SELECT event_type AS artist_name, count(*) AS total_streams, CAST(1 AS BIGINT) AS unique_tracks, CAST(1 AS BIGINT) AS unique_albums, count(DISTINCT CAST(ts AS DATE)) AS active_days FROM events GROUP BY event_type",
}
