"""Incremental ingest: every micro-batch is loaded by key, so replays add nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import model
from ..operators.merge import insert_ignore
from ..plans import normalize


def stream_files(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "json") -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(kind).schema(schema).load(folder)


def ingest_recent(items: DataFrame, table: str, checkpoint: str, liked: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Load streamed recent-play items into the event table; a batch that is replayed after a failure inserts nothing twice."""

    def load(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        likes = spark.table(liked) if liked else None
        events = normalize.valid(normalize.from_recent(normalize.flatten_recent(batch), likes))
        insert_ignore(events, table, model.EVENT_KEY, ["track_name"], model.EVENT_LOCATED)

    writer = items.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 minutes")).start()


def session_windows(events: DataFrame, key: str, gap_minutes: int = 30, lateness: str = "1 day") -> DataFrame:
    """Sessions of each key over a stream, final once the watermark has passed them.

    A gap of exactly the limit parts two sessions, so the window's gap is the limit less a microsecond, the finest time there is.
    """
    micros = gap_minutes * 60_000_000 - 1
    gap = f"{micros // 1_000_000} seconds {micros % 1_000_000} microseconds"
    timed = events.withColumn("__t", F.col("played_at").cast("timestamp")).withWatermark("__t", lateness)
    own = timed.groupBy(key, F.session_window("__t", gap).alias("w")).agg(F.min("__t").alias("a"), F.max("__t").alias("b"), F.count(F.lit(1)).alias("streams"), F.sum("ms_played").alias("ms_played"))
    return own.select(key, F.col("a").cast("timestamp_ntz").alias("session_start"), F.col("b").cast("timestamp_ntz").alias("session_end"), "streams", "ms_played")
