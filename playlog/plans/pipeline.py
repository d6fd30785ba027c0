"""The scheduled run: extract, load, rebuild, export, and a log row whatever happens."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..operators import merge
from ..sources import export, files
from . import analytics, increments, normalize

#: Name of each derived table and how it comes from the events, in order.
ANALYTICS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "artist_discovery": analytics.discovery,
    "artist_loyalty": analytics.loyalty,
    "forgotten_favorites": analytics.forgotten,
    "listening_session_summary": analytics.listening_sessions,
    "repeat_behavior": analytics.repeats,
}
EVENTS, LIKED, RECENT, RUN_LOG, REJECTED = "listening_events", "liked_tracks", "recent_snapshot", "run_log", "rejected_events"
EXPORTS = [EVENTS, *ANALYTICS, LIKED]


def create_tables(spark: SparkSession) -> None:
    """The core tables, where they aren't there yet; replacements that broke off are finished first."""
    for name, schema in ((EVENTS, model.EVENT), (LIKED, model.LIKED), (RECENT, model.RECENT), (RUN_LOG, model.RUN_LOG), (REJECTED, model.REJECTED)):
        if not merge.recover_table(spark, name):
            model.empty(spark, schema).write.format("parquet").saveAsTable(name)


def rebuild(spark: SparkSession, events: str = EVENTS, only: list[str] | None = None) -> list[str]:
    """Derive the analytics tables anew from the event table; each is written whole and replaces its predecessor."""
    unknown = set(only or ()) - ANALYTICS.keys()
    if unknown:
        raise KeyError(f"no such analytics: {sorted(unknown)}")
    done = []
    for name, make in ANALYTICS.items():
        if only is None or name in only:
            merge.replace_table(make(spark.table(events)), name)
            done.append(name)
    return done


#: What the tables take: required columns, known values, and the lengths of names.
EVENT_CHECKS = merge.Checks(required=model.EVENT_REQUIRED, one_of={"source": model.SOURCES}, at_most=model.LENGTHS)
LIKED_CHECKS = merge.Checks(required=model.LIKED_KEY, at_most=model.LENGTHS)


def log_run(spark: SparkSession, **values) -> int:
    """Append one row to the run log; returns its number, which no other run has."""
    row = lambda number: tuple(number if f.name == "run_id" else values.get(f.name) for f in model.RUN_LOG)
    return merge.append_numbered(RUN_LOG, model.RUN_LOG, "run_id", row, spark)


@dataclass
class Report:
    """What a run did."""

    liked_downloaded: int = 0
    liked_inserted: int = 0
    recent_downloaded: int = 0
    recent_inserted: int = 0
    rejected: int = 0
    rebuilt: list[str] = field(default_factory=list)
    exported: list[str] = field(default_factory=list)


@contextmanager
def _logged(spark: SparkSession, name: str) -> Iterator[Report]:
    """A report to fill in; a row of the run log follows, whether the work ends well or not."""
    create_tables(spark)
    report, start, error = Report(), datetime.datetime.now(datetime.UTC).replace(tzinfo=None), None
    try:
        yield report
    except Exception as e:
        error = re.sub(r"\s+", " ", str(e))[:1000]
        raise
    finally:
        end = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
        try:
            log_run(
                spark, pipeline_name=name, start_time=start, end_time=end, runtime_seconds=round_seconds(end - start), status="Failed" if error else "Success",
                liked_downloaded=report.liked_downloaded, liked_inserted=report.liked_inserted, recent_downloaded=report.recent_downloaded, recent_inserted=report.recent_inserted, error_message=error,
            )
        except Exception:
            if not error:  # a failed log must not hide the run's own error
                raise


def _load_events(events: DataFrame, order: list[str]) -> merge.Loaded:
    """Load stored events; those without a required column go to the quarantine table as incomplete, those that break another constraint with what they break."""
    aside = merge.put_aside(normalize.rejected(events), "incomplete", REJECTED)
    done = merge.load(normalize.valid(events), EVENTS, model.EVENT_KEY, order, model.EVENT_LOCATED, EVENT_CHECKS, REJECTED, stored=True)
    return merge.Loaded(done.processed + aside, done.inserted, done.rejected + aside)


def run(spark: SparkSession, liked_pages: Callable[[datetime.datetime | None], DataFrame], recent_pages: Callable[[], DataFrame], export_folder: str | None = None, name: str = "listening") -> Report:
    """One run. ``liked_pages`` gets the newest time in the library and returns raw items; ``recent_pages`` returns raw items."""
    with _logged(spark, name) as report:
        mark = merge.watermark(spark.table(LIKED), "added_to_library")
        newest_first = [-F.unix_micros(F.col("added_to_library").cast("timestamp")), "track_name"]
        liked = merge.load(merge.newer_than(normalize.flatten_liked(liked_pages(mark)), "added_to_library", mark), LIKED, model.LIKED_KEY, newest_first, checks=LIKED_CHECKS, rejects=REJECTED)
        report.liked_downloaded, report.liked_inserted = liked.processed, liked.inserted
        merge.replace_table(merge.dedup_first(normalize.flatten_recent(recent_pages()), model.RECENT_KEY, ["track_name"]), RECENT)
        with merge.written_once(normalize.from_recent(spark.table(RECENT), spark.table(LIKED)), "recent") as events:
            recent = _load_events(events, ["track_name"])
        report.recent_downloaded, report.recent_inserted, report.rejected = recent.processed, recent.inserted, recent.rejected + liked.rejected
        report.rebuilt = increments.refresh(spark, EVENTS)
        if export_folder:
            report.exported = export.export_tables(spark, EXPORTS, export_folder)
    return report


def import_history(spark: SparkSession, folder: str, service: str, lines: bool = False, strict: bool = True, name: str = "history") -> Report:
    """Load an exported history into the event table; plays that it holds already stay as they are.

    Returns the rows read as ``recent_downloaded`` and the new ones as ``recent_inserted``. Events without a
    required column go to the quarantine table, as do, unless ``strict``, files and rows that can't be read; a
    strict import raises at those and loads nothing.
    """
    with _logged(spark, name) as report:
        raw = files.read_export(spark, folder, service, lines, None if strict else "__corrupt")
        if not strict:
            report.rejected = merge.put_aside(files.split_corrupt(raw, "__corrupt")[1], "unreadable", REJECTED)
            raw = raw.filter("__corrupt is null")
        with merge.written_once(normalize.from_export(raw, uri_field=service + normalize.EXPORT_URI_SUFFIX), "import") as events:
            done = _load_events(events, ["ms_played", "track_name"])
        report.recent_downloaded, report.recent_inserted = done.processed, done.inserted
        report.rejected += done.rejected
    return report


def round_seconds(span: datetime.timedelta):
    from decimal import ROUND_HALF_UP, Decimal

    return (Decimal(span // datetime.timedelta(microseconds=1)) / 1_000_000).quantize(Decimal("0.01"), ROUND_HALF_UP)
