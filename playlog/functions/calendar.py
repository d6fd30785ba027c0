"""Calendar parts of a play's time, in native functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_second(ts: str | Column) -> Column:
    """The nearest second, halves up, as zone-less time; calendar parts are derived after it."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("second", col + F.expr("interval 500 milliseconds")).cast("timestamp_ntz")


def hour_label(ts: str | Column) -> Column:
    """12 AM, 1 AM ... 11 PM."""
    return F.date_format(ts, "h a")


def hour_label_by_cases(ts: str | Column) -> Column:
    """The same label from the hour's number."""
    h = F.hour(ts)
    twelve = F.when(h % 12 == 0, 12).otherwise(h % 12)
    return F.concat(twelve.cast("string"), F.when(h < 12, F.lit(" AM")).otherwise(F.lit(" PM")))


def calendar_parts(ts: str) -> dict[str, Column]:
    """Names and columns: ISO weeks, Monday is weekday 1, full English names."""
    c = F.col(ts)
    return {
        "date": F.to_date(c),
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month_number": F.month(c),
        "month_name": F.date_format(c, "MMMM"),
        "week": F.weekofyear(c),
        "day": F.dayofmonth(c),
        "weekday_number": F.weekday(c) + 1,
        "weekday_name": F.date_format(c, "EEEE"),
        "hour": F.hour(c),
        "hour_label": hour_label(c),
        "time": F.date_format(c, "HH:mm:ss"),
    }


def with_calendar(df: DataFrame, ts: str = "played_at") -> DataFrame:
    """``df`` with the calendar parts of ``ts``; null times have null parts."""
    return df.withColumns(calendar_parts(ts))


def widen_date(text: str | Column) -> Column:
    """A release date given as a year, a month or a day, as the first day it can mean; anything else is null."""
    s = F.col(text) if isinstance(text, str) else text
    full = F.when(F.length(s) == 4, F.concat(s, F.lit("-01-01"))).when(F.length(s) == 7, F.concat(s, F.lit("-01"))).otherwise(s)
    return F.try_to_date(full, "yyyy-MM-dd")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Calendar days from one time to another, whatever the hours."""
    return F.datediff(later, earlier)


def whole_minutes(earlier: str, later: str) -> Column:
    """Elapsed minutes, cut to whole ones."""
    return F.expr(f"timestampdiff(MINUTE, {earlier}, {later})")


def parse_zulu(text: str | Column) -> Column:
    """UTC wall time of an ISO-8601 text ending in Z, with or without a fraction; unreadable texts are null."""
    s = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(s, "Z$", "").try_cast("timestamp_ntz")
