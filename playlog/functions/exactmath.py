"""Ratios that round half up on exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(over: Column, under: Column, scale: int = 2) -> Column:
    """over / under of whole numbers, rounded half up at ``scale``, as a double; null where ``under`` is 0 or null."""
    top = over.cast("decimal(28,6)")
    low = F.nullif(under.cast("decimal(10,0)"), F.lit(0).cast("decimal(10,0)"))
    return F.round(top / low, scale).cast("double")


def minutes(ms: Column, scale: int = 2) -> Column:
    """Milliseconds as minutes."""
    return ratio(ms, F.lit(60_000), scale)


def half_up(over: Column, under: Column, scale: int = 2) -> Column:
    """The same by whole-number arithmetic, for numbers that are not negative and below 9e18 / 10**scale / 2."""
    low = F.nullif(under.cast("bigint"), F.lit(0).cast("bigint"))
    return (F.floor((over.cast("bigint") * 2 * 10**scale + low) / (low * 2)) / 10**scale).cast("double")
