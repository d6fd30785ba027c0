"""Small text functions of the normalisers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def track_id(uri: str | Column, service: str | None = None) -> Column:
    """The id in a ``service:track:id`` uri: the first part goes wherever it stands, and a text without it is taken whole.

    Without a ``service``, the part goes that begins the uri, whatever its name.
    """
    return F.regexp_replace(uri, "^[a-z]+:track:", "") if service is None else F.replace(F.col(uri) if isinstance(uri, str) else uri, F.lit(f"{service}:track:"), F.lit(""))


def join_names(artists: str | Column) -> Column:
    """The names of an array of structs, joined by a comma and a space; null names are left out."""
    names = F.transform(artists, lambda a: a["name"]) if not isinstance(artists, str) else F.col(f"{artists}.name")
    return F.array_join(names, ", ")


def strip_zeros(text: str | Column) -> Column:
    """Without leading zeros."""
    return F.regexp_replace(text, "^0+", "")


def fold_key(text: str | Column) -> Column:
    """``text`` as a value that compares without regard to case and accents."""
    return F.collate(text, "UNICODE_CI_AI")


def fold_case(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` compared without regard to case and accents in later groups, joins and distinct counts.

    The library compares exactly by default; a database whose collation folds case gives these results instead.
    """
    return df.withColumns({c: fold_key(c) for c in columns})
