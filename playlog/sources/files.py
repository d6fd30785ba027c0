"""File scans with stated schemas."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..plans.normalize import EXPORT_FIELDS, EXPORT_URI_SUFFIX


def export_schema(service: str) -> T.StructType:
    """The fields that are read of an exported history; ``service`` begins the uri field's name."""
    kinds = {"ms_played": T.LongType(), "shuffle": T.BooleanType(), "skipped": T.BooleanType()}
    return T.StructType([T.StructField(k, kinds.get(k, T.StringType())) for k in [*EXPORT_FIELDS, f"{service}{EXPORT_URI_SUFFIX}"]])


def read_export(spark: SparkSession, folder: str, service: str, lines: bool = False, corrupt: str | None = None) -> DataFrame:
    """All JSON files of an exported history; a folder without any raises FileNotFoundError.

    An array file is one task; ``lines`` reads files of one object a line, in parallel. A file or row that can't be
    read as the schema says raises when the rows are computed; with ``corrupt``, it is a row whose text is in that
    column and whose other columns are null, so that the caller can put it aside (``split_corrupt``).
    """
    reader, schema = spark.read.option("multiLine", not lines).option("pathGlobFilter", "*.json"), export_schema(service)
    try:
        df = _strict(reader, schema, corrupt).json(folder)
        found = bool(df.inputFiles())
    except AnalysisException as e:
        raise FileNotFoundError(folder) from e
    if not found:
        raise FileNotFoundError(f"no JSON files in {folder}")
    return df


def _strict(reader, schema: T.StructType, corrupt: str | None):
    """The reader with ``schema``, raising at rows that don't fit it or keeping them in the column ``corrupt``."""
    if corrupt is None:
        return reader.option("mode", "FAILFAST").schema(schema)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).schema(T.StructType([*schema, T.StructField(corrupt, T.StringType())]))


def split_corrupt(df: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """The rows that were read, without the column ``corrupt``, and the texts and files of those that weren't."""
    other = next(c for c in df.columns if c != corrupt)  # Spark reads the column of corrupt rows beside another one only
    bad = df.filter(F.col(corrupt).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.coalesce(corrupt, F.col(other).cast("string")).alias("text"))
    return df.filter(F.col(corrupt).isNull()).drop(corrupt), bad


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, corrupt: str | None = None, line_rows: bool = False) -> DataFrame:
    """A CSV file with a header, quotes doubled inside quotes; rows that don't fit the schema raise, or are kept in the column ``corrupt``.

    ``line_rows``: no value holds a line end, so that a large file is split among tasks; else a file is read by one.
    """
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return _strict(spark.read.option("header", True).option("escape", '"').option("multiLine", not line_rows), kinds, corrupt).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts, each with a header, as a raw backup; any number of tasks."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def settings(names: list[str], given: Mapping[str, str] | None = None) -> dict[str, str]:
    """The named settings from ``given`` (the environment, if left out); one that is missing or blank raises KeyError."""
    held = os.environ if given is None else given
    missing = [n for n in names if not held.get(n)]
    if missing:
        raise KeyError(f"settings not found: {', '.join(missing)}")
    return {n: held[n] for n in names}


def read_jdbc(spark: SparkSession, url: str, table: str, split: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A database table, read in ranges of a numeric column if one is named."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split and bounds:
        reader = reader.options(partitionColumn=split, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def without_nan(df: DataFrame) -> DataFrame:
    """NaN in floating columns as null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df
