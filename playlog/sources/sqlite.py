"""Loading a SQLite database in a folder that driver and executors share, on a file system whose locks hold among them.

As in ``jdbc``: tasks write a staging database of the load, then one statement takes over the rows whose key the table
lacks, in one transaction with the load's row in the log. Readers see all of a load or nothing, and a load that is
replayed adds nothing twice. No row passes the driver's Python or JVM but in SQLite's own statement from file to file.
"""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterator
from contextlib import closing
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.merge import dedup_first
from ..session import arrow_uri
from .jdbc import LOADS, _name

#: Rows of a batch that a task sends, rows of a task that reads, and seconds for which a task waits for others.
BATCH, READ_ROWS, WAIT = 50_000, 500_000, 3600
#: SQLite's types; others are refused.
KINDS = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "double": "REAL", "string": "TEXT"}


def _file(spark: SparkSession, path: str) -> str:
    """``path`` as a file's name for all processes."""
    parent, _, name = path.rpartition("/")
    uri = urlparse(arrow_uri(spark, parent, make=True))
    if uri.scheme != "file":
        raise ValueError(f"SQLite needs files, not {path}")
    return f"{uri.path}/{name}"


def _connected(file: str) -> closing:
    return closing(sqlite3.connect(file, timeout=WAIT, isolation_level=None))


def _create(table: str, schema: T.StructType, key: list[str] | tuple[str, ...]) -> str:
    columns = ", ".join(f'"{f.name}" {KINDS[f.dataType.simpleString()]}' for f in schema)
    return f'CREATE TABLE IF NOT EXISTS "{table}" ({columns}, PRIMARY KEY ({", ".join(key)})) WITHOUT ROWID'


def insert_sqlite(df: DataFrame, path: str, table: str, key: list[str] | tuple[str, ...], order: list[str | Column], load: str) -> int:
    """Insert the first row of each new key into a table, which is made if it isn't there; returns how many. ``load`` names the load, which is not done again.

    Rows without a value in every key column are refused, as a primary key would.
    """
    if odd := [f.name for f in df.schema if f.dataType.simpleString() not in KINDS]:
        raise ValueError(f"no type of SQLite's for {', '.join(odd)}")
    file, load, names = _file(df.sparkSession, path), f"{table}:{_name(load)}", df.columns
    staging = f"{file}.{uuid.uuid4().hex}"
    into = f"INSERT OR IGNORE INTO staged VALUES ({', '.join('?' * len(names))})"  # a task that runs again writes the same rows
    at = [names.index(k) for k in key]

    def send(rows: Iterator) -> None:
        with _connected(staging) as connection:
            connection.execute("PRAGMA synchronous = OFF")  # what is lost with the machine is staged anew
            held: list[tuple] = []

            def flush() -> None:
                connection.execute("BEGIN IMMEDIATE")
                connection.executemany(into, held)
                connection.execute("COMMIT")
                held.clear()

            for row in rows:
                if any(row[k] is None for k in at):
                    raise ValueError(f"rows for {table} lack a value of its key")
                held.append(tuple(row))
                if len(held) == BATCH:
                    flush()
            flush()

    with _connected(file) as connection:
        connection.execute(f"CREATE TABLE IF NOT EXISTS {LOADS} (name TEXT NOT NULL PRIMARY KEY, added INTEGER NOT NULL)")
        if connection.execute(f"SELECT 1 FROM {LOADS} WHERE name = ?", (load,)).fetchone():
            return 0
        try:
            with _connected(staging) as own:
                own.execute(_create("staged", df.schema, key))
            dedup_first(df, key, order).select(*names).repartitionByRange(*key).sortWithinPartitions(*key).foreachPartition(send)
            connection.execute(_create(table, df.schema, key))
            connection.execute("ATTACH ? AS load", (staging,))
            connection.execute("BEGIN IMMEDIATE")
            try:
                columns = ", ".join(f'"{c}"' for c in names)
                added = connection.execute(f'INSERT OR IGNORE INTO main."{table}" ({columns}) SELECT {columns} FROM load.staged').rowcount
                connection.execute(f"INSERT INTO {LOADS} VALUES (?, ?)", (load, added))
                connection.execute("COMMIT")
            except BaseException:
                connection.execute("ROLLBACK")
                raise
            connection.execute("DETACH load")
        finally:
            for f in (staging, f"{staging}-journal"):
                if os.path.exists(f):
                    os.remove(f)
    return added


def read_sqlite(spark: SparkSession, path: str, table: str, schema: T.StructType, split: str) -> DataFrame:
    """A table, read in ranges of a column of whole numbers without nulls."""
    file, columns, kinds = _file(spark, path), ", ".join(f'"{f.name}"' for f in schema), to_arrow_schema(schema)
    with _connected(file) as connection:
        least, most, n = connection.execute(f'SELECT min("{split}"), max("{split}"), count(*) FROM "{table}"').fetchone()
    if not n:
        return spark.createDataFrame([], schema)
    parts = -(-n // READ_ROWS)
    width = -(-(most - least + 1) // parts)

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in batch.column(0).to_pylist():
                with _connected(file) as connection:
                    found = connection.execute(f'SELECT {columns} FROM "{table}" WHERE "{split}" >= ? AND "{split}" < ?', (least + k * width, least + (k + 1) * width))
                    while some := found.fetchmany(BATCH):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(kinds, zip(*some), strict=True)], schema=kinds)

    return spark.range(0, parts, 1, parts).mapInArrow(rows, schema)
