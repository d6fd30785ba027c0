"""Loading a database's table: rows are staged by tasks and taken over in one transaction.

Tasks write their partitions in batches to a staging table that belongs to the load; then one statement inside the
database inserts the rows whose key the table lacks, and a row of the load log says that the load is done. Both happen
in one transaction, so readers see all of a load or nothing, and a load that is replayed, whole or after a crash at
any step, adds nothing twice. No row passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.merge import dedup_first

#: Rows of a batch that a task sends, and the table that holds the names of finished loads.
BATCH, LOADS = 1000, "playlog_loads"


@contextmanager
def _connection(spark: SparkSession, url: str, properties: dict[str, str]) -> Iterator:
    """A connection of the driver's, for statements only."""
    jvm = spark._jvm
    if driver := properties.get("driver"):
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(driver).getDeclaredConstructor(spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)).newInstance(spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0))
    own = jvm.java.util.Properties()
    for k, v in properties.items():
        own.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, own)
    try:
        yield connection
    finally:
        connection.close()


def _run(connection, statement: str) -> int:
    prepared = connection.createStatement()
    try:
        return prepared.executeUpdate(statement)
    finally:
        prepared.close()


def _there(connection, table: str) -> bool:
    prepared = connection.createStatement()
    try:
        prepared.executeQuery(f"SELECT 1 FROM {table} WHERE 1 = 0").close()
        return True
    except Exception:
        return False
    finally:
        prepared.close()


def _first(connection, statement: str):
    prepared = connection.createStatement()
    try:
        found = prepared.executeQuery(statement)
        return found.getObject(1) if found.next() else None
    finally:
        prepared.close()


def _name(text: str) -> str:
    if not text.replace("_", "").replace("-", "").isalnum():
        raise ValueError(f"a load's name has letters, digits, - and _ only: {text}")
    return text


def insert_jdbc(df: DataFrame, url: str, table: str, key: list[str] | tuple[str, ...], order: list[str | Column], load: str, column_types: str | None = None, properties: dict[str, str] | None = None) -> int:
    """Insert the first row of each new key into a database's table, which is made, with a unique key, if it isn't there; returns how many.

    Rows without a value in every key column are refused, as a primary key would.

    ``load`` names the load: one that the log has already is not done again. ``column_types`` are those of a new
    table, as in Spark's option createTableColumnTypes; ``properties`` go to the driver.
    """
    spark, properties = df.sparkSession, dict(properties or {})
    staging = f"{table}_load_{_name(load).replace('-', '_')}"
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    with _connection(spark, url, properties) as connection:
        if not _there(connection, LOADS):
            _run(connection, f"CREATE TABLE {LOADS} (name VARCHAR(200) NOT NULL PRIMARY KEY, added BIGINT NOT NULL)")
        if _first(connection, f"SELECT added FROM {LOADS} WHERE name = '{table}:{load}'") is not None:
            return 0
        made = {"createTableColumnTypes": column_types} if column_types else {}
        if not _there(connection, table):
            df.limit(0).write.options(**made).jdbc(url, table, "append", properties)
            _run(connection, f"CREATE UNIQUE INDEX {table.replace('.', '_')}_key ON {table} ({', '.join(map(quote, key))})")
        if _there(connection, staging):  # of this load, when it broke off before
            _run(connection, f"DROP TABLE {staging}")
        dedup_first(df, key, order).write.options(batchsize=str(BATCH), **made).jdbc(url, staging, "append", properties)
        columns = ", ".join(map(quote, df.columns))
        keyless = " OR ".join(f"{quote(k)} IS NULL" for k in key)
        if _first(connection, f"SELECT 1 FROM {staging} WHERE {keyless}") is not None:
            _run(connection, f"DROP TABLE {staging}")
            raise ValueError(f"rows for {table} lack a value of its key")
        same = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in key)
        connection.setAutoCommit(False)
        try:
            added = _run(connection, f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} s WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})")
            _run(connection, f"INSERT INTO {LOADS} VALUES ('{table}:{load}', {added})")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.setAutoCommit(True)
        _run(connection, f"DROP TABLE {staging}")
    return added
