"""Keyed loading: first row of a key, insert-ignore, snapshots, watermarks and membership flags."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager, nullcontext
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold_key
from ..session import shared_path
from .commit import ConcurrentChange, TableLog, write_rows


@dataclass(frozen=True)
class Checks:
    """What every row of a table must fulfil: values that may not be null, values of a list, and greatest lengths."""

    required: tuple[str, ...] = ()
    one_of: dict[str, tuple[str, ...]] = field(default_factory=dict)
    at_most: dict[str, int] = field(default_factory=dict)

    def reason(self, df: DataFrame) -> Column:
        """What a row breaks first, or null; columns that ``df`` lacks count as null."""
        there = set(df.columns)
        broken = [F.when(F.col(c).isNull() if c in there else F.lit(True), F.lit(f"{c} is missing")) for c in self.required]
        broken += [F.when(~F.col(c).isin(*values), F.lit(f"{c} is none of {', '.join(values)}")) for c, values in self.one_of.items() if c in there]
        broken += [F.when(F.char_length(c) > n, F.lit(f"{c} is longer than {n}")) for c, n in self.at_most.items() if c in there]
        return F.coalesce(*broken, F.lit(None).cast("string"))


def dedup_first(df: DataFrame, key: list[str] | tuple[str, ...], order: list[str | Column]) -> DataFrame:
    """The first row of each key in ascending ``order``; keys compare with null as a value of its own.

    The minimum of a struct is combined before the shuffle, so that a key that repeats much stays cheap; every
    other column must be orderable, else a window takes over.
    """
    rest = [c for c in df.columns if c not in key]
    if any(isinstance(df.schema[c].dataType, T.MapType) for c in rest):
        w = Window.partitionBy(*key).orderBy(*order)
        return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
    by = [o if isinstance(o, str) else f"__order{k}" for k, o in enumerate(order)]
    fields = [F.col(o) if isinstance(o, str) else o.alias(n) for o, n in zip(order, by, strict=True)] + [F.col(c) for c in rest if c not in by]
    first = F.min(F.struct(*fields)) if fields else F.lit(None)
    return df.groupBy(*key).agg(first.alias("__first")).select(*[F.col(c) if c in key else F.col("__first")[c].alias(c) for c in df.columns])


def anti_join(batch: DataFrame, base: DataFrame, key: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``base``."""
    held = base.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(key)))
    on = [batch[k].eqNullSafe(held[f"__k{i}"]) for i, k in enumerate(key)]
    return batch.join(held, on, "left_anti")


#: Keys of a batch that travel to the base's tasks: so many at most, and of so many bytes.
LOOKUP_KEYS, LOOKUP_BYTES = 1_000_000, 64 << 20
#: Distinct values that are looked up one by one; beyond, their range is.
LOOKUP_VALUES = 200


def _about(values: Column) -> Column:
    return F.sum(F.coalesce(F.octet_length(values.cast("string")), F.lit(0)) + 16)


def _literal(value, kind: T.DataType) -> Column:
    """A value of a column as a literal of its type; a time without a zone would else become one of the process's zone, and the column be cast to it."""
    return F.lit(str(value)).cast(kind) if isinstance(kind, T.TimestampNTZType) else F.lit(value)


def _bounds(batch: DataFrame, columns: list[str]) -> tuple[int, int, Column]:
    """Rows of ``batch``, bytes of their keys about, and what rows with the same keys must fulfil: in one pass, with one row for the driver."""
    orderable = [c for c in columns if not isinstance(batch.schema[c].dataType, (T.MapType, T.ArrayType, T.StructType))]
    each = [e for i, c in enumerate(orderable) for e in (F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}"), F.max(F.col(c).isNull()).alias(f"n{i}"))]
    found = batch.agg(F.count(F.lit(1)).alias("rows"), sum((_about(F.col(c)) for c in columns), F.lit(0)).alias("bytes"), *each).first()
    inside = F.lit(True)
    for i, c in enumerate(orderable):
        least, most, nulls = found[f"a{i}"], found[f"z{i}"], found[f"n{i}"]
        if least is None:
            inside = inside & F.col(c).isNull()
        elif not (isinstance(least, float) and (math.isnan(least) or math.isnan(most))):
            kind = batch.schema[c].dataType
            within = F.col(c).between(_literal(least, kind), _literal(most, kind))
            inside = inside & (within | F.col(c).isNull() if nulls else within)
    return found["rows"], found["bytes"] or 0, inside


def _narrowed(batch: DataFrame, base: DataFrame, key: list[str] | tuple[str, ...], located: list[str] | tuple[str, ...]) -> tuple[bool, DataFrame]:
    """Whether the keys of ``batch`` are few enough to travel, and ``base`` within their ranges."""
    rows, size, inside = _bounds(batch, [*key, *(c for c in located if c not in key)])
    base = base.filter(inside)
    if located:
        values = [c for c in located if c in base.columns]
        some = batch.select(*values).distinct().limit(LOOKUP_VALUES + 1).collect()
        if len(values) == 1 and 0 < len(some) <= LOOKUP_VALUES and all(r[0] is not None for r in some):
            base = base.filter(F.col(values[0]).isin([r[0] for r in some]))
    return rows <= LOOKUP_KEYS and size <= LOOKUP_BYTES, base


def unheld(batch: DataFrame, base: DataFrame, key: list[str] | tuple[str, ...], located: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``anti_join`` for a batch that is small beside ``base``; ``batch`` is read several times, so it should be a table.

    The ranges of the batch's keys, and of columns that the keys determine (``located``, such as a time's date), reach
    the scan of ``base`` as filters: files and row groups out of range are skipped by the statistics in their footers.
    The keys, if no more than ``LOOKUP_KEYS`` and ``LOOKUP_BYTES``, travel to the tasks that read the rest, so that
    ``base`` isn't shuffled; what comes back are those keys that it holds. More keys are joined by a shuffle.
    """
    fits, base = _narrowed(batch, base, key, located)
    if not fits:
        return anti_join(batch, base, key)
    wanted = batch.select(*(F.col(k).alias(f"__w{i}") for i, k in enumerate(key))).distinct()
    on = [base[k].eqNullSafe(wanted[f"__w{i}"]) for i, k in enumerate(key)]
    held = base.select(*key).join(F.broadcast(wanted), on, "left_semi").distinct()
    return anti_join(batch, F.broadcast(held), key)


def first_unheld(batch: DataFrame, base: DataFrame, key: list[str] | tuple[str, ...], order: list[str | Column]) -> DataFrame:
    """``new_rows`` in one shuffle: the keys of ``base`` are grouped with the batch's rows and come first in their groups."""
    both = batch.withColumn("__new", F.lit(True)).unionByName(base.select(*key).withColumn("__new", F.lit(False)), allowMissingColumns=True)
    first = dedup_first(both, key, ["__new", *order]).filter("__new")
    return first.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if first.schema[f.name].dataType != f.dataType else F.col(f.name) for f in batch.schema))


def new_rows(batch: DataFrame, base: DataFrame, key: list[str] | tuple[str, ...], order: list[str | Column]) -> DataFrame:
    """What insert-ignore adds: the first row of each key of ``batch`` that ``base`` lacks."""
    return dedup_first(anti_join(batch, base, key), key, order)


#: Times a writer computes anew because another one has committed meanwhile.
ATTEMPTS = 20


#: Bytes that a file should have, and below which it is small; small ones of a table that are let be.
FILE_BYTES, SMALL_BYTES, SMALL_FILES = 128 << 20, 16 << 20, 64


def compact(spark: SparkSession, table: str, near: str | None = None) -> int:
    """Write a table into files of about ``FILE_BYTES``, clustered by ``near``, if small files prevail; returns how many files fewer it has.

    That is, if there are more than ``SMALL_FILES`` small ones and more of them than of others: so as many appends have
    come since the last time, and each of them pays for a file at most, however large the table is. Readers keep the
    files that they began with. If another commit comes first, it is left for the next time.
    """
    log = TableLog(spark, table)
    seen, sizes = log.settle(), log.sizes()
    small = sum(n < SMALL_BYTES for n in sizes)
    if small <= max(SMALL_FILES, len(sizes) - small):
        return 0
    rows, parts = spark.table(table), -(-sum(sizes) // FILE_BYTES)
    path = log.fresh("data", seen)
    (rows.repartitionByRange(parts, near).sortWithinPartitions(near) if near else rows.repartition(parts)).write.parquet(path)
    if not log.commit(seen, "replace", path, rows.schema, same=True):
        log.delete(path)
        return 0
    return len(sizes) - len(log.sizes())


def _append(spark: SparkSession, table: str, schema: T.StructType, rows: Callable[[], DataFrame], near: str | None = None) -> int:
    """Append what ``rows`` gives, computed anew whenever another commit came first; returns how many. Now and then, the table is compacted."""
    log = TableLog.create(spark, table, schema)
    for _ in range(ATTEMPTS):
        seen = log.settle()
        own, path = rows().select(*spark.table(table).columns), log.fresh("staged", seen)
        n = write_rows(own, path)
        if n == 0 or log.commit(seen, "append", path, own.schema):
            if n == 0:
                log.delete(path)
            elif (seen + 1) % SMALL_FILES == 0:
                compact(spark, table, near)
            return n
        log.delete(path)
    raise ConcurrentChange(f"{table} changed {ATTEMPTS} times while rows were appended")


@contextmanager
def written_once(df: DataFrame, tag: str = "batch") -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder while the block runs: its source is read once, whatever is then asked of it."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, tag)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        Path = spark._jvm.org.apache.hadoop.fs.Path
        Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(Path(path), True)


class Loaded(NamedTuple):
    """What a load did with its rows; what is neither inserted nor rejected was there already, or repeats another row."""

    processed: int
    inserted: int
    rejected: int


def load(batch: DataFrame, table: str, key: list[str] | tuple[str, ...], order: list[str | Column], located: list[str] | tuple[str, ...] = (), checks: Checks | None = None, rejects: str | None = None, stored: bool = False, fold: list[str] | tuple[str, ...] = ()) -> Loaded:
    """Append to ``table`` the rows of ``batch`` with new keys, the first of each; rows that break ``checks`` go to the table ``rejects``.

    The batch is computed once, unless it is ``stored`` as a table already. The table is made if there is none; its files are clustered by the first of ``located``
    or of the key, which is what lets later loads skip them. A load that another one overtakes looks its keys up anew,
    so that no key is ever inserted twice. Key columns in ``fold`` compare without regard to case and accents, as in
    a database whose collation says so; they are stored as they come.
    """
    spark = batch.sparkSession
    near = (*located, *key)[0]
    with nullcontext(batch) if stored else written_once(batch) as batch:
        processed, rejected = batch.count(), 0
        if checks:
            broken = batch.withColumn("__reason", checks.reason(batch)).filter("__reason is not null")
            rejected = broken.count()
            if rejected and rejects is None:
                raise ValueError(f"{rejected} rows for {table} break its constraints, such as: {broken.first()['__reason']}")
            if rejected:
                put_aside(broken, F.col("__reason"), rejects)
            batch = batch.filter(checks.reason(batch).isNull())
        own = {f"__folded{k}": fold_key(c) for k, c in enumerate(fold)}
        keys = [f"__folded{list(fold).index(k)}" if k in fold else k for k in key]
        folded = batch.withColumns(own)
        first = dedup_first(folded, keys, order)
        schema = first.drop(*own).schema
        log = TableLog.create(spark, table, schema)
        with ExitStack() as open_tables:
            stored_first: list[DataFrame] = []

            def rows() -> DataFrame:
                new = first
                if log.holds_rows() and not spark.table(table).isEmpty():  # a table that was just made has a file without rows
                    fits, base = _narrowed(folded, spark.table(table).withColumns(own), keys, located)
                    if fits and not stored_first:  # it is small, and read several times
                        stored_first.append(open_tables.enter_context(written_once(first, "first-rows")))
                    new = unheld(stored_first[0], spark.table(table).withColumns(own), keys, located) if fits else first_unheld(folded, base, keys, order)
                # by the key too: the rows of one date are no single task's
                return new.drop(*own).repartitionByRange(near, *(k for k in key if k != near)).sortWithinPartitions(near)

            return Loaded(processed, _append(spark, table, schema, rows, near), rejected)


def insert_ignore(batch: DataFrame, table: str, key: list[str] | tuple[str, ...], order: list[str | Column], located: list[str] | tuple[str, ...] = (), checks: Checks | None = None, rejects: str | None = None) -> int:
    """``load``, and how many rows it inserted."""
    return load(batch, table, key, order, located, checks, rejects).inserted


def append(batch: DataFrame, table: str, checks: Checks | None = None, rejects: str | None = None) -> int:
    """Append all rows by name, but for those that break ``checks``, which go to the table ``rejects``; returns how many were appended."""
    spark = batch.sparkSession
    if not checks:
        return _append(spark, table, batch.schema, lambda: batch)
    with written_once(batch) as batch:
        broken = batch.withColumn("__reason", checks.reason(batch)).filter("__reason is not null")
        if broken.limit(1).count():
            if rejects is None:
                raise ValueError(f"rows for {table} break its constraints, such as: {broken.first()['__reason']}")
            put_aside(broken, F.col("__reason"), rejects)
        return _append(spark, table, batch.schema, lambda: batch.filter(checks.reason(batch).isNull()))


def append_numbered(table: str, schema: T.StructType, number: str, row: Callable[[int], tuple], spark: SparkSession) -> int:
    """Append one row under the next free number of column ``number``, which no other writer gets; returns the number."""
    given = []

    def rows() -> DataFrame:
        given.append((spark.table(table).agg(F.max(number)).first()[0] or 0) + 1)
        return spark.createDataFrame([row(given[-1])], schema)

    _append(spark, table, schema, rows)
    return given[-1]


def put_aside(rows: DataFrame, reason: str | Column, table: str) -> int:
    """Append what can't be loaded to a quarantine table (row as JSON, reason, seen_at); returns how many. A column ``__reason`` is no part of a row."""
    row = F.to_json(F.struct(*(c for c in rows.columns if c != "__reason")))
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return append(rows.select(row.alias("row"), reason.alias("reason"), F.current_timestamp().cast("timestamp_ntz").alias("seen_at")), table)


def recover_table(spark: SparkSession, table: str) -> bool:
    """Carry out a commit that broke off, if there is one; returns whether the table is there."""
    if not spark.catalog.tableExists(table):
        return False
    TableLog(spark, table).settle()
    return True


def replace_table(df: DataFrame, table: str, seen: int | None = None) -> None:
    """Truncate and reload, also where ``df`` reads the table: the rows are written beside the old ones, and then the table points to them.

    A crash leaves the old rows or the new ones, never both or a part. If another commit came since ``seen`` (since
    the call, if left out), nothing changes and ``ConcurrentChange`` is raised: ``df`` may rest on rows that are gone.
    """
    log = TableLog.create(df.sparkSession, table, df.schema)
    number = log.settle()
    seen = number if seen is None else seen
    path = log.fresh("data", seen)
    df.write.parquet(path)
    if not log.commit(seen, "replace", path, df.schema):
        log.delete(path)
        raise ConcurrentChange(f"{table} has changed while its rows were replaced")


def latest(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in ``order``, by a top-k on every task and one merge."""
    return df.orderBy(*order).limit(n)


def watermark(df: DataFrame, column: str):
    """The largest value, or None of an empty table."""
    return df.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly after the mark; all rows if there is none. A literal mark reaches the scan as a filter."""
    return df if mark is None else df.filter(F.col(column) > _literal(mark, df.schema[column].dataType))


def flag_members(df: DataFrame, members: DataFrame, on: str, member_key: str, flag: str) -> DataFrame:
    """``df`` with a boolean: whether ``on`` is among the members' keys. Null is no member.

    The members are made distinct and joined by key; adaptive execution broadcasts them if they are small.
    """
    keys = members.select(F.col(member_key).alias("__m")).filter("__m is not null").distinct()
    return df.join(keys, df[on] == keys["__m"], "left").withColumn(flag, F.col("__m").isNotNull()).drop("__m")


def flag_exists(df: DataFrame, members: DataFrame, on: str, member_key: str, flag: str) -> DataFrame:
    """``flag_members`` by a correlated EXISTS, which Catalyst turns into a join that keeps each row once."""
    found = members.filter(F.col(member_key) == F.col(on).outer()).exists()
    return df.withColumn(flag, found)


def update_flag(table: str, members: DataFrame, on: str, member_key: str, flag: str) -> None:
    """Set ``flag`` true for the members' rows of a table and leave all others as they are; rows that come meanwhile are marked too."""
    spark = members.sparkSession
    for _ in range(ATTEMPTS):
        seen = TableLog(spark, table).settle()
        now = spark.table(table)
        marked = flag_members(now, members, on, member_key, "__is")
        try:
            return replace_table(marked.withColumn(flag, F.col("__is") | F.coalesce(F.col(flag), F.lit(False))).select(*now.columns), table, seen)
        except ConcurrentChange:
            continue
    raise ConcurrentChange(f"{table} changed {ATTEMPTS} times while its rows were marked")


def union_first(key: list[str] | tuple[str, ...], *sources: DataFrame, order: list[str | Column]) -> DataFrame:
    """All sources by name, each key once: from the first source that has it, and there the first in ``order``."""
    parts = [df.withColumn("__source", F.lit(k)) for k, df in enumerate(sources)]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return dedup_first(both, key, [F.col("__source"), *order]).drop("__source")


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")
