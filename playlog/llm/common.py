"""What the operators share: shared storage, staging, Arrow batches and distributed ranks."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of an Arrow batch: texts can be long, so both are bounded; a single row is never split.
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves local sessions; a cluster session raises, since a
    machine-local folder would lose rows there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="playlog-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_staged: list[str] = []
_ends: list = []


class Scope:
    """What one piece of work has staged: it owns these tables, and nobody else's."""

    def __init__(self):
        self.paths: list[str] = []

    def sweep(self, spark: SparkSession) -> int:
        """Delete them; call it once the results that rest on them are written. Returns how many went."""
        gone, self.paths = self.paths, []
        return sweep(spark, gone)


_scope: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def scope() -> Iterator[Scope]:
    """What is staged inside, by this thread, belongs to the scope; an inner scope's tables are the inner one's only."""
    own = Scope()
    held = _scope.set(own)
    try:
        yield own
    finally:
        _scope.reset(held)


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing uses yet; it goes with its ``scope``'s or the next ``sweep``, or when the process ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if not _ends:
        _ends.append(atexit.register(_sweep_at_end, spark))
    _staged.append(path)
    if own := _scope.get():
        own.paths.append(path)
    return path


def staged() -> list[str]:
    """What this process has staged and not swept yet, oldest first."""
    return list(_staged)


def sweep(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete what this process has staged so far, or those ``paths`` of it; call it once the results that rest on it are written. Returns how many went."""
    gone = [p for p in _staged if paths is None or p in paths]
    _staged[:] = [p for p in _staged if p not in gone]
    conf, Path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    return sum(bool(Path(p).getFileSystem(conf).delete(Path(p), True)) for p in gone)


def _sweep_at_end(spark: SparkSession) -> None:
    try:
        if spark._jsc is not None:
            sweep(spark)
    except Exception:  # the session may be gone; what is left then goes with the folder
        pass


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: this cuts the lineage, survives lost
    executors, and fixes values such as generated ids for every later reader."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most_bytes``, a single longer row by itself; nothing is copied."""
    for batch in batches:
        todo = [batch]
        while todo:
            own = todo.pop()
            if own.nbytes <= most_bytes or own.num_rows < 2:
                yield own
            else:
                half = own.num_rows // 2
                todo += [own.slice(half), own.slice(0, half)]


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """``mapInArrow`` with small batches, so that memory stays bounded with long texts; state fewer bytes where a row grows in ``fn``.

    The session's own batch settings hold where it has any; else they are set once, to the same values for all operators.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if conf.get(f"spark.sql.execution.arrow.{name}", None) is None:
            conf.set(f"spark.sql.execution.arrow.{name}", str(most))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(pieces(batches, most_bytes))

    return df.mapInArrow(bounded, schema)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A unique id for each row. Stage the result before reading it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


#: Buckets whose offsets one task sums up, about.
RANGE = 1 << 17


def ranked(df: DataFrame, groups: list[str], order: Column, bucket: Column, rank: str) -> DataFrame:
    """Gapless rank from 0 within ``groups``, without a window over a whole group.

    Rows are counted by (groups, bucket); running counts over that table give each bucket its offset, and
    ``row_number`` numbers the rows of one bucket only. The table of buckets grows with the rows, so it is ranged over
    tasks, each of which sums up its own part, and a row for each part and group carries on what came before.
    ``bucket`` must be orderable and spread rows evenly; rows are ordered by (bucket, order).
    """
    from pyspark.sql import Window

    b, n, off, part = f"__{rank}_bucket", f"__{rank}_n", f"__{rank}_offset", f"__{rank}_part"
    df = df.withColumn(b, bucket)
    sizes = stage(df.groupBy(*groups, b).agg(F.count(F.lit(1)).alias(n)), "rank-sizes")
    parts = max(1, -(-sizes.count() // RANGE))
    if parts > 1:
        ranged = stage(sizes.repartitionByRange(parts, *groups, b).withColumn(part, F.spark_partition_id()), "rank-parts")
    else:
        ranged = sizes.withColumn(part, F.lit(0))
    up_to = (Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*groups, part).agg(F.sum(n).alias("__n"))
    held = totals.withColumn("__held", F.coalesce(F.sum("__n").over(Window.partitionBy(*groups).orderBy(part).rowsBetween(*up_to)), F.lit(0)))
    held = held.select(*(F.col(c).alias(f"__in_{k}") for k, c in enumerate([*groups, part])), "__held")
    here = F.coalesce(F.sum(n).over(Window.partitionBy(part, *groups).orderBy(b).rowsBetween(*up_to)), F.lit(0))
    inner_on = [F.col(c).eqNullSafe(F.col(f"__in_{k}")) for k, c in enumerate([*groups, part])]
    summed = ranged.withColumn(off, here).join(held, inner_on)
    offsets = summed.select(*(F.col(c).alias(f"__of_{k}") for k, c in enumerate([*groups, b])), (F.col(off) + F.col("__held")).alias(off))
    offsets = stage(offsets, "rank-offsets")
    on = [F.col(c).eqNullSafe(F.col(f"__of_{k}")) for k, c in enumerate([*groups, b])]
    joined = df.join(offsets, on, "inner").select(*df.columns, off)
    inner = Window.partitionBy(*groups, b).orderBy(order)
    return joined.withColumn(rank, F.col(off) + F.row_number().over(inner) - 1).drop(b, off)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first numbered form of it that no column has."""
    held = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{k}" for k in range(len(held) + 1))) if n.lower() not in held)


def ids(df: DataFrame, *more: str) -> DataFrame:
    """The columns doc_id, as a long, and ``more``."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), *more)


def keep_rows(df: DataFrame, wanted: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows that ``wanted`` marks, with all columns of ``df`` as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted(batch), pa.bool_()))

    return map_arrow(df, run, df.schema)


def text_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column's texts as UTF-8, null as empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column's texts, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def crc_of_id(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fixed split of rows into learned and held-out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus
