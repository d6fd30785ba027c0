"""Single-file CSV for reporting tools: UTF-8 with a byte-order mark, booleans as 0 and 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def printable(df: DataFrame) -> DataFrame:
    """Booleans as 0 and 1, times without a zone, to the second."""
    kinds = {f.name: f.dataType for f in df.schema}
    out = {}
    for name, kind in kinds.items():
        if isinstance(kind, T.BooleanType):
            out[name] = F.col(name).cast("int")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            out[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(out) if out else df


def export_csv(df: DataFrame, path: str) -> str:
    """Write ``df`` as one file at ``path``, any store that Hadoop reaches.

    Tasks write parts without headers in order; the driver then streams a mark, the header and the parts into one
    file by Hadoop's own file system, so no rows pass through Python. A report's file is read by one person's
    tool; for large tables write folders instead.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    target = Path(path)
    parts = Path(path + ".parts")
    fs = target.getFileSystem(conf)
    printable(df).write.mode("overwrite").option("header", False).option("escape", '"').csv(path + ".parts")
    try:
        out = fs.create(target, True)
        try:
            out.write(bytearray(b"\xef\xbb\xbf" + ",".join(_quoted(c) for c in df.columns).encode() + b"\n"))
            names = sorted(f.getPath().toString() for f in fs.listStatus(parts) if f.getPath().getName().startswith("part-"))
            for name in names:
                data = fs.open(Path(name))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)
                data.close()
        finally:
            out.close()
    finally:
        fs.delete(parts, True)
    return path


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(c in name for c in ',"\n') else name


def export_tables(spark: SparkSession, tables: list[str], folder: str) -> list[str]:
    """Each table as ``folder``/name.csv."""
    return [export_csv(spark.table(t), f"{folder.rstrip('/')}/{t}.csv") for t in tables]
