"""Sessions with the settings that the library's results rest on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "playlog", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC times, ANSI arithmetic and adaptive execution.

    On a cluster, leave ``shuffle_partitions`` out and size it in the submit configuration: adaptive execution
    coalesces small partitions, so a generous number is safe.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``, which is also where checkpoints go.

    Where that is unset, a temporary folder serves local sessions; a cluster session raises, since a machine-local
    folder would lose rows there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="playlog-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


#: Schemes of Spark's file systems, and what Arrow calls the same stores.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def arrow_uri(spark: SparkSession, path: str, make: bool = False) -> str:
    """The URI by which tasks reach with Arrow what Spark calls ``path``: default schemes and mount tables are resolved.

    A store that only one of them reaches raises ValueError. ``make``: make the folder first, if it isn't there.
    """
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = own.getFileSystem(spark._jsc.hadoopConfiguration())
    if make:
        fs.mkdirs(own)
    uri = fs.resolvePath(fs.makeQualified(own)).toUri()
    scheme = uri.getScheme()
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"tasks don't reach {path}: not {scheme}, only {', '.join(ARROW_SCHEMES)}")
    return f"{ARROW_SCHEMES[scheme]}://{uri.getAuthority() or ''}{uri.getRawPath()}"
