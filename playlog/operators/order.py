"""The place of each row in a whole order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def with_place(df: DataFrame, order: list[str | Column], place: str = "place") -> DataFrame:
    """``df``, sorted, with the place of each row from 1; equal rows of the order come in any order.

    Rows are ranged over partitions by the order, sorted there and checkpointed, so that partitions stay what they
    were; a row's place is its own within its partition plus the rows of the partitions before, of which the driver
    sees one number for each partition. Equal rows of the order are ranged by a hash of the whole row, so that a value
    that most rows have is no single task's; pass rows with a column that tells them apart.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    hashed = [f.name for f in df.schema if not f.dataType.simpleString().count("map<")]
    order = [*order, F.xxhash64(*hashed)]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    part = F.spark_partition_id()
    counts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each partition
    before, sofar = [], 0
    for r in sorted(counts, key=lambda r: r.part):
        before.append((r.part, sofar))
        sofar += r.n
    offsets = spark.createDataFrame(before, "__part int, __before long")
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    numbered = ranged.withColumns({"__part": part, "__within": within})
    return numbered.join(F.broadcast(offsets), "__part").withColumn(place, F.col("__before") + F.col("__within") + 1).drop("__part", "__before", "__within")
