"""Tables between the passes of an operator, and dense ranks without one big window."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradus.session import shared_folder


class Stage:
    """Tables of one run in the folder all executors share (``spark.checkpoint.dir``).

    A written table cuts the lineage and outlives lost executors. ``drop`` removes one
    that no later plan reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for file in df.inputFiles():
            path = jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(hadoop).delete(path, False)


def dense_ranks(df: DataFrame, stage: Stage, order: list[str], group: str | None = None) -> DataFrame:
    """``df`` plus ``rank``: 0, 1, 2 ... in ``order``, within each value of ``group``.

    Rows are dealt by ranges of ``order``; inside a range they are numbered where they
    lie, and each range starts where the ranges before it end. So no window holds more
    than the counts of (range, group), however large a group is. The ranges are sampled,
    but the ranks do not depend on where they are cut; rows equal in ``order`` come in
    any order. ``df`` should be narrow: it is written once.
    """
    keys = [F.col(c) for c in order]
    by = [F.col(group)] if group else []
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*by, *keys)
    # The id is (partition << 33) + position, as documented.
    numbered = stage.write(dealt.withColumn("_id", F.monotonically_increasing_id())).withColumn(
        "_part", F.shiftright("_id", 33)
    )
    first = numbered.groupBy("_part", *by).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    # One row for each range and group: numbers, not data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if group:
        before = Window.partitionBy(group).orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1
        )
    starts = first.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    if group:
        starts = starts.withColumnRenamed(group, "_group")
        match = (numbered["_part"] == starts["_part"]) & numbered[group].eqNullSafe(starts["_group"])
        joined = numbered.join(starts, match).drop(starts["_part"]).drop("_group")
    else:
        joined = numbered.join(starts, "_part")
    rank = F.col("_start") + F.col("_id") - F.col("_first")
    return joined.withColumn("rank", rank).drop("_id", "_part", "_first", "_start")
