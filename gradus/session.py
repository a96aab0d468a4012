"""Session settings and the few places where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gradus")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as the session names it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        # One machine, as in tests: a scratch folder, the same for the whole session.
        folder = tempfile.mkdtemp(prefix="gradus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage and survives the loss of executors, unlike cached blocks; unlike a
    checkpoint it is computed once, and later reads take only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gradus-{uuid.uuid4().hex}"
    # What was shuffled for a table that is written is of no use any more: Spark deletes it then,
    # not when the driver happens to collect its garbage.
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Deletes the files of a table made by ``durable`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for file in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(hadoop).delete(path, False)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan that is too narrow for the cluster enough partitions.

    A small table is often one row group, hence one task, however many cores there
    are. A scan that already fills the cores twice is left alone, so at scale this
    adds no shuffle.
    """
    context = df.sparkSession.sparkContext
    cores = context.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(2 * cores, *[F.col(k) for k in keys])
