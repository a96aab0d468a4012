"""The resumable cache as a stream: new items are tagged once, as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gradus.operators.tagging import Key, key_columns, pending
from gradus.sources.tables import read_cache


def tag_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    cache: str,
    cache_schema: str,
    checkpoint: str,
    tag: Callable[[DataFrame], DataFrame],
    key: Key = None,
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Tag every item of a growing parquet folder that the cache lacks, then stop.

    The checkpoint remembers which files were read; keys already cached are skipped, and
    each batch writes to its own folder with overwrite. So a batch that is run again
    after a failure replaces its half-finished self.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        folder = f"{cache}/batch={number}"
        done = read_cache(batch.sparkSession, cache, cache_schema)
        if "batch" in done.columns:
            done = done.where(F.col("batch") != number)
        keys = key_columns(batch, done, key)
        todo = pending(batch.dropDuplicates(keys), done, keys)
        tag(todo).withColumn("written", F.current_timestamp()).write.mode("overwrite").parquet(
            folder
        )

    items = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    return (
        items.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
