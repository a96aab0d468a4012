"""The cache of answers as a table of versions: batches published whole, joined without a shuffle.

Every batch is a partition of one external table, bucketed by the item's key. What readers
see is the manifest, a table with one row for each batch: a batch counts from the moment its
row is there, so a batch killed half-way leaves nothing but files nobody reads. Compaction
writes the last value of every key as a new batch and a row that says from where on to
read; older sessions go on reading the batches they know.

The cache grows, new items are few. Since its files are bucketed, joining items with it, or
taking the last value of each key, moves the items only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.sources.tables import read_cache

_MANIFEST = "version long, batch string, compacted boolean"
BUCKETS = 64


class CacheTable:
    """A cache under ``path`` with the columns ``schema``, of which ``keys`` name an item.

    One writer at a time; any number of readers. ``buckets`` is fixed when the cache is
    begun: some thousand rows of a bucket to a task.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, keys: Sequence[str] = ("source", "id"), buckets: int = BUCKETS
    ):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.fields = T._parse_datatype_string(schema).fields
        self.table = f"cache_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.fields)
        clustered = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(
            f"CREATE TABLE {self.table} ({columns}, version BIGINT) USING parquet PARTITIONED BY (version) "
            f"CLUSTERED BY ({clustered}) INTO {buckets} BUCKETS LOCATION '{self.path}/data'"
        )

    def _manifest(self) -> list:
        """The live batches, oldest first: one row for each."""
        rows = read_cache(self.spark, f"{self.path}/manifest", _MANIFEST).orderBy("version").collect()
        if len({r.version for r in rows}) < len(rows):
            raise RuntimeError(f"two writers published one version in {self.path}")
        start = max((i for i, r in enumerate(rows) if r.compacted), default=0)
        return rows[start:]

    def _live(self) -> list[int]:
        """Makes the table's partitions the live batches."""
        rows = self._manifest()
        known = {int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()}
        live = {r.version: r.batch for r in rows}
        for gone in known - live.keys():
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (version={gone})")
        for version in sorted(live.keys() - known):
            where = f"{self.path}/data/{live[version]}"
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION (version={version}) LOCATION '{where}'")
        return sorted(live)

    def read(self) -> DataFrame:
        """Every row of the live batches, with the ``version`` that published it."""
        versions = self._live()
        rows = self.spark.table(self.table)
        return rows.where(F.col("version").isin(versions)) if versions else rows.where("false")

    def publish(self, df: DataFrame, compacted: bool = False) -> int:
        """Adds one batch; its version. Nothing of it is seen before all of it is there."""
        every = read_cache(self.spark, f"{self.path}/manifest", _MANIFEST).agg(F.max("version")).first()[0]
        version = 0 if every is None else every + 1
        # A new folder each time: one left by a killed batch is never written to again.
        batch = f"batch-{uuid.uuid4().hex}"
        staged = f"{self.table}_{version}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.fields]
        buckets = int(self._property("Num Buckets"))
        shaped = df.select(*columns)
        writer = shaped.repartition(buckets, *self.keys).write.format("parquet").bucketBy(buckets, *self.keys)
        writer.option("path", f"{self.path}/data/{batch}").saveAsTable(staged)
        # External, so only the name goes.
        self.spark.sql(f"DROP TABLE {staged}")
        row = self.spark.createDataFrame([(version, batch, compacted)], _MANIFEST)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return version

    def _property(self, name: str) -> str:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.table}").collect()
        return next(r.data_type for r in rows if r.col_name == name)

    def latest(self, value: str) -> DataFrame:
        """(keys..., value) of the last version of each key; the greatest of several in one."""
        last = F.max(F.struct("version", F.col(value).alias("value"))).alias("last")
        return self.read().groupBy(*self.keys).agg(last).select(*self.keys, F.col("last.value").alias(value))

    def align(self, items: DataFrame, value: str) -> DataFrame:
        """``items`` with their last cached ``value``, NULL where there is none."""
        found = self.latest(value)
        named = found.select(*[F.col(k).alias(f"_{k}") for k in self.keys], value)
        return self._typed(items).join(named, self._same(), "left").drop(*[f"_{k}" for k in self.keys])

    def pending(self, items: DataFrame) -> DataFrame:
        """``items`` whose key the cache lacks."""
        named = self.read().select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        return self._typed(items).join(named, self._same(), "left_anti")

    def _typed(self, items: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in self.fields}
        return items.withColumns({k: F.col(k).cast(kinds[k]) for k in self.keys})

    def _same(self):
        same = F.lit(True)
        for k in self.keys:
            same = same & (F.col(k) == F.col(f"_{k}"))
        return same

    def compact(self, value: str) -> int:
        """Publishes the last ``value`` of every key as one batch that stands for all before."""
        return self.publish(self.latest(value), compacted=True)

    def resume(self, items: DataFrame, classify: Callable[[DataFrame], DataFrame], value: str) -> DataFrame:
        """Classifies what the cache lacks, publishes it, and gives every item its value."""
        todo = self.pending(items)
        if not todo.isEmpty():
            self.publish(classify(todo))
        return self.align(items, value)
