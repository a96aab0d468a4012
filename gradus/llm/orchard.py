"""Exact k-means on integer vectors; nearest centroids by Orchard's search.

Every centroid has a list of the others, nearest first. A vector starts at centroid 0 and
walks its list; as soon as it meets a closer centroid it jumps to that one's list. Centroids
already measured are marked and not measured again. The walk ends strictly beyond twice the
distance to the best centroid: by the triangle inequality no later centroid of the list is
as near, so ties are still met and go to the smaller number. All vectors of a batch walk
side by side.

Everything is integer arithmetic, so neither the order of rows nor the partitions change a
result. What leaves a task in a round is one sum for each centroid; what goes to the driver
and back is k centroids.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.staging import Stage

#: Below this, squared distances times 4 fit 64 bits for up to 64 * 2**5 components.
_NARROW = 1 << 23
#: Scaled components count as at most this, either way.
_FURTHEST = 1 << 56
_LONG = (1 << 63) - 1


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles: 64-bit if all are small, else Python's integers."""
    limit = float(_FURTHEST)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(values.astype(np.float64) * scale), -limit, limit)
    if not scaled.size or np.abs(scaled).max() < _NARROW:
        return scaled.astype(np.int64)
    return scaled.astype(np.int64).astype(object)


class Centroids:
    """Integer centroids, each with the others in order of distance."""

    def __init__(self, rows: list[list[int]]):
        self.rows = np.array(rows, dtype=object)
        self.k = len(rows)
        gaps = ((self.rows[:, None, :] - self.rows[None, :, :]) ** 2).sum(axis=2)
        near = [sorted((gaps[i, j], j) for j in range(self.k) if j != i) for i in range(self.k)]
        self.near = np.array([[j for _, j in line] for line in near], dtype=np.int64).reshape(self.k, -1)
        self.gap = np.array([[g for g, _ in line] for line in near], dtype=object).reshape(self.k, -1)
        self.narrow = bool(np.abs(self.rows).max() < _NARROW)
        if self.narrow:
            self.short = self.rows.astype(np.int64), self.gap.astype(np.int64)

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point its nearest centroid and the squared distance to it."""
        if self.narrow and points.dtype != object:
            centroids, gap = self.short
        else:
            centroids, gap, points = self.rows, self.gap, points.astype(object)
        n = len(points)
        best = np.zeros(n, dtype=np.int64)
        distance = ((points - centroids[0]) ** 2).sum(axis=1)
        met = np.zeros((n, self.k), dtype=bool)
        met[:, 0] = True
        place = np.zeros(n, dtype=np.int64)
        walking = np.arange(n)
        while True:
            walking = walking[place[walking] < self.k - 1]
            at = best[walking], place[walking]
            inside = (gap[at] <= 4 * distance[walking]).astype(bool)
            walking = walking[inside]
            if not len(walking):
                return best, distance
            other = self.near[best[walking], place[walking]]
            place[walking] += 1
            new = ~met[walking, other]
            who, other = walking[new], other[new]
            met[who, other] = True
            found = ((points[who] - centroids[other]) ** 2).sum(axis=1)
            closer = (found < distance[who]) | ((found == distance[who]) & (other < best[who]))
            closer = closer.astype(bool)
            jumps = who[closer]
            best[jumps], distance[jumps], place[jumps] = other[closer], found[closer], 0


def _vectors(batch: pa.RecordBatch, size: int, scale: int) -> np.ndarray:
    return integers(batch.column("vector").flatten().to_numpy().reshape(-1, size), scale)


def _sums(kept: DataFrame, centroids: Centroids, size: int, scale: int) -> list[tuple[int, int, list[int]]]:
    """(cluster, vectors, sums of the components) of every cluster that has vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((centroids.k, size), dtype=object)
        counts = np.zeros(centroids.k, dtype=np.int64)
        for batch in batches:
            points = _vectors(batch, size, scale)
            cluster, _ = centroids.search(points)
            for c in np.unique(cluster).tolist():
                mine = points[cluster == c]
                total[c] += mine.sum(axis=0).astype(object)
                counts[c] += len(mine)
        used = np.flatnonzero(counts)
        sums = [[Decimal(int(x)) for x in total[c]] for c in used]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array(counts[used], pa.int64()),
                pa.array(sums, pa.list_(pa.decimal128(38, 0))),
            ],
            names=["cluster", "n", "sums"],
        )

    parts = kept.mapInArrow(run, "cluster int, n long, sums array<decimal(38,0)>")
    each = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)]
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect()
    return [(r["cluster"], r["n"], [int(r[f"s{i}"]) for i in range(size)]) for r in rows]


def cluster(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    size: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """(id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``).

    One row for each row of ``df`` whose vector has ``size`` components, none NULL or not
    finite; other rows are left out. Components become floor(``scale`` * x). Centroids start
    as the ``k`` vectors with the smallest SHA-256 of ``seed:id``; each of ``rounds`` rounds
    assigns all vectors to their nearest centroid (ties: smaller number) and puts every
    centroid that has vectors at the floor of their mean.

    Fewer vectors than ``k`` make fewer centroids, an empty table gives an empty one.
    Repeated rows count each; rows with equal ids are told apart by their vectors when
    centroids are chosen. NULL ids are clustered, but chosen last. Scaled components beyond
    2**56 count as 2**56, and distances and sums beyond a long are given as the largest
    long. Further columns of ``df`` are not read, whatever their names.
    """
    spark = df.sparkSession
    stage = Stage(spark)
    kept = df.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    infinite = F.lit(float("inf"))
    kept = kept.where(
        (F.size("vector") == size)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    )
    kept = stage.write(kept)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), "vector").limit(k).collect()
    if not first:
        return _empty(kept, id_column)
    rows = [integers(np.array(r["vector"]), scale).tolist() for r in first]
    for _ in range(rounds):
        for c, n, sums in _sums(kept, Centroids(rows), size, scale):
            rows[c] = [s // n for s in sums]
    centroids = Centroids(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = centroids.search(_vectors(batch, size, scale))
            told = np.minimum(distance, _LONG).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(number, pa.int32()), pa.array(told, pa.int64())],
                names=["id", "cluster", "distance"],
            )

    kind = kept.schema["id"].dataType.simpleString()
    found = stage.write(kept.mapInArrow(run, f"id {kind}, cluster int, distance long"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    whole = min(sum(inertia.values()), _LONG)
    # k rows.
    facts = spark.createDataFrame(
        [
            (c, min(s, _LONG), whole, sha256(",".join(map(str, rows[c])).encode()).hexdigest())
            for c, s in inertia.items()
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    told = found.join(F.broadcast(facts), "cluster")
    return told.select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _empty(kept: DataFrame, id_column: str) -> DataFrame:
    nothing = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long"}
    return kept.where("false").select(
        F.col("id").alias(id_column),
        *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()],
        F.lit(None).cast("string").alias("centroid_sha256"),
    )
