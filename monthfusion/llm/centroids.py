"""Centroid clustering of integer vectors with scalar lookup tables.

A vector's components x become integers floor(256 * x).  In each round a task holds the
centroids, and for every dimension it tabulates (value - centroid)**2 for the integer
values that occur in its rows and all centroids; the squared distances of all rows are
then table rows gathered and summed, dimension by dimension, without a multiplication
per vector.  Tasks return one row per centroid: its number of vectors and the exact sum
of every component.  Spark adds these rows, and the driver, which only ever holds the
centroids, divides with floor.  Centroids start as the vectors with the smallest hashes
of ``<seed>:<vec_id>``.

The integer vectors are written to the shared folder once; a round reads them from there.

Defined cases: vectors that are NULL, have another number of components, or hold a NULL,
NaN or infinite one are left out.  Rows that share an id, and equal rows, are vectors of
their own; where hashes tie, the lesser vector (first component first) starts first, and NULL ids come last.
Equal distances go to the smaller number.  Fewer vectors than centroids give fewer
centroids; an empty table gives no rows.  Components must lie within +-2**19
(``LIMIT`` as an integer), so that every distance fits a long; others are an error that
names the bound.  Other columns are not read, whatever their names.  There are no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm.batches import give_back, small_batches
from monthfusion.sources.scratch import scratch_dir
from monthfusion.sources.shipping import ship_package

COMPONENTS, CENTROIDS, ROUNDS, SEED, SCALE = 64, 40, 5, 2, 256
LIMIT = 1 << 27
#: Rows whose distances are summed at once.
ROWS = 4096

INTEGERS_DDL = "vec_id long, vector binary"


def integers(column: pa.Array, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column are kept, and their components as integers."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == components)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(len(rows), components)
    finite = np.isfinite(values).all(axis=1)
    scaled = np.floor(SCALE * values[finite])
    if len(scaled) and np.abs(scaled).max() > LIMIT:
        raise ValueError(f"a component lies outside +-{LIMIT // SCALE}")
    return rows[finite], scaled.astype(np.int32)


def _integers(components: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, vectors = integers(batch.column("embedding"), components)
        raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * components), len(rows), [None, pa.py_buffer(encoded(vectors))])
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), raw.cast(pa.binary())], names=["vec_id", "vector"])


def encoded(vectors: np.ndarray) -> bytes:
    """Bytes that are ordered as the numbers are."""
    return (vectors.astype(np.int64) + (1 << 31)).astype(">u4").tobytes()


def decoded(raw: bytes, rows: int, components: int) -> np.ndarray:
    """A row per dimension, a column per vector."""
    return np.ascontiguousarray((np.frombuffer(raw, ">u4").astype(np.int64) - (1 << 31)).reshape(rows, components).T)


def blocks(batch: pa.RecordBatch, components: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and integer vectors of some rows at a time, a column per dimension."""
    for first in range(0, batch.num_rows, ROWS):
        raw = b"".join(batch.column("vector").slice(first, ROWS).to_pylist())
        yield first, decoded(raw, min(ROWS, batch.num_rows - first), components)


def nearest(columns: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, and the squared distance.

    ``columns`` and ``centroids`` have a row per dimension.
    """
    span = int(max(columns.max(), centroids.max())) - int(min(columns.min(), centroids.min()))
    exact = np.int32 if len(columns) * span * span < 1 << 31 else np.int64
    sums = np.zeros((columns.shape[1], centroids.shape[1]), exact)
    for values, own in zip(columns, centroids, strict=True):
        low, high = int(values.min()), int(values.max())
        if high - low < ROWS:  # a slot for every integer between
            occurring, at = np.arange(low, high + 1), values - low
        else:
            occurring, at = np.unique(values, return_inverse=True)
        table = ((occurring[:, None] - own[None, :]) ** 2).astype(exact)
        sums += table[at]
    cluster = sums.argmin(axis=1)
    return cluster, sums[np.arange(len(cluster)), cluster].astype(np.int64)


SUMS_DDL = "cluster int, n long, sums array<long>"


def _sums(centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per centroid how many vectors of this task are nearest to it, and their sum."""
    dimensions, k = centroids.shape
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
    for batch in batches:
        for _, columns in blocks(batch, len(centroids)):
            cluster, _ = nearest(columns, centroids)
            order = np.argsort(cluster, kind="stable")
            used, first = np.unique(cluster[order], return_index=True)
            sums[used] += np.add.reduceat(columns[:, order], first, axis=1).T
            counts += np.bincount(cluster, minlength=k)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
    )


ASSIGNED_DDL = "vec_id long, cluster int, distance long"


def _assign(centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, columns in blocks(batch, len(centroids)):
            cluster, distance = nearest(columns, centroids)
            ids = batch.column("vec_id").slice(first, len(cluster))
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])
    give_back()


class Clustering:
    """Integer vectors in the shared folder and the centroids of a run."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS):
        ship_package(spark)
        self.spark, self.folder, self.components = spark, scratch_dir(spark, "centroids"), components
        kept = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        with small_batches(spark, 10_000):
            kept.mapInArrow(partial(_integers, components), INTEGERS_DDL).write.parquet(f"{self.folder}/integers")
        self.vectors = spark.read.schema(INTEGERS_DDL).parquet(f"{self.folder}/integers")

    def start(self, k: int, seed: int) -> np.ndarray:
        """The first ``k`` vectors by hash: a row per dimension, a column per centroid."""
        hashed = self.vectors.withColumn("hash", F.expr(f"sha2(concat('{seed}:', CAST(vec_id AS STRING)), 256)"))
        first = hashed.orderBy(F.col("hash").asc_nulls_last(), "vector").limit(k).select("vector").collect()
        return decoded(b"".join(r.vector for r in first), len(first), self.components)

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """Centroids after a round: the floor of the mean of their vectors; without any they stay."""
        with small_batches(self.spark, 10_000):
            parts = self.vectors.mapInArrow(partial(_sums, centroids), SUMS_DDL)
            total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.expr(f"sum(CAST(sums[{d}] AS decimal(38, 0)))").alias(f"s{d}") for d in range(self.components)))
            found = total.collect()  # a row per centroid
        moved = centroids.copy()
        for r in found:
            moved[:, r.cluster] = [int(r[f"s{d}"]) // r.n for d in range(self.components)]
        return moved

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        with small_batches(self.spark, 10_000):
            self.vectors.mapInArrow(partial(_assign, centroids), ASSIGNED_DDL).write.parquet(f"{self.folder}/assigned")
        return self.spark.read.schema(ASSIGNED_DDL).parquet(f"{self.folder}/assigned")


def clusters(spark: SparkSession, vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256."""
    run = Clustering(spark, vectors, components)
    centroids = run.start(k, seed)
    if not centroids.shape[1]:
        return spark.createDataFrame([], f"{ASSIGNED_DDL}, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = run.moved(centroids)
    assigned = run.assigned(centroids)
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.T.tolist()]
    per_cluster = [(c, n, sum(inertia.values()), digests[c]) for c, n in sorted(inertia.items())]  # a row per centroid
    described = spark.createDataFrame(per_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(described), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
