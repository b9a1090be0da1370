"""Centroid clustering in integers; PCA-rotated coordinates rule centroids out before distances are computed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import stored

#: Leading rotated coordinates that are stored with each vector.
LEADING = 12
#: Largest magnitude of an integer component: squared distances of 64 such components fit in 63 bits.
LARGEST = 1 << 27
#: Vectors handled together.
BLOCK = 4096
#: What rounding may take from a lower bound, relative to the lengths that enter it.
SLACK = 1e-9


def integer_vectors(vectors: DataFrame, size: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, whole): vectors of exactly `size` components, none null or non-finite, as little-endian 32-bit integers
    floor(scale * component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                ids, rows = batch.column(0)[at : at + BLOCK], batch.column(1)[at : at + BLOCK]
                lengths = pa.compute.fill_null(pa.compute.list_value_length(rows), -1).to_numpy()
                fit = np.flatnonzero(lengths == size)
                flat = rows.take(pa.array(fit)).flatten()
                x = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(len(fit), size)
                good = np.isfinite(x).all(axis=1)  # nulls have become NaN
                x = np.floor(scale * x[good])
                if np.abs(x).max(initial=0) > LARGEST:
                    raise ValueError(f"a component is beyond {LARGEST}: squared distances would not fit in 64 bits")
                whole = [v.tobytes() for v in x.astype("<i4")]
                yield pa.record_batch({"vec_id": ids.take(pa.array(fit[good])), "whole": pa.array(whole, pa.binary())})

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(id_col, vector_col).mapInArrow(run, f"vec_id {kind}, whole binary")


def _matrix(column: pa.Array, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, size)


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose ids have the smallest lower-case hex SHA-256 of `<seed>:<id>`, in that order; a null id counts as an
    empty text, and equal ids are ordered by their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.orderBy(name, "whole").limit(clusters).select("whole").collect()
    return np.array([np.frombuffer(r.whole, "<i4") for r in rows], np.int64)


def rotation(vectors: DataFrame, size: int, leading: int = LEADING) -> np.ndarray:
    """Orthonormal directions (size x leading) of largest variance over all vectors, from sums of size * (size + 1) numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch.column(0)[at : at + BLOCK], "<i4", size).astype(np.float64)
                n, total, square = n + len(x), total + x.sum(axis=0), square + x.T @ x
        if n:
            values = np.concatenate([[n], total, square.ravel()])
            yield pa.record_batch({"at": pa.array(np.arange(len(values)), pa.int32()), "value": pa.array(values)})

    sums = vectors.select("whole").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    values = np.array([r.value for r in sums.orderBy("at").collect()])
    if not len(values):
        return np.eye(size, min(leading, size))
    mean, square = values[1 : size + 1] / values[0], values[size + 1 :].reshape(size, size) / values[0]
    _, directions = np.linalg.eigh(square - np.outer(mean, mean))
    return np.ascontiguousarray(directions[:, ::-1][:, :leading])


def _rotated(whole: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates, and the length of what they leave out."""
    x = whole.astype(np.float64)
    near = x @ directions
    return near, np.sqrt(np.maximum((x * x).sum(axis=1) - (near * near).sum(axis=1), 0))


def nearest(
    whole: np.ndarray, near: np.ndarray, rest: np.ndarray, centroids: np.ndarray, directions: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to the nearest centroid of each vector, ties to the smaller number; and how many
    distances were computed.

    The squared distance is at least that of the leading coordinates plus the squared difference of the residual norms. The
    centroid of the least bound is measured first; then those whose bound, less what rounding may have added, does not exceed
    the best distance so far are measured, in integers.
    """
    c_near, c_rest = _rotated(centroids, directions)
    bound = np.stack([((near - p) ** 2).sum(axis=1) + (rest - r) ** 2 for p, r in zip(c_near, c_rest)], axis=1)
    length = (near * near).sum(axis=1) + rest * rest
    bound -= SLACK * (length[:, None] + ((c_near * c_near).sum(axis=1) + c_rest * c_rest)[None, :] + 1)
    best = bound.argmin(axis=1)
    distance = ((whole - centroids[best]) ** 2).sum(axis=1)
    measured = len(whole)
    first = best.copy()
    for j, centroid in enumerate(centroids):
        rows = np.flatnonzero((bound[:, j] <= distance) & (first != j))
        exact = ((whole[rows] - centroid) ** 2).sum(axis=1)
        measured += len(rows)
        closer = (exact < distance[rows]) | ((exact == distance[rows]) & (j < best[rows]))
        best[rows[closer]], distance[rows[closer]] = j, exact[closer]
    return best, distance, measured


def _blocks(batch: pa.RecordBatch, size: int, leading: int):
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        whole = _matrix(part.column("whole"), "<i4", size).astype(np.int64)
        yield part, whole, _matrix(part.column("near"), "<f8", leading), part.column("rest").to_numpy()


def _round(rotated: DataFrame, centroids: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The centroids after one round. Each task returns one row of sums per cluster it met."""
    size, leading = directions.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, whole, near, rest in _blocks(batch, size, leading):
                cluster, _, _ = nearest(whole, near, rest, centroids, directions)
                np.add.at(sums, cluster, whole)
                counts += np.bincount(cluster, minlength=len(centroids))
        met = np.flatnonzero(counts)
        if len(met):
            yield pa.record_batch({
                "cluster": pa.array(met, pa.int32()), "n": pa.array(counts[met], pa.int64()),
                "sums": pa.array(list(sums[met]), pa.list_(pa.int64())),
            })

    parts = rotated.select("whole", "near", "rest").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(size)]
    )
    after = centroids.copy()
    for r in total.collect():
        after[r.cluster] = [int(r[f"s{k}"]) // r.n for k in range(size)]
    return after


def cluster_vectors(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: str = "3", size: int = 64, scale: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, measured.

    Lloyd's algorithm in integers, as integer_vectors, first_centroids and nearest define; every round replaces a centroid by its
    vectors' componentwise floor(sum / count), empty ones stay. `measured` is the mean number of exact distances per vector in the
    last assignment.

    Vectors are written once with their leading rotated coordinates and the norm of the rest. Per round a task returns its
    sums; clusters * size totals come to the driver. Vectors of another length, or with a null or non-finite component, are
    left out, as are null vectors; components beyond LARGEST after scaling are an error. Repeated rows count each; fewer vectors
    than clusters give fewer centroids. Other columns have no effect. No kept vector gives an empty result.
    """
    kept = stored(integer_vectors(vectors, size, scale, id_col, vector_col), "centroid-vectors")
    centroids = first_centroids(kept, clusters, seed)
    directions = rotation(kept, size)
    leading = directions.shape[1]

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                near, rest = _rotated(_matrix(part.column(1), "<i4", size), directions)
                yield pa.record_batch({
                    "vec_id": part.column(0), "whole": part.column(1),
                    "near": pa.array([v.tobytes() for v in near], pa.binary()), "rest": pa.array(rest),
                })

    kind = vectors.schema[id_col].dataType.simpleString()
    rotated = stored(kept.mapInArrow(rotate, f"vec_id {kind}, whole binary, near binary, rest double"), "centroid-rotated")
    if len(centroids):
        for _ in range(rounds):
            after = _round(rotated, centroids, directions)
            if (after == centroids).all():
                break  # all further rounds would repeat this one
            centroids = after

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, whole, near, rest in _blocks(batch, size, leading):
                cluster, distance, measured = nearest(whole, near, rest, centroids, directions)
                yield pa.record_batch({
                    "vec_id": part.column(0), "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance, pa.int64()),
                    "measured": pa.array([measured, *[0] * (len(whole) - 1)], pa.int64()),
                })

    assigned = stored(rotated.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long, measured long"), "centroid-assigned")
    inertia = assigned.groupBy("cluster").agg(
        F.sum("distance").alias("cluster_inertia"), F.sum("measured").alias("measured"), F.count(F.lit(1)).alias("n")
    ).collect()
    total, tried, n = (sum(r[c] for r in inertia) for c in ("cluster_inertia", "measured", "n"))
    table = [
        (r.cluster, r.cluster_inertia, total, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest(), tried / n)
        for r in inertia
    ]
    per_cluster = vectors.sparkSession.createDataFrame(
        table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, measured double"
    )
    # One row per cluster.
    return assigned.drop("measured").join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "measured"
    )
