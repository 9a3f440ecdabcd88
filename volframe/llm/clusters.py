"""Centroid clustering of integer vectors, distances by scalar lookup tables.

Vectors are turned into integers once and staged in blocks. A block keeps, for each dimension, the sorted integer values
that occur in it, and for each vector the places of its components among them. In each round a task tabulates the squared
difference of every dimension's occurring values to every centroid, and a distance is the sum of one table entry for each
dimension: NumPy gathers and additions, no multiplication for each vector. Tables are no larger than a block.

A round sends on one row for each task and centroid (count, component sums, distance sum), which Spark adds up; the driver
only ever holds the centroids. Every sum is exact, so the result depends neither on partitions nor on retried tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import release_memory, stage

#: Vectors in a block, at most; places among occurring values then fit 16 bits.
BLOCK = 4096
#: Components have so many bits at most (and a sign), so that a squared distance fits 63 bits.
BITS = 27

Blocks = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): the vectors with exactly `dims` components, all finite, as integers floor(scale * x)."""
    x = F.col("x")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    rows = rows.where(x.isNotNull() & (F.size(x) == dims)).where(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    fits = F.forall(x, lambda e: F.abs(e) < float(2**BITS // scale))
    ints = F.transform(x, lambda e: F.floor(e * float(scale)).cast("int"))
    return rows.select("vec_id", F.when(fits, ints).otherwise(F.raise_error(F.lit(f"a component times {scale} needs more than {BITS} bits")).cast("array<int>")).alias("v"))


def _encode(dims: int) -> Blocks:
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("bounds", pa.binary()), ("values", pa.binary()), ("places", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                v = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
                places, bounds, values = np.empty(v.shape, np.uint16), [0], []
                for d in range(dims):
                    own, places[:, d] = np.unique(v[:, d], return_inverse=True)
                    values.append(own)
                    bounds.append(bounds[-1] + len(own))
                row = [part.column("vec_id").to_pylist()], [np.array(bounds, np.int32).tobytes()], [np.concatenate(values).tobytes()], [places.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, schema.types, strict=True)], schema=schema)
        release_memory()

    return run


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block: ids, integer vectors, nearest centroids (the first of equals) and squared distances."""
    dims = centroids.shape[1]
    for i in range(batch.num_rows):
        ids = batch.column("ids")[i].as_py()
        bounds, values, places = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("bounds", np.int32), ("values", np.int64), ("places", np.uint16)))
        of = np.repeat(np.arange(dims), np.diff(bounds))
        table = (values[:, None] - centroids.T[of]) ** 2
        at = places.reshape(-1, dims).astype(np.int64) + bounds[:-1]
        far = np.zeros((len(ids), len(centroids)), np.int64)
        for d in range(dims):
            far += table[at[:, d]]
        near = far.argmin(axis=1)
        yield ids, values[at], near, far[np.arange(len(ids)), near]


def _sums(centroids: np.ndarray) -> Blocks:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        n, inertia, total = np.zeros(k, np.int64), [0] * k, [[0] * dims for _ in range(k)]  # Python's integers have no bound
        for batch in batches:
            for _, v, near, far in _assigned(batch, centroids):
                for c in np.unique(near):
                    own = near == c
                    n[c] += own.sum()
                    inertia[c] += sum(far[own].tolist())
                    total[c] = [x + y for x, y in zip(total[c], v[own].sum(axis=0).tolist(), strict=True)]
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array([str(inertia[c]) for c in some], pa.string()), pa.array([list(map(str, total[c])) for c in some], pa.list_(pa.string()))
        ], names=["c", "n", "inertia", "s"])
        release_memory()

    return run


def _rows(centroids: np.ndarray) -> Blocks:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, near, far in _assigned(batch, centroids):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(near.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])
        release_memory()

    return run


def _round(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """count, distance sum and component sums of each centroid that has vectors: a row for each centroid."""
    whole = lambda c: F.sum(c.cast("decimal(38,0)"))
    rows = blocks.mapInArrow(_sums(centroids), "c int, n long, inertia string, s array<string>").groupBy("c")
    rows = rows.agg(F.sum("n").alias("n"), whole(F.col("inertia")).alias("inertia"), F.array(*(whole(F.col("s")[d]) for d in range(centroids.shape[1]))).alias("s"))
    return {r.c: (r.n, int(r.inertia), list(map(int, r.s))) for r in rows.collect()}


def clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3:") -> DataFrame:
    """One row for each kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (its final components).

    Kept are vectors with exactly `dims` components, none null or non-finite; each becomes integers floor(scale * x). The
    first centroids are the k kept vectors with the smallest hex SHA-256 of `seed` and id, in that order; rows with the
    same id are ordered by their components, null ids come last. Each of `rounds` rounds assigns every vector to the
    nearest centroid by squared distance (of equals the smaller number) and moves every centroid that has vectors to
    floor(sum / count) of them; then vectors are assigned once more.

    Fewer than k kept vectors give as many centroids; none, or an empty table, an empty result. Repeated rows count one by
    one and each have their row. Equal centroids are possible; the smaller number takes all. Components whose integers
    need more than 27 bits raise an error, since distances would not fit a long. Other columns are not read.
    """
    kept = whole_vectors(vectors, id_col, vec_col, dims, scale)
    by = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    start = np.array([r.v for r in kept.orderBy(by.asc_nulls_last(), "v").limit(k).collect()], np.int64).reshape(-1, dims)
    if not len(start):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    blocks = stage(kept.mapInArrow(_encode(dims), "ids array<long>, bounds binary, values binary, places binary"), "op13-blocks")
    centroids = start
    for _ in range(rounds):
        centroids = centroids.copy()
        for c, (n, _, s) in _round(blocks, centroids).items():
            centroids[c] = [x // n for x in s]
    last = _round(blocks, centroids)
    own = [last.get(c, (0, 0, []))[1] for c in range(len(centroids))]
    at = F.col("cluster") + 1
    out = blocks.mapInArrow(_rows(centroids), "vec_id long, cluster int, distance long")
    return out.select(
        "vec_id", "cluster", "distance", F.element_at(F.array(*(F.lit(x).cast("long") for x in own)), at).alias("cluster_inertia"), F.lit(sum(own)).cast("long").alias("inertia"),
        F.element_at(F.array(*(F.array(*(F.lit(int(x)).cast("long") for x in c)) for c in centroids)), at).alias("centroid"),
    )
