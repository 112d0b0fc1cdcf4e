"""Centroid clustering of vectors with Walsh-Hadamard progressive search.

Vectors become integers, ``floor(64 * x)``.  The Walsh-Hadamard transform H
of 64 components is orthogonal up to a factor, so 64 times the squared
distance of two vectors is the squared distance of their transforms, an exact
integer.  Coefficients are taken coarse to fine (by sequency: 1, 2, 4, ...
64 of them).  After each level every centroid still in play has a sum of
squared coefficient differences, which can only grow; the one with the least
sum so far is carried through to the end once, and every centroid whose sum
is already *strictly* above the least finished distance is out.  The rest
finish all 64 coefficients, and the smallest number wins a tie, so the result
is that of the full search.

Vectors are quantised and written once.  In a round the workers assign their
vectors to the centroids (a matrix in the task's closure), add up components
and numbers per centroid and pass on one row per centroid and task; Spark
adds those.  The driver sees the centroids: at most ``k`` rows of 64 sums.
Lost tasks are run again from the written vectors.

Vectors that are null, have not exactly ``DIMENSIONS`` components or have a
null, NaN or infinite component are left out.  Repeated rows count each; a
null id is a row like any other and hashes as an empty one.  Rows of equal id
are taken in the order of their vectors where the start needs an order.  Fewer
kept vectors than ``k`` give that many centroids; an empty table gives an
empty result.  Components of more than ``LIMIT`` as integers, whose sums and
squares need not fit 64 bits, are an error.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import save, ship, table

ship(__name__)

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: 64 coefficient differences of at most 2 * 64 * LIMIT, squared and added, fit 63 bits.
LIMIT = (1 << 24) - 1
ROWS = 8192


def sequency_order() -> np.ndarray:
    """Rows of the transform from slow to fast sign changes, coarse to fine."""
    h = np.array([[1]])
    while len(h) < DIMENSIONS:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


ORDER = sequency_order()


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row by additions only, coefficients coarse to fine."""
    y, half = x.astype(np.int64), 1
    while half < DIMENSIONS:
        pairs = y.reshape(len(y), -1, 2, half)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(y), -1)
        half *= 2
    return y[:, ORDER]


def nearest(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of every row's nearest centroid; v and c are transforms."""
    rows = np.arange(len(v))
    far = np.iinfo(np.int64).max
    sums = np.zeros((len(v), len(c)), np.int64)
    alive = np.ones((len(v), len(c)), bool)
    best = np.full(len(v), far)
    done, upto = 0, 1
    while done < DIMENSIONS:
        at, number = np.nonzero(alive)
        step = v[at, done:upto] - c[number, done:upto]
        sums[at, number] += np.einsum("ij,ij->i", step, step)
        done, upto = upto, 2 * upto
        if done < DIMENSIONS:
            lead = np.where(alive, sums, far).argmin(axis=1)
            rest = v[:, done:] - c[lead, done:]
            best = np.minimum(best, sums[rows, lead] + np.einsum("ij,ij->i", rest, rest))
            alive &= sums <= best[:, None]
    number = np.where(alive, sums, far).argmin(axis=1)  # the first of equals
    return number, sums[rows, number] // DIMENSIONS


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), DIMENSIONS)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): the kept vectors as 64 integers."""
    v = F.col("v")
    usable = (F.coalesce(F.size(v) == DIMENSIONS, F.lit(False)) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    as_integer = F.transform(v, lambda x: F.when(F.abs(x) * SCALE <= LIMIT, F.floor(x * SCALE).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component exceeds {LIMIT / SCALE:.0f} in size")).cast("int")))
    return (vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .filter(usable).select("id", as_integer.alias("v")))


def start_centroids(points: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The vectors of the k smallest id hashes, in that order."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = points.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in first], np.int64).reshape(-1, DIMENSIONS)


def _partial_sums(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = transform(centroids)
        sums, n = np.zeros_like(centroids), np.zeros(len(c), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                x = _vectors(batch.column(0).slice(start, ROWS))
                number, _ = nearest(transform(x), c)
                order = np.argsort(number, kind="stable")
                held, firsts = np.unique(number[order], return_index=True)
                sums[held] += np.add.reduceat(x[order].astype(np.int64), firsts)
                n += np.bincount(number, minlength=len(c))
        used = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(n[used], pa.int64()), pa.array(list(sums[used]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    return run


def improved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has vectors becomes their floored mean."""
    parts = points.select("v").mapInArrow(_partial_sums(centroids), "cluster int, n long, sums array<long>")
    total: Column = F.array(*[F.sum(F.col("sums")[i]) for i in range(DIMENSIONS)])
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), total.alias("sums")).collect():  # k rows
        out[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    return out


def assigned(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = transform(centroids)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                number, distance = nearest(transform(_vectors(part.column(1))), c)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                                                 names=["id", "cluster", "distance"])

    return points.mapInArrow(run, f"id {points.schema['id'].dataType.simpleString()}, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every kept vector, the final centroids)."""
    points = save(quantised(vectors, id_col, vector_col), "vectors")
    centroids = start_centroids(points, k)
    if not len(centroids):
        return points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = improved(points, centroids)
    return assigned(points, centroids), centroids


def op13_query(spark, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    found = save(found, "clusters")
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    facts = [(i, int(sums.get(i, 0)), sum(sums.values()), d) for i, d in enumerate(digest)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
