"""Centroid clustering with an incremental matrix of exact integer products."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import give_back_memory
from tripmart.llm.topk_search import quantised
from tripmart.session import delete_folder, scratch_dir

CLUSTERS = 16
ROUNDS = 3
DIMENSION = 64
SCALE = 64
SEED = 1
#: Below it, sums of DIMENSION products and the distances made of them stay within 64 bits.
LARGEST = 1 << 27


def _kept(vectors: DataFrame, id_col: str, vector_col: str, dimension: int, scale: int) -> DataFrame:
    rows = vectors.select(F.col(id_col).alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"))
    fits = F.forall("v", lambda x: F.abs(x) < LARGEST)
    refused = F.raise_error(F.lit(f"a component of a vector is not below {LARGEST} after scaling"))
    return rows.filter(F.size("v") == dimension).withColumn("v", F.when(fits, F.col("v")).otherwise(refused.cast("array<bigint>")))


def _moved(delta: np.ndarray, x: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Products with the moved centroids: those before, changed by the components that moved."""
    products = products.copy()
    for at, change in enumerate(delta):
        moved = np.flatnonzero(change)
        if len(moved):
            products[:, at] += x[:, moved] @ change[moved]
    return products


def _state(kind: str) -> str:
    return f"vec_id {kind}, v array<bigint>, products array<bigint>, cluster int, distance bigint"


def _assigned(centroids: np.ndarray, products_of: Callable[[np.ndarray, pa.RecordBatch], np.ndarray]):
    """Batches of the state: products by ``products_of``, and the nearest centroid of each vector, the first at a tie."""
    squares = (centroids * centroids).sum(axis=1)

    def lists(values: np.ndarray) -> pa.ListArray:
        offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(values).ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            products = products_of(x, batch)
            away = (x * x).sum(axis=1)[:, None] - 2 * products + squares
            nearest = away.argmin(axis=1)
            distance = np.take_along_axis(away, nearest[:, None], axis=1)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), lists(products), pa.array(nearest, pa.int32()), pa.array(distance)],
                ["vec_id", "v", "products", "cluster", "distance"],
            )
            give_back_memory()

    return run


def _written(df: DataFrame) -> tuple[str, DataFrame]:
    path = scratch_dir(df.sparkSession, "centroid-state")
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of each cluster's exact mean; an empty cluster keeps its centroid. One row per cluster is collected."""
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.get("v", at)).alias(f"s{at}") for at in range(centroids.shape[1])])
    moved = centroids.copy()
    for row in sums.collect():
        moved[row["cluster"]] = [row[f"s{at}"] // row["n"] for at in range(centroids.shape[1])]
    return moved


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimension: int = DIMENSION,
    scale: int = SCALE,
    seed: int = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid`` of every vector that takes part.

    Vectors become integers, ``floor(scale * x)`` of each component; those of another length, null, or with a
    null or non-finite component take no part. The first centroids are the vectors whose
    ``<seed>:<id>`` has the smallest SHA-256, in its order (ties, that is, repeated ids, by the vector;
    a null id counts as no digits). Every round assigns each vector to the nearest centroid, ties to the
    smaller number, and moves each centroid to the floor of its vectors' mean; an empty one
    stays. A last assignment follows.

    Each vector's products with all centroids are kept in the shared folder between rounds. A round
    adds to them what the centroids' moves change, component by component where one moved, and takes the
    smallest distance anew; all numbers are exact integers. Centroids and a sum per cluster are
    what the driver sees. A round's table is deleted once the next one is written; when no centroid
    moves, nothing is written any more.

    Repeated rows count as often as they stand there; other columns are ignored; with fewer vectors than
    ``clusters`` there are fewer centroids; an empty table gives no rows. A scaled component of 2^27 or
    more raises, as distances could leave 64 bits.
    """
    spark = vectors.sparkSession
    kept = _kept(vectors, id_col, vector_col, dimension, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select("v", order.alias("order")).orderBy("order", "v").limit(clusters).collect()
    kind = kept.schema["vec_id"].dataType.simpleString()
    result = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>"
    if not first:
        return spark.createDataFrame([], f"vec_id {kind}, distance bigint, {result}").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
        )
    centroids = np.array([row["v"] for row in first], np.int64)
    path, state = _written(kept.mapInArrow(_assigned(centroids, lambda x, batch, c=centroids: x @ c.T), _state(kind)))
    for _ in range(rounds):
        moved = _means(state, centroids)
        delta, centroids = moved - centroids, moved
        if not delta.any():
            break

        def products(x: np.ndarray, batch: pa.RecordBatch, delta: np.ndarray = delta) -> np.ndarray:
            return _moved(delta, x, batch.column("products").flatten().to_numpy().reshape(len(x), -1))

        before = path
        path, state = _written(state.mapInArrow(_assigned(centroids, products), _state(kind)))
        delete_folder(spark, before)
    inertia = {row["cluster"]: row["inertia"] for row in state.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    total = sum(inertia.values())
    rows = [
        (at, own, total, hashlib.sha256(",".join(map(str, centroids[at].tolist())).encode()).hexdigest(), centroids[at].tolist())
        for at, own in inertia.items()
    ]
    # one row per cluster
    told = F.broadcast(spark.createDataFrame(rows, result))
    return state.select("vec_id", "cluster", "distance").join(told, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
