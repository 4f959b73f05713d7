from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tripmart.llm import centroids, queries


def brute_force(rows: list[tuple], clusters: int = 16, rounds: int = 3, scale: int = 64) -> list[tuple]:
    """All distances anew in every round, in Python's whole numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    middle = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]

    def assign() -> list[tuple[int, int]]:
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), at) for at, c in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for at in range(len(middle)):
            members = [v for (_, v), (_, cluster) in zip(kept, own) if cluster == at]
            if members:
                middle[at] = [sum(column) // len(members) for column in zip(*members)]
    own = assign()
    total = sum(d for d, _ in own)
    inertia = [sum(d for d, c in own if c == at) for at in range(len(middle))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return [(i, c, d, inertia[c], total, digest[c]) for (i, _), (d, c) in zip(kept, own)]


def usable(rows: list[tuple], dimension: int = 64) -> list[tuple]:
    return [(i, v) for i, v in rows if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]


def test_whole_table_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    found = queries.op13_centroids(spark, SF_DIR)
    assert found.dtypes == [
        ("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"),
    ]
    assert sorted(map(tuple, found.collect())) == sorted(brute_force(usable(rows)))


def awkward(spark, dimension: int = 3):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 4, dimension)]) for i in range(40)]
    rows += [(41, None), (42, []), (43, [1.0, 2.0]), (44, [1.0, None, 2.0]), (45, [1.0, math.nan, 2.0]), (46, [1.0, math.inf, 2.0])]
    rows += [rows[0]] * 30 + [(0, [9.0, 9.0, 9.0]), (None, [1.0, -1.0, 0.5]), (47, [0.0, -0.0, 0.0])]
    schema = "vec_id bigint, embedding array<double>, cluster string, distance string, v int, products int"
    return rows, spark.createDataFrame([(i, v, "x", None, 1, 2) for i, v in rows], schema)


@pytest.mark.parametrize(("clusters", "rounds"), [(4, 3), (7, 0), (200, 2)])
def test_awkward_rows(spark, clusters, rounds):
    rows, vectors = awkward(spark)
    found = centroids.clustered(vectors, clusters=clusters, rounds=rounds, dimension=3).drop("centroid")
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_force(usable(rows, 3), clusters, rounds), key=key)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    # equal vectors under many ids: all centroids are alike, so all rows are of the first one
    vectors = spark.range(50).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.5), 64).alias("embedding"))
    found = centroids.clustered(vectors).select("cluster", "distance", "inertia").distinct().collect()
    assert list(map(tuple, found)) == [(0, 0, 0)]


def test_products_stay_exact_and_are_updated_where_a_component_moved():
    rng = np.random.default_rng(2)
    x = rng.integers(-(1 << 26), 1 << 26, (500, 64))
    before = rng.integers(-(1 << 26), 1 << 26, (16, 64))
    after = before.copy()
    after[3, 5] += 7
    after[9] = rng.integers(-(1 << 26), 1 << 26, 64)
    delta = after - before
    assert (centroids._moved(delta, x, x @ before.T) == x @ after.T).all()

    class Watched(np.ndarray):
        taken = []

        def __getitem__(self, key):
            Watched.taken.append(len(key[1]))
            return np.asarray(super().__getitem__(key))

    centroids._moved(delta, x.view(Watched), x @ before.T)
    assert Watched.taken == [1, 64]


def test_no_rows_and_values_that_are_too_large(spark):
    _, vectors = awkward(spark)
    assert centroids.clustered(vectors.limit(0)).collect() == []
    assert centroids.clustered(vectors).collect() == []
    with pytest.raises(Exception, match="not below"):
        centroids.clustered(spark.createDataFrame([(1, [1e30])], "vec_id bigint, embedding array<double>"), dimension=1).collect()
