from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tripmart.llm import queries, vector_graph


def brute_force(rows: list[tuple], asks, k: int) -> dict[object, list[tuple]]:
    """The ``k`` nearest (distance, id) of each query id by comparing it with every row."""
    rows = [(i, np.array(v, float)) for i, v in rows]
    found = {}
    for i, v in rows:
        if asks(i):
            best = found.setdefault(i, {})
            for j, w in rows:
                if j != i and len(v) == len(w):
                    best[j] = min(best.get(j, math.inf), float(np.sqrt(((v - w) ** 2).sum())))
    return {i: sorted((d, j) for j, d in best.items())[:k] for i, best in found.items()}


def answers(df) -> dict[object, list[tuple]]:
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        own = found.setdefault(row["query_id"], [])
        own.append((row["score"], row["vec_id"]))
        assert row["rank"] == len(own)
    return found


def recall(found: dict, expected: dict) -> float:
    hits = sum(len({j for _, j in found.get(i, [])} & {j for _, j in best}) for i, best in expected.items())
    return hits / sum(len(best) for best in expected.values())


def test_recall_and_exact_distances_on_a_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    found = queries.op11_vector_graph(spark, SF_DIR)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got, expected = answers(found), brute_force(rows, lambda i: i % 100 == 0, 10)
    assert recall(got, expected) >= 0.9
    values = dict(rows)
    for i, own in got.items():
        assert len(own) == 10 and own == sorted(own) and i not in {j for _, j in own}
        for score, j in own:
            assert score == pytest.approx(math.dist(values[i], values[j]), rel=1e-12)


def test_recall_over_several_shards_and_blocks(spark):
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 1, (12, 24))
    rows = [(i, [float(x) for x in middles[i % 12] + rng.normal(0, 0.4, 24)]) for i in range(3000)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = answers(vector_graph.nearest(vectors, F.col("vec_id") % 25 == 0, shard=700, query_block=40, beam=64))
    exact = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert recall(got, brute_force(exact, lambda i: i % 25 == 0, 10)) >= 0.95


def test_every_node_can_be_reached(spark):
    rng = np.random.default_rng(1)
    # a far cluster, a line of points and single outliers
    points = np.concatenate([rng.normal(0, 1, (400, 8)), rng.normal(1000, 1e-3, (300, 8)), np.linspace(0, 50, 200)[:, None] * np.ones(8), rng.normal(0, 1e6, (20, 8))])
    graph = vector_graph.built(points, degree=4, beam=8)
    reached, front = {graph.start}, [graph.start]
    while front:
        front = [int(j) for i in front for j in graph.edges[i] if int(j) not in reached]
        front = list(dict.fromkeys(front))
        reached.update(front)
    assert len(reached) == len(points)


def test_pruning_keeps_edges_in_different_directions():
    points = np.array([[0.0, 0], [1, 0], [1.1, 0], [1.2, 0.1], [0, 2], [-3, 0], [-3.1, 0]])
    graph = vector_graph.Graph(points, degree=4)
    kept = graph.prune(np.array([0]), np.array([[1, 2, 3, 4, 5, 6, 1]], np.int32), 1.2)[0]
    assert kept.tolist() == [1, 4, 5, 0]


def awkward(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(60)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(60, 200)]  # many copies: ties to the smaller id
    rows += [(7, [float(x) for x in rng.normal(0, 1, 4)]) for _ in range(6)] + [rows[0]] * 5  # an id of several vectors, repeated rows
    rows += [(300, [1.0, 1.0]), (301, [1.0, 2.0]), (302, [5.0])]  # of other lengths
    bad = [(400, None), (401, []), (402, [0.0] * 4), (403, [1.0, None, 1.0, 1.0]), (404, [1.0, math.nan, 1.0, 1.0]), (405, [1.0, math.inf, 1.0, 1.0]), (None, [1.0] * 4)]
    schema = "vec_id bigint, embedding array<double>, rank string, score string, v int, q boolean, shard int, dim int, ids int"
    return rows, spark.createDataFrame([(i, v, "x", None, 1, None, 2, 3, 4) for i, v in rows + bad], schema)


def test_awkward_rows(spark):
    rows, vectors = awkward(spark)
    # beams as wide as the table, so the search has to find all
    got = answers(vector_graph.nearest(vectors, F.col("vec_id") % 10 < 8, k=6, beam=400))
    expected = brute_force(rows, lambda i: i % 10 < 8, 6)
    assert {i: [j for _, j in own] for i, own in got.items()} == {i: [j for _, j in own] for i, own in expected.items() if own}
    assert vector_graph.nearest(vectors.limit(0), F.lit(True)).collect() == []
    assert vector_graph.nearest(vectors, F.lit(False)).collect() == []
    assert vector_graph.nearest(vectors, F.lit(None).cast("boolean")).collect() == []


def test_fewer_candidates_than_asked_for(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "vec_id bigint, embedding array<float>")
    got = answers(vector_graph.nearest(vectors, F.col("vec_id") == 0))
    assert got == {0: [(1.0, 1), (2.0, 2), (3.0, 3)]}
