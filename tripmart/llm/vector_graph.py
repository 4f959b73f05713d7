"""Approximate nearest neighbours by robust-pruned directed graphs over shards of the vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import materialize

#: Vectors of a shard, and queries that search it in one task.
SHARD, QUERIES = 8192, 1024
#: Edges of a node, candidates kept by a search while building and while asking, and how much nearer to a
#: kept edge a node must be than to the edge's owner before its own edge is dropped.
DEGREE, BUILD_BEAM, BEAM, RELAXED = 32, 64, 128, 1.2
#: Nodes searched, or pruned, at a time.
BATCH = 256


class Graph:
    """A directed graph over the vectors of a shard; unused places of a node's edges hold the node itself."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None, start: int = 0, degree: int = DEGREE):
        # proposals need no more than single precision, in a range whose squares it holds
        largest = float(np.abs(vectors).max()) if vectors.size else 0.0
        self.scale = 1.0 / largest if largest > 0 else 1.0
        self.vectors = (vectors * self.scale).astype(np.float32)
        self.squares = (self.vectors * self.vectors).sum(axis=1)
        n = len(vectors)
        self.edges = np.repeat(np.arange(n, dtype=np.int32)[:, None], degree, axis=1) if edges is None else edges
        self.start, self.degree = start, degree

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Greedy beam search for many (scaled) queries at once.

        Returns the ``width`` nearest nodes met by each query, -1 where there are fewer, and the steps: which
        queries opened which nodes.
        """
        n, everyone = len(self.vectors), np.arange(len(queries))
        met = np.zeros((len(queries), n), bool)
        met[:, self.start] = True
        beam = np.full((len(queries), width), -1, np.int32)
        away = np.full((len(queries), width), np.inf, np.float32)
        opened = np.ones((len(queries), width), bool)
        beam[:, 0], opened[:, 0] = self.start, False
        away[:, 0] = self.squares[self.start] - 2 * (queries @ self.vectors[self.start])
        active, steps = everyone, []
        while len(active):
            # beams are sorted, so the first node that is not opened is the nearest one
            at = (~opened[active]).argmax(axis=1)
            left = ~opened[active, at]
            active, at = active[left], at[left]
            if not len(active):
                break
            node = beam[active, at]
            opened[active, at] = True
            steps.append((active, node))
            near = self.edges[node]
            fresh = ~met[active[:, None], near]
            met[active[:, None], near] = True
            reach = self.squares[near] - 2 * np.einsum("ad,ard->ar", queries[active], self.vectors[near])
            ids = np.concatenate([beam[active], near], axis=1)
            all_away = np.concatenate([away[active], np.where(fresh, reach, np.inf)], axis=1)
            all_opened = np.concatenate([opened[active], ~fresh], axis=1)
            order = np.argsort(all_away, axis=1, kind="stable")[:, :width]
            away[active] = np.take_along_axis(all_away, order, axis=1)
            beam[active] = np.where(np.isfinite(away[active]), np.take_along_axis(ids, order, axis=1), -1)
            opened[active] = np.take_along_axis(all_opened, order, axis=1)
        return beam, steps

    def prune(self, nodes: np.ndarray, candidates: np.ndarray, relaxed: float) -> np.ndarray:
        """The edges that each node keeps of its candidates, whose unused places hold the node itself.

        The nearest candidate is kept, and all those go that are nearer to it, by the factor ``relaxed``,
        than to the node; then the nearest one left, and so on. Edges so point in different directions.
        """
        own = self.vectors[nodes]
        away = self.squares[candidates] - 2 * np.einsum("bd,bcd->bc", own, self.vectors[candidates]) + self.squares[nodes][:, None]
        away = np.where(candidates == nodes[:, None], np.inf, np.maximum(away, 0))
        order = np.argsort(away, axis=1, kind="stable")
        candidates, away = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(away, order, axis=1)
        points, squares = self.vectors[candidates], self.squares[candidates]
        between = np.maximum(squares[:, :, None] + squares[:, None, :] - 2 * (points @ points.transpose(0, 2, 1)), 0)
        alive, rows = np.isfinite(away), np.arange(len(nodes))
        kept = np.repeat(nodes[:, None].astype(np.int32), self.degree, axis=1)
        for place in range(self.degree):
            at = alive.argmax(axis=1)
            some = alive[rows, at]
            if not some.any():
                break
            chosen = candidates[rows, at]
            kept[some, place] = chosen[some]
            alive &= (relaxed * relaxed * between[rows, at] > away) & (candidates != chosen[:, None])
        return kept

    def add_back(self, nodes: np.ndarray, relaxed: float) -> None:
        """Edges back to the nodes from where theirs point to; a node with too many edges prunes them."""
        sources = np.repeat(nodes, self.edges.shape[1]).astype(np.int32)
        targets = self.edges[nodes].ravel()
        new = (self.edges[targets] != sources[:, None]).all(axis=1) & (sources != targets)
        sources, targets = sources[new], targets[new]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        owners, first, counts = np.unique(targets, return_index=True, return_counts=True)
        rank = np.arange(len(targets)) - np.repeat(first, counts)
        filled = (self.edges[owners] != owners[:, None]).sum(axis=1)
        fits = filled + counts <= self.degree
        easy = np.repeat(fits, counts)
        # kept edges stand in the first places of a row, so the next ones are free
        self.edges[targets[easy], (np.repeat(filled, counts) + rank)[easy]] = sources[easy]
        crowded = np.flatnonzero(~fits)
        crowded = crowded[np.argsort(counts[crowded], kind="stable")]
        at = 0
        while at < len(crowded):
            # wide rows are pruned few at a time, as each compares its candidates with each other
            part = crowded[at : at + BATCH]
            widest = self.degree + counts[part]
            part = part[: max(1, int((np.arange(1, len(part) + 1) * widest.astype(np.int64) ** 2 <= 4_000_000).sum()))]
            size = int(counts[part].max())
            own = owners[part]
            candidates = np.repeat(own[:, None].astype(np.int32), self.degree + size, axis=1)
            candidates[:, : self.degree] = self.edges[own]
            row = np.repeat(np.arange(len(part)), counts[part])
            place = np.concatenate([np.arange(c) for c in counts[part]])
            candidates[row, self.degree + place] = sources[np.repeat(first[part], counts[part]) + place]
            self.edges[own] = self.prune(own, candidates, relaxed)
            at += len(part)

    def connect(self) -> None:
        """Give every node that no search could reach an edge from the nearest one that can be, in a further place if need be."""
        n = len(self.vectors)
        reached = np.zeros(n, bool)

        def walk(front: np.ndarray) -> None:
            while len(front):
                reached[front] = True
                front = np.unique(self.edges[front])
                front = front[~reached[front]]

        walk(np.array([self.start]))
        while not reached.all():
            lost = int(np.flatnonzero(~reached)[0])
            known = np.flatnonzero(reached)
            away = self.squares[known] - 2 * (self.vectors[known] @ self.vectors[lost])
            free = (self.edges[known] == known[:, None]).any(axis=1)
            if not free.any():
                self.edges = np.concatenate([self.edges, np.arange(n, dtype=np.int32)[:, None]], axis=1)
                free[:] = True
            owner = known[free][np.argmin(away[free])]
            self.edges[owner, np.flatnonzero(self.edges[owner] == owner)[0]] = lost
            walk(np.array([lost]))


def built(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED) -> Graph:
    """The graph of a shard: nodes enter by chance order in growing batches.

    Each searches the graph as it is, prunes the nodes opened on its way to its edges, and gets
    edges back from them.
    """
    graph = Graph(vectors, degree=degree)
    points = graph.vectors
    graph.start = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    order = np.random.default_rng(7).permutation(len(points))
    order = order[order != graph.start]
    done = 0
    while done < len(order):
        nodes = order[done : done + min(max(1, done), BATCH)]
        found, steps = graph.search(points[nodes], beam)
        way = np.repeat(nodes[:, None].astype(np.int32), len(steps) + found.shape[1], axis=1)
        for at, (who, opened) in enumerate(steps):
            way[who, at] = opened
        way[:, len(steps) :] = np.where(found >= 0, found, nodes[:, None])
        # nodes opened and kept stand twice; pruning takes either once
        graph.edges[nodes] = graph.prune(nodes, way, relaxed)
        graph.add_back(nodes, relaxed)
        done += len(nodes)
    graph.connect()
    return graph


def _usable(vector: Column) -> Column:
    """Not null or empty, not all zero, every component finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """``v, dim, ids``: each different vector once, with the ``k + 1`` smallest of its ids.

    No query has use for more of them, as it leaves out one id at most. The window is cut to those before the shuffle
    too, so a vector that a third of all rows share is no large group.
    """
    ids = Window.partitionBy("v").orderBy("vec_id")
    first = rows.select("vec_id", "v").distinct().withColumn("nth", F.row_number().over(ids)).filter(F.col("nth") <= k + 1)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("v"))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64)


def index(rows: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """``dim, shard, ids, vectors, edges, width, start``: one row per shard with its graph, written to the shared folder.

    ``rows`` has ``vec_id, v`` of usable vectors. Shards are dealt by a hash of the vector, so they are of equal
    size and a query has to ask each of them.
    """
    classes = materialize(_classes(rows, k), "classes")
    sizes = classes.groupBy("dim").agg(F.ceil(F.count("*") / shard).alias("shards"))
    dealt = classes.join(materialize(sizes, "shards"), "dim").withColumn("shard", F.pmod(F.xxhash64("v"), "shards").cast("int"))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def build(group: pd.DataFrame) -> pd.DataFrame:
        vectors = _matrix(group["v"])
        graph = built(vectors)
        return pd.DataFrame(
            {
                "dim": [group["dim"].iloc[0]], "shard": [group["shard"].iloc[0]], "ids": [list(map(list, group["ids"]))],
                "vectors": [vectors.tobytes()], "edges": [graph.edges.tobytes()], "width": [graph.edges.shape[1]], "start": [graph.start],
            }
        )

    schema = f"dim int, shard int, ids array<array<{kind}>>, vectors binary, edges binary, width int, start int"
    return materialize(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "graphs")


def _best(ids: list[np.ndarray], nodes: np.ndarray, vectors: np.ndarray, query_id: object, query: np.ndarray, k: int) -> list[tuple]:
    """The ``k`` nearest ids of the nodes found, by the exact distance; ties to the smaller id."""
    away = np.sqrt(((vectors[nodes] - query) ** 2).sum(axis=1))
    found, seen = [], {query_id}
    for distance, one in sorted((d, i) for d, node in zip(away.tolist(), nodes, strict=True) for i in ids[node]):
        if one not in seen:
            seen.add(one)
            found.append((query_id, one, distance))
            if len(found) == k:
                break
    return found


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int = SHARD,
    beam: int = BEAM,
    query_block: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for those where ``queries`` holds.

    Nearness is Euclidean distance in double precision on the vectors as they are; ties go to the
    smaller ``vec_id``; an id is no candidate for itself. Every vector is in the graph of its shard, every
    shard's graph is searched for every query, in blocks of ``query_block``, and the best of all shards are
    ranked. Searches may miss neighbours; of those found, all distances are exact. Shards grow in number with the
    vectors, and a shard and a block of queries are what a task holds.

    Vectors that are null, empty, all zero, or hold a null or a component that is not finite take no
    part, and neither do null ids. Vectors of different length are not compared. Rows equal in id and
    vector count once; an id with several vectors asks and is found by each, at the smallest distance. Other columns
    are ignored. An empty table, or one without queries, gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("raw"), queries.alias("q"))
    rows = rows.filter(F.col("vec_id").isNotNull() & _usable(F.col("raw"))).select(
        "vec_id", F.col("raw").cast("array<double>").alias("v"), F.coalesce("q", F.lit(False)).alias("q")
    )
    graphs = index(rows, k, shard)
    asked = rows.filter("q").select("vec_id", "v", F.size("v").alias("dim")).distinct()
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / query_block).alias("blocks"))
    shards = graphs.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    plan = materialize(blocks.join(shards, "dim"), "search-plan")
    block = F.pmod(F.xxhash64("vec_id", "v"), "blocks").cast("int").alias("block")
    asked = asked.join(plan, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), block, "vec_id", "v")
    ready = graphs.join(plan.select("dim", "blocks"), "dim").select(
        *graphs.columns, F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("block")
    )
    kind = rows.schema["vec_id"].dataType.simpleString()

    def search(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asks):
            one = own.iloc[0]
            points = np.frombuffer(one["vectors"]).reshape(-1, int(one["dim"]))
            graph = Graph(points, np.frombuffer(one["edges"], np.int32).reshape(-1, int(one["width"])), int(one["start"]))
            ids, questions, names = [list(i) for i in one["ids"]], _matrix(asks["v"]), asks["vec_id"].tolist()
            for at in range(0, len(names), BATCH):
                part = slice(at, at + BATCH)
                scaled = (questions[part] * graph.scale).astype(np.float32)
                nodes, _ = graph.search(scaled, max(beam, k + 1))
                for name, question, met in zip(names[part], questions[part], nodes, strict=True):
                    found += _best(ids, met[met >= 0], points, name, question, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    key = ["dim", "shard", "block"]
    found = asked.groupBy(*key).cogroup(ready.groupBy(*key)).applyInPandas(
        lambda asks, own: search(own, asks), f"query_id {kind}, vec_id {kind}, score double"
    )
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
