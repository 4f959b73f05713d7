"""Exact top-k search by inner product, reading sorted lists without random access."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import materialize

SCALE = 256
CANDIDATES = 4096
QUERIES = 512
#: Shares of the lists that have been read when bounds are looked at.
DEPTHS = (0.1, 0.25, 0.45, 0.7, 0.9)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, whole)


def _kth_largest(values: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Of each row the ``k``-th largest value of different ids, whose columns begin at ``first``."""
    best = np.maximum.reduceat(values, first, axis=1)
    if best.shape[1] <= k:
        return np.full(len(values), -np.inf)
    return np.partition(best, -k, axis=1)[:, -k]


def best_of_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, read: list[int] | None = None
) -> pd.DataFrame:
    """Each query's best ``k`` ids of a block of candidates, ties to the smaller id.

    A component's list holds the block sorted by it; a query reads it from the top if its own
    component is positive, else from the bottom, so contributions come in falling order. What has
    been read of a candidate, and the last value read of each other list, bound its score from above;
    with the lists' lowest contributions they bound it from below. The k-th best lower bound of different ids bars
    all candidates below it; those that no query can use any more are left out of the lists. Reading stops when no more
    than a few candidates are left, whose scores are resolved then. ``read`` gets the entries read for each query.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    n = len(ids)
    by_value = np.argsort(vectors, axis=0, kind="stable")
    rank = np.empty_like(by_value)
    np.put_along_axis(rank, by_value, np.arange(n)[:, None], axis=0)
    ascending = np.take_along_axis(vectors, by_value, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    left, left_queries = np.arange(n), np.arange(len(queries))
    # what has been read of each candidate left, by query
    known, before, found = np.zeros((len(queries), n)), 0, []
    for share in (*DEPTHS, 1.0):
        if not len(left_queries) or not len(left):
            break
        depth = max(1, int(np.ceil(n * share)))
        plus, minus, places = up[left_queries], down[left_queries], rank[left]
        from_top, from_bottom = places >= n - depth, places < depth
        own = vectors[left]
        known += plus @ (own * (from_top & (places < n - before))).T + minus @ (own * (from_bottom & (places >= before))).T
        before = depth
        unread_top, unread_bottom = (~from_top).T.astype(np.float64), (~from_bottom).T.astype(np.float64)
        upper = known + (plus * ascending[n - depth]) @ unread_top + (minus * ascending[depth - 1]) @ unread_bottom
        lower = known + (plus * ascending[0]) @ unread_top + (minus * ascending[-1]) @ unread_bottom
        self_row = query_ids[left_queries][:, None] == ids[left][None, :]
        lower[self_row] = upper[self_row] = -np.inf
        first = np.flatnonzero(np.r_[True, ids[left][1:] != ids[left][:-1]])
        rivals = (upper >= _kth_largest(lower, first, k)[:, None]) & ~self_row
        done = (rivals.sum(axis=1) <= max(4 * k, n // 50)) | (share == 1.0)
        for at in np.flatnonzero(done):
            place = left[rivals[at]]
            scores = vectors[place] @ queries[left_queries[at]]
            best = np.lexsort((ids[place], -scores))
            # an id counts once, with its best score
            _, once = np.unique(ids[place][best], return_index=True)
            best = best[np.sort(once)[:k]]
            found.append(
                pd.DataFrame({"query_id": query_ids[left_queries[at]], "vec_id": ids[place[best]], "score": scores[best].astype(np.int64)})
            )
            if read is not None:
                read.append(depth * queries.shape[1])
        wanted = rivals[~done].any(axis=0)
        known, left, left_queries = known[~done][:, wanted], left[wanted], left_queries[~done]
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    block: int = CANDIDATES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores of the rows where ``queries`` holds.

    The score is the inner product of the vectors of ``floor(scale * x)``; ties go to the smaller
    ``vec_id``; a row is no candidate for itself, that is, for a query of its own id. Candidates are
    dealt out in blocks by chance and queries in others; each pair of blocks is one group of bounded
    size, searched by threshold bounds over sorted lists, and each query's best of all blocks are
    ranked at the end, after each block has left ``k`` of them.

    A vector that is null, empty, or holds a null or a component that is not finite takes no part, and
    neither does a null id. Vectors of different length are not compared. Rows equal in id and
    vector count once; an id with several vectors takes part with each, and as a candidate with its
    best score. Scores must stay below 2^53, where floating point is exact. Other columns are ignored. An empty table, or one without queries, gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"), queries.alias("q"))
    rows = rows.filter("vec_id is not null and v is not null").distinct()
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if("q").alias("n_queries"))
    sizes = sizes.select(
        "dim",
        F.ceil(F.col("n") / block).alias("blocks"),
        F.ceil(F.col("n_queries") / QUERIES).alias("query_blocks"),
    ).filter("query_blocks > 0")
    rows = rows.withColumn("dim", F.size("v")).join(materialize(sizes, "sizes"), "dim")
    mix = F.xxhash64("vec_id", "v")
    candidates = rows.select(
        "vec_id", "v", "dim", F.pmod(mix, "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("query_blocks") - 1)).alias("query_block"),
        F.lit(False).alias("is_query"),
    )
    asked = rows.filter("q").select(
        "vec_id", "v", "dim", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
        F.pmod(mix, "query_blocks").alias("query_block"), F.lit(True).alias("is_query"),
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["is_query"].to_numpy()
        ids, values = group["vec_id"].to_numpy(), np.stack(group["v"].to_numpy()).astype(np.float64)
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best_of_block(ids[~asks], values[~asks], ids[asks], values[asks], k)

    kind = rows.schema["vec_id"].dataType.simpleString()
    found = candidates.unionByName(asked).groupBy("dim", "block", "query_block").applyInPandas(
        search, f"query_id {kind}, vec_id {kind}, score bigint"
    )
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
