"""Approximate nearest neighbours by a permutation index.

Every vector is known by its `prefix` nearest pivots in order. Rows are dealt
into shards; within a shard, vectors are posted in one inverted file per pivot
with their place in the order. A query reads the files of its own pivots, ranks
the shard's vectors by Spearman's footrule of the two orders, and the best
`share` of them are compared by their true cosine in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEIGHBOURS = "query_id long, query_row long, vec_id long, row long, score double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """row, vec_id and vector (doubles) of the rows that take part: an id, and a finite vector that isn't zero.

    Rows of one id are vectors of their own, told apart by `row`. Vectors of another than the
    most frequent dimension (the smaller, if two are as frequent) take no part.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.monotonically_increasing_id().alias("row"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0]["d"] if sizes else 0))


def weights(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector: its nearest pivots, nearest first (ties: the lower number), and prefix minus their places."""
    near = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ pivots.T
    order = np.argsort(-near, axis=1, kind="stable")[:, :prefix]
    return order, np.broadcast_to(np.arange(prefix, 0, -1), order.shape)


def search_shard(ids: np.ndarray, rows_of: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, query_rows: np.ndarray, queries: np.ndarray,
                 pivots: np.ndarray, prefix: int, share: float, least: int, k: int) -> list[tuple[int, int, int, int, float]]:
    """The k nearest found of each query among the other vectors of a shard, by the index."""
    by_id = np.lexsort((rows_of, ids))
    ids, rows_of, vectors, n = ids[by_id], rows_of[by_id], vectors[by_id], len(ids)
    near, weight = weights(vectors, pivots, prefix)
    by_pivot = np.argsort(near.ravel(), kind="stable")
    rows, posted = by_pivot // near.shape[1], weight.ravel()[by_pivot].astype(np.int32)
    edges = np.searchsorted(near.ravel()[by_pivot], np.arange(len(pivots) + 1))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    depth = min(n, max(least, int(np.ceil(share * n))))
    out = []
    for query_id, query_row, q, own, own_weight in zip(query_ids, query_rows, queries, *weights(queries, pivots, prefix)):
        # the footrule is a constant less twice this sum over common pivots; a pivot beyond the prefix has place `prefix`
        common = np.zeros(n, dtype=np.int64)
        for p, w in zip(own, own_weight):
            files = slice(edges[p], edges[p + 1])
            common[rows[files]] += np.minimum(posted[files], w)
        rank = common * n + np.arange(n - 1, -1, -1)  # ties: the smaller id
        found = np.argpartition(-rank, depth - 1)[:depth] if depth < n else np.arange(n)
        found = found[rows_of[found] != query_row]
        score = (vectors[found] * q).sum(axis=1) / (norms[found] * np.sqrt((q * q).sum()))
        for i in np.lexsort((ids[found], -score))[:k]:
            out.append((query_id, query_row, ids[found[i]], rows_of[found[i]], score[i]))
    return out


def neighbours(vectors: DataFrame, queries_where, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
               pivots: int = 512, prefix: int = 128, share: float = 0.15, least: int = 256,
               shard_rows: int = 8192, block_queries: int = 1024) -> DataFrame:
    """The k nearest found of each query row (`queries_where`, on vec_id) among all other rows.

    Returns query_id, rank (from 1), vec_id, score (cosine); ties go to the
    smaller vec_id. Rows of one id are queries and candidates of their own; other columns do not matter. Without usable rows the result is empty. Pivots are the `pivots` rows of smallest id hash, at most 512
    vectors on the driver. Tasks hold `shard_rows` vectors and `block_queries` queries.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    sample = [r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(pivots).collect()]
    p = np.array(sample, dtype=np.float64).reshape(len(sample), len(sample[0]) if sample else 1)
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast(p)
    n, nq = rows.agg(F.count("*"), F.count_if(queries_where)).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-nq // block_queries))
    part = lambda seed, m: F.pmod(F.xxhash64("vec_id", "row", F.lit(seed)), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    data = rows.select("vec_id", "row", "vector", part(1, shards).alias("shard"), each(blocks).alias("block"))
    asked = rows.where(queries_where).select("vec_id", "row", "vector", part(2, blocks).alias("block"), each(shards).alias("shard"))

    def cell(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = search_shard(left["vec_id"].to_numpy(), left["row"].to_numpy(), np.stack(left["vector"].to_list()), right["vec_id"].to_numpy(), right["row"].to_numpy(),
                                 np.stack(right["vector"].to_list()), shared.value, min(prefix, len(shared.value)), share, least, k)
        return pd.DataFrame(found, columns=["query_id", "query_row", "vec_id", "row", "score"]).astype({c: "int64" for c in ("query_id", "query_row", "vec_id", "row")} | {"score": "float64"})

    found = data.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(cell, NEIGHBOURS)
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
