"""Approximate nearest neighbours by a permutation index.

Every vector is represented by the order of a few pivots as seen from it.
Blocks of vectors keep one inverted file per pivot with the place of that pivot
in each vector's order. A query adds up, pivot by pivot, how far the places
differ from its own (Spearman's footrule), reranks the vectors with the
smallest distance by the exact measure, and the blocks' best are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 96
SHARE = 0.25
LEAST_CANDIDATES = 600
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
NEIGHBOURS = 20
QUERY_EVERY = 20


def usable(vector: Column) -> Column:
    """True for vectors with finite components of which one is not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part, in double precision."""
    return (vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector)))
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")))


def choose_pivots(vectors: DataFrame, dimension: int, pivots: int = PIVOTS) -> np.ndarray:
    """At most ``pivots`` vectors by a hash of their id: the bounded sample the index is fitted on.

    An id has one pivot, its smallest vector.
    """
    fit = vectors.where(F.size("v") == dimension)
    picked = (fit.select("vec_id", F.xxhash64("vec_id", F.lit(1)).alias("h")).distinct()
              .orderBy("h", "vec_id").limit(pivots))
    rows = (fit.join(F.broadcast(picked), "vec_id").groupBy("h", "vec_id").agg(F.min("v").alias("v"))
            .orderBy("h", "vec_id").collect())
    return np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), dimension)


def pivot_places(x: np.ndarray, pivots: np.ndarray, largest: float, is_query: bool = False) -> np.ndarray:
    """Place of every pivot in each row's order, nearest first (rows x pivots).

    For the inner product, vectors gain one coordinate that gives all the same
    length ``largest`` (0 for queries), so the nearest pivot is the one with the
    largest product.
    """
    def lift(m):
        return np.sqrt(np.maximum(largest ** 2 - (m * m).sum(axis=1), 0.0))
    near = x @ pivots.T
    if not is_query:
        near = near + lift(x)[:, None] * lift(pivots)[None, :]
    order = np.argsort(-near, axis=1, kind="stable")
    places = np.empty_like(order)
    np.put_along_axis(places, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
    return places.astype(np.int16)


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, pivots: np.ndarray,
                 largest: float, neighbours: int, share: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best neighbours of every query among a block's rows: (query_id, vec_id, score), exact scores.

    Rows that repeat an id are one candidate, as near as the nearest of them and
    with the best of their exact scores.
    """
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    row_ids = ids
    ids, starts, repeats = np.unique(row_ids, return_index=True, return_counts=True)
    repeated = len(ids) < len(row_ids)
    # inverted files: for every pivot its place in the order of each row
    files = np.ascontiguousarray(pivot_places(x, pivots, largest).T)
    wanted = pivot_places(q, pivots, largest, is_query=True)
    keep = min(len(ids), max(least, neighbours + 1, int(np.ceil(share * len(ids)))))
    row_number = np.arange(len(ids), dtype=np.int64)
    out = []
    buffer = np.empty(len(row_ids), dtype=np.int16)
    for j, query_id in enumerate(query_ids):
        distance = np.zeros(len(row_ids), dtype=np.int32)
        for p, place in enumerate(wanted[j]):
            np.subtract(files[p], place, out=buffer)
            np.abs(buffer, out=buffer)
            distance += buffer
        if repeated:
            distance = np.minimum.reduceat(distance, starts)
        # equal distances: the smaller id first
        key = distance * np.int64(len(ids)) + row_number
        near = np.argpartition(key, keep - 1)[:keep] if keep < len(ids) else row_number
        near = near[ids[near] != query_id]
        if repeated and len(near):
            sizes = repeats[near]
            at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            rows = np.repeat(starts[near] - at, sizes) + np.arange(sizes.sum())
            score = np.maximum.reduceat(x[rows] @ q[j], at)
        else:
            score = x[starts[near]] @ q[j]
        if len(near) > neighbours:
            edge = np.partition(score, len(score) - neighbours)[len(score) - neighbours]
            near, score = near[score >= edge], score[score >= edge]
        best = np.lexsort((ids[near], -score))[:neighbours]
        out.append((np.full(len(best), query_id), ids[near][best], score[best]))
    if not out:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _packed(rows: pa.Table) -> pa.Table:
    """A block's rows as one row of raw bytes."""
    return pa.table({"block": rows["block"].slice(0, 1),
                     "ids": pa.array([rows["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                     "data": pa.array([np.concatenate(rows["v"].to_numpy()).astype("<f8").tobytes()], pa.binary())})


def blocks_of(vectors: DataFrame, rows: int, per_block: int) -> tuple[DataFrame, int]:
    """Hash the rows into blocks of about ``per_block`` and pack each into one row."""
    n = max(1, -(-rows // per_block))
    packed = (vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
              .groupBy("block").applyInArrow(_packed, "block int, ids binary, data binary"))
    return packed, n


def nearest(vectors: DataFrame, queries: DataFrame, neighbours: int = NEIGHBOURS, pivots: int = PIVOTS,
            share: float = SHARE, least: int = LEAST_CANDIDATES, block_rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``neighbours`` best found of every query.

    ``vectors`` and ``queries`` have vec_id and v. The most frequent dimension of
    ``vectors`` is indexed; vectors of another one take no part. A query's own id
    is no answer; rows that repeat an id answer once, with their best score; equal scores go to
    the smaller id; an empty side gives an empty result. Every block reranks the
    ``share`` of its rows (at least ``least``) that the footrule puts first, so the
    reranked part grows with the data. Query blocks meet vector blocks by an
    equi-join of block pairs; a task holds one pair at a time.
    """
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    spark = vectors.sparkSession
    stats = (vectors.groupBy(F.size("v").alias("d"))
             .agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("m"))
             .orderBy(F.desc("n"), "d").limit(1).collect())
    if not stats:
        return spark.createDataFrame([], empty)
    dimension, rows, largest = stats[0]["d"], stats[0]["n"], stats[0]["m"]
    chosen = choose_pivots(vectors, dimension, pivots)
    asked = queries.where(F.size("v") == dimension)
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], empty)
    stored, n_blocks = blocks_of(vectors.where(F.size("v") == dimension), rows, block_rows)
    wanted, n_query_blocks = blocks_of(asked, n_asked, query_rows)
    left = stored.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))))
    right = (wanted.withColumnRenamed("block", "query_block")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))

    def search(stored_block: pa.Table, query_block: pa.Table) -> pa.Table:
        found = []
        for a in stored_block.to_pylist():
            for b in query_block.to_pylist():
                found.append(search_block(
                    np.frombuffer(a["ids"], "<i8"), np.frombuffer(a["data"], "<f8").reshape(-1, dimension),
                    np.frombuffer(b["ids"], "<i8"), np.frombuffer(b["data"], "<f8").reshape(-1, dimension),
                    chosen, largest, neighbours, share, least))
        q, v, s = (np.concatenate(c) for c in zip(*found, strict=True)) if found else ([], [], [])
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()),
                         "score": pa.array(s, pa.float64())})

    hits = (left.groupBy("block", "query_block").cogroup(right.groupBy("block", "query_block"))
            .applyInArrow(search, "query_id long, vec_id long, score double"))
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
            .select("query_id", "rank", "vec_id", "score"))


def neighbours_of_sample(vectors: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """Neighbours of the rows whose id is divisible by ``every``, among all rows."""
    usable_rows = usable_vectors(vectors)
    return nearest(usable_rows, usable_rows.where(F.col("vec_id") % every == 0))
