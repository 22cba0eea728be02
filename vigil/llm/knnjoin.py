"""Exact top-k by inner product as a Voronoi join.

Pivots are a few query vectors.  Queries go to the cell of their nearest pivot, data vectors too; the
summary of a query cell is its radius U (largest distance to the pivot p), that of a data cell its
radius and size.  For any query q of a cell and any vector s, q.s lies within |s| U of p.s.  So the k+1
ids with the largest p.s - |s| U of a cell (each task's best, merged by Spark) give a score that every query
of the cell reaches with k ids besides its own, and s has to meet the cell only if p.s + |s| U reaches it.
Those copies of s, and the queries, meet in blocks of bounded size: (query cell, part of it, data
cell, part of it).  In a block a query skips the data cell if even its best possible score, q.p + |q| R,
stays below the bound.  Each block returns a query's best k, Spark ranks them.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do null
ids; shorter vectors count as padded with zeros; the id is a key, exact repeats of a row are dropped
first; equal scores go to the smaller id; fewer candidates than k give as many rows; scores beyond 64
bits are held at the limits of a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import sent, written

SLACK = 1e-9
NONE = np.iinfo(np.int64).min + 1  # so that its negative is a long, too


def usable(vector: Column) -> Column:
    """The vector as doubles; null if it is null or holds a null or non-finite component."""
    good = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(good, vector.cast("array<double>"))


def _matrix(col: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the rows of a list column, padded with zeros to ``dim``."""
    size = np.diff(col.offsets.to_numpy())
    out = np.zeros((len(col), dim))
    out[np.arange(dim) < size[:, None]] = np.floor(scale * col.flatten().to_numpy())
    return out


def _pack(v: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in v]


def _nearest(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, distance to its pivot)."""
    square = (v * v).sum(axis=1)[:, None] - 2 * (v @ pivots.T) + (pivots * pivots).sum(axis=1)
    cell = square.argmin(axis=1)
    return cell, np.sqrt(((v - pivots[cell]) ** 2).sum(axis=1))


def _spread(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A part number below ``parts`` for each id."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int32)


def _cells(pivots, dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots()
        for b in batches:
            if len(b):
                cell, far = _nearest(_matrix(b.column(1), dim, scale), p)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(cell.astype(np.int32)), pa.array(far)],
                                                 names=["id", "is_query", "cell", "far"])
    return run


def _highest(low: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` highest bounds of each row with their ids."""
    if low.shape[1] <= most:
        return low, ids
    at = np.argpartition(-low, most - 1, axis=1)[:, :most]
    return np.take_along_axis(low, at, axis=1), np.take_along_axis(ids, at, axis=1)


def _reached(pivots, radius, dim: int, scale: int, k: int):
    """A task's k+1 ids with the best lower bounds for each query cell; an id counts once, with its best row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, u = pivots(), radius()
        best, who = np.full((len(p), 0), -np.inf), np.zeros((len(p), 0), np.int64)
        for b in batches:
            if not len(b):
                continue
            v = _matrix(b.column(1), dim, scale)
            low = p @ v.T - np.outer(u, np.sqrt((v * v).sum(axis=1)))
            ids = b.column(0).to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, first = np.unique(ids[order], return_index=True)
            low = np.maximum.reduceat(low[:, order], first, axis=1)
            low, ids = _highest(low, np.broadcast_to(ids, low.shape), k + 1)
            best, who = np.concatenate([best, low], axis=1), np.concatenate([who, ids], axis=1)
            order = np.lexsort((-best, who), axis=1)
            best, who = np.take_along_axis(best, order, axis=1), np.take_along_axis(who, order, axis=1)
            best[:, 1:][who[:, 1:] == who[:, :-1]] = -np.inf
            best, who = _highest(best, who, k + 1)
        cell = np.repeat(np.arange(len(p), dtype=np.int32), best.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(who.reshape(-1)), pa.array(best.reshape(-1))], names=["cell", "id", "low"])
    return run


BLOCK = "q int, qp int, s int, sp int, id bigint, v binary"


def _data_blocks(plan, dim: int, scale: int):
    """Each data vector once per block that it has to meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, u, bound, q_parts, s_parts = plan()
        for b in batches:
            for lo in range(0, len(b), 2048):
                part = b.slice(lo, 2048)
                v, ids = _matrix(part.column(1), dim, scale), part.column(0).to_numpy()
                cell, _ = _nearest(v, p)
                norm = np.sqrt((v * v).sum(axis=1))
                most = p @ v.T + np.outer(u, norm)
                q, row = np.nonzero(most + SLACK * (1 + np.abs(most)) >= bound[:, None])
                n = q_parts[q]
                row, q, qp = np.repeat(row, n), np.repeat(q, n), np.concatenate([np.arange(x) for x in n] or [np.zeros(0, int)])
                sp = _spread(ids, s_parts[cell])
                packed = _pack(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.astype(np.int32)), pa.array(qp.astype(np.int32)), pa.array(cell[row].astype(np.int32)), pa.array(sp[row]),
                     pa.array(ids[row]), pa.array([packed[r] for r in row], pa.binary())], names=["q", "qp", "s", "sp", "id", "v"])
    return run


def _query_blocks(plan, dim: int, scale: int):
    """Each query once per data block of its cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, _, _, q_parts, s_parts = plan()
        s = np.repeat(np.arange(len(p)), s_parts)
        sp = np.concatenate([np.arange(x) for x in s_parts])
        for b in batches:
            for lo in range(0, len(b), 2048):
                part = b.slice(lo, 2048)
                v, ids = _matrix(part.column(1), dim, scale), part.column(0).to_numpy()
                cell, _ = _nearest(v, p)
                qp = _spread(ids, q_parts[cell])
                row = np.repeat(np.arange(len(ids)), len(s))
                packed = _pack(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[row].astype(np.int32)), pa.array(qp[row]), pa.array(np.tile(s, len(ids)).astype(np.int32)),
                     pa.array(np.tile(sp, len(ids)).astype(np.int32)), pa.array(ids[row]), pa.array([packed[r] for r in row], pa.binary())],
                    names=["q", "qp", "s", "sp", "id", "v"])
    return run


def _rows(t: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (id, vector) rows by id."""
    ids = t.column("id").to_numpy()
    v = np.frombuffer(b"".join(x.as_py() for x in t.column("v")), np.float64).reshape(len(ids), dim)
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] != ids[:-1]) | (v[1:] != v[:-1]).any(axis=1)
    return ids[keep], v[keep]


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row, the columns of its k highest scores, ties to the earlier column; never ``own``."""
    width = scores.shape[1]
    if scores.dtype == np.int64 and (not scores.size or np.abs(scores).max() < 1 << 40):
        key = (scores << 20) + (width - 1 - np.arange(width))
        key[own] = NONE
        if width > k:
            at = np.argpartition(-key, k - 1, axis=1)[:, :k]
        else:
            at = np.tile(np.arange(width), (len(key), 1))
        return [a[x[a] != NONE] for a, x in zip(at, key)]
    return [np.array([c for c in sorted(range(width), key=lambda c: (-r[c], c)) if not o[c]][:k], int) for r, o in zip(scores, own)]


def _solve(plan, far, dim: int, k: int):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        p, _, bound, _, _ = plan()
        out: list[list] = [[], [], []]
        if queries.num_rows and data.num_rows:
            q, s = int(data.column("q")[0].as_py()), int(data.column("s")[0].as_py())
            q_ids, qs = _rows(queries, dim)
            s_ids, ss = _rows(data, dim)
            most = qs @ p[s] + np.sqrt((qs * qs).sum(axis=1)) * far()[s]
            go = most + SLACK * (1 + np.abs(most)) >= bound[q]
            q_ids, qs = q_ids[go], qs[go]
            exact = dim * np.abs(qs).max(initial=0) * np.abs(ss).max(initial=0) < 2 ** 53
            for lo in range(0, len(q_ids), 128):
                ids = q_ids[lo:lo + 128]
                if exact:
                    scores = np.rint(qs[lo:lo + 128] @ ss.T).astype(np.int64)
                else:  # integers of any size
                    whole = np.frompyfunc(int, 1, 1)
                    scores = whole(qs[lo:lo + 128]) @ whole(ss).T
                for i, at in enumerate(_best(scores, ids[:, None] == s_ids, k)):
                    out[0] += [ids[i]] * len(at)
                    out[1] += s_ids[at].tolist()
                    out[2] += [max(min(int(x), 2 ** 63 - 1), -2 ** 63) for x in scores[i][at]]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), out)})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64,
          cell_queries: int = 512, most_cells: int = 256, block_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with ``is_query`` the k other rows with the highest
    inner product of the quantised vectors."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), usable(F.col(vector_col)).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query")).where("id is not null and v is not null")
    rows = written(rows.groupBy("id", "v").agg(F.max("is_query").alias("is_query")), "vectors")
    queries = rows.where("is_query")
    size = rows.agg(F.count_if("is_query").alias("q"), F.max(F.size("v")).alias("dim")).first()
    if not size["q"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = max(1, size["dim"])
    some = queries.orderBy(F.xxhash64("id", "v"), "id").limit(min(most_cells, max(1, size["q"] // cell_queries))).collect()
    p = np.zeros((len(some), dim))
    for i, r in enumerate(some):
        p[i, :len(r["v"])] = np.floor(scale * np.array(r["v"]))
    pivots = sent(spark, p)
    found = rows.mapInArrow(_cells(pivots, dim, scale), "id bigint, is_query boolean, cell int, far double")
    summary = found.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.count_if("is_query").alias("nq"),
                                        F.max(F.when(F.col("is_query"), F.col("far"))).alias("u")).collect()
    u, far, q_parts, s_parts = np.zeros(len(p)), np.zeros(len(p)), np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    for r in summary:
        u[r["cell"]], far[r["cell"]] = r["u"] or 0, r["far"]
        q_parts[r["cell"]], s_parts[r["cell"]] = -(-r["nq"] // (2 * cell_queries)), -(-r["n"] // block_rows)
    lows = rows.mapInArrow(_reached(pivots, sent(spark, u), dim, scale, k), "cell int, id bigint, low double")
    lows = lows.groupBy("cell", "id").agg(F.max("low").alias("low"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("low")))
    bound = np.full(len(p), -np.inf)
    for r in lows.withColumn("r", rank).where(F.col("r") <= k + 1).where(F.col("r") == k + 1).collect():
        bound[r["cell"]] = r["low"] - SLACK * (1 + abs(r["low"]))
    plan = sent(spark, (p, u, bound, q_parts, s_parts))
    key = ["q", "qp", "s", "sp"]
    met = (queries.mapInArrow(_query_blocks(plan, dim, scale), BLOCK).groupBy(*key)
           .cogroup(rows.mapInArrow(_data_blocks(plan, dim, scale), BLOCK).groupBy(*key))
           .applyInArrow(_solve(plan, sent(spark, far), dim, k), "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
