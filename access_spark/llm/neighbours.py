"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is cut into parts of equal size with few edges between
them, and a small classifier learns which parts the neighbours of a vector lie in. It places
every row of the table in its likeliest part and routes each query to several, where all
rows are ranked exactly. How many parts a query visits is calibrated on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from access_spark.llm.vectors import matrix, stacked, usable
from access_spark.session import cut_lineage

#: Parts, rows of the sample they are learned from and of the one that calibrates routing.
PARTS, SAMPLE, PROBED, RANKED = 32, 4096, 256, 8192
#: Neighbours in the graph, and units of the classifier's hidden layer.
GRAPH, HIDDEN = 10, 64
#: Wanted share of true neighbours in the parts that a query visits.
RECALL = 0.96
#: Rows and queries that are compared in one task.
ROW_BLOCK, QUERY_BLOCK = 8192, 1024
_SEED = 42


def neighbour_graph(vectors: np.ndarray, k: int = GRAPH) -> np.ndarray:
    """The k rows of largest inner product with each row, itself left out."""
    out = np.empty((len(vectors), k), np.int64)
    for at in range(0, len(vectors), 512):
        scores = vectors[at : at + 512] @ vectors.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        out[at : at + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, vectors: np.ndarray, parts: int, rounds: int = 30, slack: float = 1.05) -> np.ndarray:
    """A part of each node such that none has more than its share times `slack` and many
    neighbours lie in one part.

    Starts from slices of a tree of median cuts along principal axes. In each round nodes
    that would gain move to the part of most of their neighbours, those that gain most first,
    as long as the part has room.
    """
    n = len(graph)
    part = np.zeros(n, np.int64)
    count = 1
    while count < parts:
        new = np.zeros(n, np.int64)
        for p in range(count):
            rows = np.flatnonzero(part == p)
            centred = vectors[rows] - vectors[rows].mean(axis=0)
            axis = np.linalg.svd(centred, full_matrices=False)[2][0] if len(rows) > 1 else np.zeros(vectors.shape[1])
            order = np.argsort(centred @ axis, kind="stable")
            new[rows[order]] = 2 * p + (np.arange(len(rows)) >= len(rows) / 2)
        part, count = new, 2 * count
    most = int(np.ceil(n / parts * slack))
    sources = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)])
    targets = np.concatenate([graph.reshape(-1), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        around = np.bincount(sources * parts + part[targets], minlength=n * parts).reshape(n, parts)
        best = around.argmax(axis=1)
        gain = around[np.arange(n), best] - around[np.arange(n), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < most:
                sizes[best[i]] += 1
                sizes[part[i]] -= 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer: vectors to probabilities of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int = 1

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(vectors: np.ndarray, shares: np.ndarray, epochs: int = 40, rate: float = 0.003) -> Router:
    """Fit by Adam on soft labels: the shares of a vector's neighbours in the parts."""
    rng = np.random.default_rng(_SEED)
    dim, parts = vectors.shape[1], shares.shape[1]
    p = [rng.standard_normal((dim, HIDDEN)) * (2 / dim) ** 0.5, np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) * (1 / HIDDEN) ** 0.5, np.zeros(parts)]
    first, second, step = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) * dim**0.5
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(unit)), max(1, len(unit) // 128)):
            x = unit[rows]
            h = np.maximum(x @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            q = np.exp(z - z.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            dz = (q - shares[rows]) / len(rows)
            dh = dz @ p[2].T * (h > 0)
            step += 1
            for i, g in enumerate((x.T @ dh + 1e-4 * p[0], dh.sum(axis=0), h.T @ dz + 1e-4 * p[2], dz.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                p[i] = p[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(p[0] * dim**0.5, p[1], p[2], p[3])


def learn(sample: np.ndarray, other: np.ndarray, top: int, parts: int = PARTS) -> Router:
    """Router of a sample; visits are calibrated on rows of `other`, used as queries and rows.

    Among fewer rows the nearest are farther away and more scattered than in the whole table,
    so the calibrated number rather errs on the high side.
    """
    while parts > 1 and len(sample) < 32 * parts:
        parts //= 2
    dim = sample.shape[1]
    if parts == 1:
        return Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(sample)
    part = balanced_parts(graph, sample, parts)
    shares = np.zeros((len(sample), parts))
    np.add.at(shares, (np.repeat(np.arange(len(sample)), graph.shape[1]), part[graph].reshape(-1)), 1.0)
    shares[np.arange(len(sample)), part] += 1.0
    router = train_router(sample, shares / shares.sum(axis=1, keepdims=True))
    queries = other[:PROBED]
    places = router.scores(other).argmax(axis=1)
    order = np.argsort(-router.scores(queries), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :], axis=1)
    scores = queries @ other.T
    scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    near = np.argpartition(-scores, min(top, len(other) - 1) - 1, axis=1)[:, : min(top, len(other) - 1)]
    needed = np.take_along_axis(rank, places[near], axis=1)
    found = [(needed < m).mean() for m in range(1, parts + 1)]
    router.visits = next(m for m, share in enumerate(found, 1) if share >= RECALL or m == parts)
    return router


def _place(held):
    """Rows in their likeliest part, queries in as many as the router visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = held.value
        for batch in batches:
            vectors = matrix(batch.column(2))
            if not len(vectors):
                continue
            order = np.argsort(-router.scores(vectors), axis=1, kind="stable")
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            rows = np.arange(len(vectors))
            who = np.concatenate([rows, np.repeat(rows[asks], router.visits)])
            part = np.concatenate([order[:, 0], order[asks][:, : router.visits].reshape(-1)])
            held_bytes = [v.tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(np.arange(len(who)) >= len(rows)), batch.column(0).take(pa.array(who)),
                 pa.array([held_bytes[i] for i in who], pa.binary())],
                ["part", "asks", "vec_id", "vector"],
            )

    return run


def _rank(top: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        ids, vectors = table["vec_id"].to_numpy(), stacked(table["vector"])
        order = np.argsort(ids[~asks], kind="stable")
        row_ids, rows = ids[~asks][order], vectors[~asks][order]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, int(asks.sum()) if len(rows) else 0, 128):
            query_ids, queries = ids[asks][at : at + 128], vectors[asks][at : at + 128]
            scores = queries @ rows.T
            for q, query, score in zip(query_ids, queries, scores):
                score[row_ids == q] = -np.inf
                near = np.flatnonzero(score > -np.inf)
                if len(near) > top:
                    # the product may differ in the last bits from row to row; equal vectors must tie
                    last = np.partition(score, len(score) - top)[len(score) - top]
                    near = np.flatnonzero(score >= last - 1e-9 * max(1.0, abs(last)))
                exact = (rows[near] * query).sum(axis=1)
                best = np.lexsort((row_ids[near], -exact))[:top]
                found.append((np.full(len(best), q), row_ids[near][best], exact[best]))
        parts = [np.concatenate(x) for x in zip(*found)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(parts[0], pa.int64()), "vec_id": pa.array(parts[1], pa.int64()), "score": pa.array(parts[2], pa.float64())})

    return run


def _sample(rows: DataFrame, salt: str, size: int) -> np.ndarray:
    drawn = rows.orderBy(F.xxhash64("vec_id", F.lit(salt)), "vec_id").limit(size).select("embedding").collect()
    return np.array([r.embedding for r in drawn], np.float64)


def search(rows: DataFrame, query: Column, top: int = 20) -> DataFrame:
    """The `top` rows of largest inner product found for each query: query_id, rank (from 1),
    vec_id and score, ties to the smaller vec_id.

    Queries are the rows for which `query` holds; candidates are all rows but those with the
    query's id. Vectors that are null, empty or zero, hold null or non-finite components or
    have another length than most take no part, nor do null ids. Repeated rows count once.
    With few candidates all are returned; no rows give none. Other columns are ignored.

    Parts are dealt into blocks of rows and of queries by hashes, so that neither a hot part
    nor a large group of copies lands in one task; each block returns `top` rows a query.
    """
    good = cut_lineage(usable(rows))
    sample = _sample(good, "fit", SAMPLE)
    if not len(sample):
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = learn(sample, _sample(good, "calibrate", RANKED), top)
    held = rows.sparkSession.sparkContext.broadcast(router)
    marked = good.select("vec_id", F.coalesce(query, F.lit(False)).alias("asks"), "embedding")
    placed = cut_lineage(marked.mapInArrow(_place(held), "part int, asks boolean, vec_id long, vector binary"))
    rows_in = F.count(F.when(~F.col("asks"), 1))
    queries_in = F.count(F.when(F.col("asks"), 1))
    # one row per part: at most PARTS
    sizes = placed.groupBy("part").agg(F.greatest(F.ceil(rows_in / ROW_BLOCK), F.lit(1)).alias("row_blocks"), F.greatest(F.ceil(queries_in / QUERY_BLOCK), F.lit(1)).alias("query_blocks"))
    sized = placed.join(F.broadcast(sizes), "part").withColumn("_h", F.xxhash64("vec_id"))
    own = F.when(F.col("asks"), F.pmod("_h", "query_blocks")).otherwise(F.pmod("_h", "row_blocks"))
    others = F.when(F.col("asks"), F.col("row_blocks")).otherwise(F.col("query_blocks"))
    units = sized.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), others - 1)))
    units = units.withColumns({"row_block": F.when(F.col("asks"), F.col("_other")).otherwise(F.col("_own")), "query_block": F.when(F.col("asks"), F.col("_own")).otherwise(F.col("_other"))})
    units = units.select("part", "row_block", "query_block", "asks", "vec_id", "vector")
    found = units.groupBy("part", "row_block", "query_block").applyInArrow(_rank(top), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
