"""Near-duplicate embeddings by counting collisions on sorted projections.

Vectors are projected on many random directions. On each direction those that reach furthest
are sorted, and a window centred on each of them (as a query) holds its collisions: two
vectors collide on a direction that is among the furthest of both. Pairs that collide often
enough are verified by cosine; how often is calibrated for the wanted recall at the
threshold. A pair is dealt with on the first direction on which it collides, where all its
collisions are counted from the directions that each vector carries, so no pair is ever
shuffled and each counts once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_spark.llm.common import connected_components
from access_spark.llm.vectors import matrix, stacked, takes_part, usable
from access_spark.session import cut_lineage

#: Rows of a list that are compared in one task; longer lists are dealt into blocks.
BLOCK = 1024
#: Half width of the windows. A pair of cosine 0.9 differs by 0.45 (one deviation) on a direction.
HALF_WINDOW = 1.6
#: Wanted share of the pairs at the threshold itself; closer pairs are found more often.
RECALL = 0.99
_SEED = 20190611


def projections_for(rows: int) -> int:
    """Directions: a power of two about eight times the square root of the rows, so that both
    projecting and comparing within lists grow as rows ** 1.5."""
    return 1 << max(8, math.ceil(math.log2(8 * math.sqrt(max(1, rows)))))


def calibrate(projections: int, threshold: float, recall: float = RECALL, trials: int = 600) -> tuple[int, int]:
    """(directions a vector is listed on, collisions that make a candidate).

    Values of a pair of this cosine on random directions are normal with that correlation.
    Of the counts that keep the wanted recall the largest is taken; if not even one collision
    does, vectors are listed on more directions.
    """
    rng = np.random.default_rng(_SEED)
    hits: dict[int, np.ndarray] = {}
    listed = 8
    draws = [(a, threshold * a + math.sqrt(1 - threshold**2) * rng.standard_normal(projections)) for a in (rng.standard_normal(projections) for _ in range(trials))]
    while True:
        listed = min(listed, projections)
        counts = []
        for a, b in draws:
            one, two = (np.argpartition(-x, listed - 1)[:listed] for x in (a, b))
            both = np.intersect1d(one, two)
            near = len(both) and abs(a[both[0]] - b[both[0]]) <= HALF_WINDOW
            counts.append(len(both) if near else 0)
        hits[listed] = np.array(counts)
        wanted = [c for c in range(1, listed + 1) if (hits[listed] >= c).mean() >= recall]
        if wanted or listed == projections:
            return listed, max(wanted, default=1)
        listed += 4


def _list_rows(projections: int, listed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = None
        for batch in batches:
            vectors = matrix(batch.column(2))
            if not len(vectors):
                continue
            if directions is None:
                directions = np.random.default_rng(_SEED + vectors.shape[1]).standard_normal((vectors.shape[1], projections))
            for at in range(0, len(vectors), 1024):
                part = vectors[at : at + 1024]
                unit = part / np.linalg.norm(part, axis=1, keepdims=True)
                values = unit @ directions
                top = np.sort(np.argpartition(-values, listed - 1, axis=1)[:, :listed], axis=1).astype(np.int32)
                n = len(part)
                source = np.repeat(np.arange(n), listed)
                held = [x.tobytes() for x in unit], [x.tobytes() for x in top]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(top.reshape(-1)), pa.array(np.take_along_axis(values, top.astype(np.int64), 1).reshape(-1)),
                     batch.column(0).slice(at, n).take(pa.array(source)), batch.column(1).slice(at, n).take(pa.array(source)),
                     *[pa.array([h[i] for i in source], pa.binary()) for h in held]],
                    ["list", "value", "vec_id", "copies", "unit", "top"],
                )

    return run


def _compare(threshold: float, least: int):
    """Links of the vectors of one list, or of two of its blocks."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own, low, high = (k.as_py() for k in key)
        table = table.take(np.argsort(table["value"].to_numpy(), kind="stable"))
        ids, copies = table["vec_id"].to_numpy(), table["copies"].to_numpy()
        value, block = table["value"].to_numpy(), table["block"].to_numpy()
        n = len(ids)
        top = np.frombuffer(b"".join(table["top"].to_pylist()), np.int32).reshape(n, -1)
        # windows along the sorted list, each centred on its query
        until = np.searchsorted(value, value + HALF_WINDOW, side="right")
        near = (np.arange(n)[None, :] < until[:, None]) & (np.arange(n)[None, :] > np.arange(n)[:, None])
        if low != high:
            near &= block[:, None] != block[None, :]
        names, place, times = np.unique(top, return_inverse=True, return_counts=True)
        place = place.reshape(top.shape)
        shared = times > 1
        column = np.cumsum(shared) - 1
        marks = np.zeros((n, int(shared.sum())), np.float32)
        row, slot = np.nonzero(shared[place])
        marks[row, column[place[row, slot]]] = 1
        before = marks[:, names[shared] < own]
        counted = near & (marks @ marks.T >= least) & (before @ before.T == 0)
        a, b = np.nonzero(counted)
        unit = stacked(table["unit"])
        linked = np.zeros(len(a), bool)
        for k in range(0, len(a), 1 << 16):
            part = slice(k, k + (1 << 16))
            linked[part] = np.einsum("ij,ij->i", unit[a[part]], unit[b[part]]) >= threshold
        a, b = a[linked], b[linked]
        links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        root = np.arange(n)
        while len(a):
            least_root = np.minimum(root[a], root[b])
            if (root[a] == least_root).all() and (root[b] == least_root).all():
                break
            np.minimum.at(root, a, least_root)
            np.minimum.at(root, b, least_root)
            root = root[root]
        some = np.flatnonzero(links)
        return pa.table({"vec_id": ids[some], "links": links[some].astype(np.int64), "root": ids[root[some]]})

    return run


def near_duplicates(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per row of `rows` (vec_id, embedding): vec_id, n_links, component_id and kept.

    Two vectors link when their cosine in double precision is `threshold` or more and they
    collide often enough to be verified; no pair below the threshold links. n_links counts
    the other vectors, component_id is the smallest vec_id reachable, kept marks it. Vectors
    that are null, empty or zero, hold null or non-finite components, or have another length
    than most, link with nothing: 0 links, their own component, kept. Equal vectors are one
    node that counts as many; repeated rows of one id count once and are all returned. A null
    vec_id gets 0 links, a null component and is kept. Other columns are ignored.

    A group of near copies of any size costs its pairs, in blocks spread over the cluster;
    tasks return one row per vector and list, never pairs.
    """
    good = usable(rows)
    nodes = cut_lineage(good.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")))
    projections = projections_for(nodes.count())
    listed, least = calibrate(projections, threshold)
    kinds = "list int, value double, vec_id long, copies long, unit binary, top binary"
    lists = nodes.select("vec_id", "copies", "embedding").mapInArrow(_list_rows(projections, listed), kinds)
    sizes = lists.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocks = lists.join(cut_lineage(sizes), "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = blocks.select("*", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    found = cut_lineage(units.groupBy("list", "low", "high").applyInArrow(_compare(threshold, least), "vec_id long, links long, root long"))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    facts = nodes.join(counts, "vec_id", "left").join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    facts = facts.select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    own = F.when(takes_part(F.col("embedding")), F.col("embedding").cast("array<double>")).alias("embedding")
    out = rows.select(F.col("vec_id").cast("bigint"), own)
    out = out.withColumn("embedding", F.when(F.col("vec_id").isNotNull(), F.col("embedding"))).join(facts, "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
