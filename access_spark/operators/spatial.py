"""Spatial operators as equi-joins: containment, boundary distance and nearest items.

Boundaries are two tables: `polygons` (level, adm0_pcode, pcode, name, poly_seq, ...) and
`edges` (level, adm0_pcode, pcode, sx, sy, ex, ey: start and end), one row per side of a
ring. Several levels are handled in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from access_spark.functions.geo import haversine_km, lattice_index
from access_spark.functions.numeric import finite
from access_spark.operators.keyed import top_per_group
from access_spark.session import cut_lineage

CELL_DEGREES = 0.25
POLYGON = ("adm0_pcode", "level", "pcode")
Distance = Callable[..., np.ndarray]  # of x, y and the coordinates of items
Reduce = Callable[[np.ndarray, np.ndarray, pa.Table, np.ndarray], dict]  # of x, y, items and the places of the nearest


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("bigint")


# ---- containment ------------------------------------------------------------------


def _edge_bands(edges: DataFrame, size: float) -> DataFrame:
    low, high = F.least("sy", "ey"), F.greatest("sy", "ey")
    return edges.select(
        *POLYGON, "sx", "sy", "ex", "ey",
        F.explode(F.sequence(_cell(low, size), _cell(high, size))).alias("cy"),
    )


def _crossing_test(candidates: DataFrame, edges: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    """Even-odd rule for (point, polygon) candidates: adds `inside` and `on_edge`.

    A candidate meets only the sides whose latitude range touches its band, and the
    partial sums collapse before the shuffle.
    """
    x, y = F.col("x"), F.col("y")
    ax, ay, bx, by = (F.col(c) for c in ("sx", "sy", "ex", "ey"))
    spans = (ay > y) != (by > y)
    reach = ax + (y - ay) * (bx - ax) / F.nullif(by - ay, F.lit(0.0))
    side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    touches = (
        (side == 0)
        & x.between(F.least(ax, bx), F.greatest(ax, bx))
        & y.between(F.least(ay, by), F.greatest(ay, by))
    )
    joined = candidates.withColumn("cy", _cell(y, size)).join(
        _edge_bands(edges, size), [*POLYGON, "cy"]
    )
    return joined.groupBy(*keys, "level", "pcode").agg(
        (F.sum((F.coalesce(spans & (x < reach), F.lit(False))).cast("int")) % 2 == 1).alias("_odd"),
        F.max(touches.cast("int")).alias("_touch"),
    ).select(
        *keys, "level", "pcode",
        (F.col("_odd") & (F.col("_touch") == 0)).alias("inside"),
        (F.col("_touch") == 1).alias("on_edge"),
    )


def cover_cells(edges: DataFrame, size: float = CELL_DEGREES) -> DataFrame:
    """Lattice cells a polygon touches: `whole` cells lie inside it entirely, the others
    hold part of its edge. Size depends on the boundaries alone, not on the points."""
    cells = edges.groupBy(*POLYGON).agg(
        F.sequence(_cell(F.min(F.least("sx", "ex")), size), _cell(F.max(F.greatest("sx", "ex")), size)).alias("xs"),
        F.sequence(_cell(F.min(F.least("sy", "ey")), size), _cell(F.max(F.greatest("sy", "ey")), size)).alias("ys"),
    )
    cells = cells.select(*POLYGON, F.explode("xs").alias("cx"), "ys").select(
        *POLYGON, "cx", F.explode("ys").alias("cy")
    )
    edge_cells = (
        _edge_bands(edges, size)
        .select(
            *POLYGON, "cy",
            F.explode(
                F.sequence(_cell(F.least("sx", "ex"), size), _cell(F.greatest("sx", "ex"), size))
            ).alias("cx"),
        )
        .distinct()
    )
    key = [*POLYGON, "cx", "cy"]
    free = cells.join(edge_cells, key, "left_anti").withColumns(
        {"x": (F.col("cx") + 0.5) * size, "y": (F.col("cy") + 0.5) * size}
    )
    whole = _crossing_test(free, edges, ["adm0_pcode", "cx", "x", "y"], size).filter("inside")
    whole = whole.select(*POLYGON, "cx", _cell(F.col("y"), size).alias("cy"), F.lit(True).alias("whole"))
    return whole.unionByName(edge_cells.select(*key, F.lit(False).alias("whole")))


def polygons_of_points(points: DataFrame, edges: DataFrame, keys: Sequence[str], size: float = CELL_DEGREES) -> DataFrame:
    """All (point, polygon) pairs where the polygon covers the point.

    `points` has the keys, adm0_pcode, x and y; the result has the keys, level, pcode,
    `inside` (strictly) and `on_edge`. Points in whole cells never meet an edge.
    """
    cells = cover_cells(edges, size)
    placed = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumns(
        {"cx": _cell(F.col("x"), size), "cy": _cell(F.col("y"), size)}
    )
    pairs = placed.join(cells, ["adm0_pcode", "cx", "cy"])
    sure = pairs.filter("whole").select(
        *keys, "level", "pcode", F.lit(True).alias("inside"), F.lit(False).alias("on_edge")
    )
    tested = _crossing_test(pairs.filter("NOT whole").drop("cx", "cy", "whole"), edges, keys, size)
    return sure.unionByName(tested.filter("inside OR on_edge"))


def locate(
    points: DataFrame,
    polygons: DataFrame,
    edges: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = ("pcode", "name"),
    size: float = CELL_DEGREES,
) -> DataFrame:
    """First polygon (lowest poly_seq) strictly containing each point; one row per match."""
    inside = polygons_of_points(points, edges, keys, size).filter("inside")
    # codes are unique within a country only
    on = [*(["adm0_pcode"] if "adm0_pcode" in keys else []), "level", "pcode"]
    names = polygons.select(*on, "poly_seq", *[c for c in columns if c not in on])
    named = inside.select(*keys, "level", "pcode").join(names, on)
    first = F.min(F.struct("poly_seq", *columns)).alias("m")
    return named.groupBy(*keys).agg(first).select(*keys, *[F.col(f"m.{c}").alias(c) for c in columns])


def covered_by_country(points: DataFrame, edges: DataFrame, keys: Sequence[str], size: float = CELL_DEGREES) -> DataFrame:
    """Keys of points covered by any part of their country, edges included."""
    return polygons_of_points(points, edges, keys, size).select(*keys).distinct()


# ---- boundary distance ---------------------------------------------------------------


def _foot(x: Column, y: Column) -> tuple[Column, Column]:
    ax, ay, bx, by = (F.col(c) for c in ("sx", "sy", "ex", "ey"))
    dx, dy = bx - ax, by - ay
    along = ((x - ax) * dx + (y - ay) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.coalesce(F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    return ax + t * dx, ay + t * dy


def _planar2(x: Column, y: Column, fx: Column, fy: Column) -> Column:
    return (x - fx) * (x - fx) + (y - fy) * (y - fy)


def distance_to_boundary(
    points: DataFrame, edges: DataFrame, keys: Sequence[str], on: Sequence[str], size: float = CELL_DEGREES
) -> DataFrame:
    """Kilometres from each point to the edge of the polygon it names.

    The nearest edge point is found in degrees, its distance is great-circle. `on` lists
    the columns that name the polygon on both sides. The sides of a polygon are grouped by
    lattice cells; a point meets the boxes of the cells, and then only the sides of those
    boxes that may be nearer than the farthest corner of the nearest box.
    """
    x, y = F.col("x"), F.col("y")
    key, cell = list(keys), [*on, "_ecx", "_ecy"]
    placed = edges.withColumns({"_ecx": _cell((F.col("sx") + F.col("ex")) / 2.0, size), "_ecy": _cell((F.col("sy") + F.col("ey")) / 2.0, size)})
    boxes = placed.groupBy(*cell).agg(
        F.min(F.least("sx", "ex")).alias("_x1"), F.max(F.greatest("sx", "ex")).alias("_x2"),
        F.min(F.least("sy", "ey")).alias("_y1"), F.max(F.greatest("sy", "ey")).alias("_y2"),
    )
    gx = F.greatest(F.lit(0.0), F.col("_x1") - x, x - F.col("_x2"))
    gy = F.greatest(F.lit(0.0), F.col("_y1") - y, y - F.col("_y2"))
    fx = F.greatest(F.abs(F.col("_x1") - x), F.abs(F.col("_x2") - x))
    fy = F.greatest(F.abs(F.col("_y1") - y), F.abs(F.col("_y2") - y))
    bounds = points.select(*dict.fromkeys([*key, *on]), "x", "y").join(boxes, list(on)).withColumns(
        {"_near": gx * gx + gy * gy, "_far": fx * fx + fy * fy}
    ).drop("_x1", "_x2", "_y1", "_y2")
    least = bounds.groupBy(*key).agg(F.min("_far").alias("_least"))
    near = bounds.join(least, key).filter(F.col("_near") <= F.col("_least") * (1 + 1e-9) + 1e-18).drop("_near", "_far", "_least")
    joined = near.join(placed.select(*cell, "sx", "sy", "ex", "ey"), cell)
    ex, ey = _foot(x, y)
    best = F.min(F.struct(_planar2(x, y, ex, ey).alias("d2"), haversine_km(y, x, ey, ex).alias("km")))
    return joined.groupBy(*key).agg(best.alias("b")).select(*key, F.col("b.km").alias("km"))


# ---- nearest items -----------------------------------------------------------------------

FAN_BITS = 6  # 64 neighbouring items are a leaf, 64 leaves a node of the next level, and so on
BLOCK_BITS = (10, 5, 0)  # 1,024 neighbouring queries are a block; one that meets too much is cut
WIDE = 200_000  # items that a block of queries may meet
TOGETHER, MATRIX = 64, 1 << 20  # queries compared at once, and distances held at once


def _extent(df: DataFrame, xs: Sequence[str], ys: Sequence[str], *more: Column):
    return df.agg(
        *[pick(F.col(c)) for names in (xs, ys) for pick, c in ((F.min, names[0]), (F.max, names[-1]))], *more
    ).first()


def _on_curve(rows: DataFrame, lead: Sequence[str], x: str, y: str, tie: str, start: tuple[float, float], span: float) -> DataFrame:
    """Rows numbered (`_at`) along a Z curve inside each value of `lead`, written once: rows of
    neighbouring numbers lie close to each other, however crowded a spot is."""
    bits = 24
    codes = {
        name: F.least(F.floor((F.col(c) - low) / span * (1 << bits)).cast("bigint"), F.lit((1 << bits) - 1))
        for name, c, low in (("_cx", x, start[0]), ("_cy", y, start[1]))
    }
    curve = sum(
        F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1).cast("bigint")), 2 * i + odd)
        for i in range(bits) for odd, c in enumerate(("_cy", "_cx"))
    )
    order = [*lead, "_z", tie]
    placed = rows.withColumns(codes).withColumn("_z", curve).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(placed.withColumn("_at", F.monotonically_increasing_id()).drop("_cx", "_cy", "_z"))


def _near_boxes(pairs: DataFrame, k: int, key: Sequence[str], owner: str | None) -> DataFrame:
    """Pairs of a block of queries and a box of items without the boxes that cannot matter.

    Whether one place is nearer than another is linear in the query, so what holds at the
    four corners of a block holds inside. A box goes if at every corner it is farther than
    the farthest point of boxes that hold k items (or items of k owners): those that are
    nearest to the middle of the block.
    """

    def gap(axis: str, at: Column) -> Column:
        return F.greatest(F.lit(0.0), F.col(f"{axis}1") - at, at - F.col(f"{axis}2"))

    def reach(axis: str, at: Column) -> Column:
        return F.greatest(F.abs(F.col(f"{axis}1") - at), F.abs(F.col(f"{axis}2") - at))

    corners = [(F.col(cx), F.col(cy)) for cx in ("qx1", "qx2") for cy in ("qy1", "qy2")]
    square = lambda a, b: a * a + b * b
    middle = [(F.col(f"q{a}1") + F.col(f"q{a}2")) / 2.0 for a in "xy"]
    measured = pairs.withColumn("_mid", square(reach("x", middle[0]), reach("y", middle[1])))
    counted = F.col("n")
    if owner:
        once = F.row_number().over(Window.partitionBy(*key, owner).orderBy("_mid", "node"))
        measured, counted = measured.withColumn("_own", once), F.when(F.col("_own") == 1, 1).otherwise(0)
    by = Window.partitionBy(*key)
    before = F.sum(counted).over(by.orderBy("_mid", "node", *([owner] if owner else [])).rowsBetween(Window.unboundedPreceding, -1))
    measured = measured.withColumn("_sure", (F.coalesce(before, F.lit(0)) < k) & (counted > 0))
    farthest = [F.max(F.when(F.col("_sure"), square(reach("x", cx), reach("y", cy)))).over(by) for cx, cy in corners]
    measured = measured.withColumns({f"_r{i}": far for i, far in enumerate(farthest)})
    close = [square(gap("x", cx), gap("y", cy)) <= F.col(f"_r{i}") * (1 + 1e-9) for i, (cx, cy) in enumerate(corners)]
    kept = measured.filter(close[0] | close[1] | close[2] | close[3])
    return kept.drop("_mid", "_own", "_sure", *[f"_r{i}" for i in range(4)])


def _possible(x: np.ndarray, y: np.ndarray, boxes: list[np.ndarray], k: int, owners: np.ndarray | None) -> np.ndarray:
    """`_near_boxes` for some queries and single items: places of those that can be among the k nearest."""
    x1, y1, x2, y2 = boxes
    if len(x1) <= 2 * k:
        return np.arange(len(x1))
    left, right, low, high = x.min(), x.max(), y.min(), y.max()

    def far(cx: float, cy: float, of: np.ndarray | slice) -> np.ndarray:
        fx = np.maximum(np.abs(x1[of] - cx), np.abs(x2[of] - cx))
        fy = np.maximum(np.abs(y1[of] - cy), np.abs(y2[of] - cy))
        return fx * fx + fy * fy

    middle = far((left + right) / 2, (low + high) / 2, slice(None))
    least = middle
    if owners is not None:
        least = np.full(owners.max() + 1, np.inf)
        np.minimum.at(least, owners, middle)
    sure = np.flatnonzero(middle <= np.partition(least, min(k, len(least)) - 1)[min(k, len(least)) - 1])
    keep = np.zeros(len(x1), bool)
    for cx in (left, right):
        gx = np.maximum(0.0, np.maximum(x1 - cx, cx - x2))
        for cy in (low, high):
            gy = np.maximum(0.0, np.maximum(y1 - cy, cy - y2))
            keep |= gx * gx + gy * gy <= far(cx, cy, sure).max() * (1 + 1e-9)
    return np.flatnonzero(keep)


def _best(d2: np.ndarray, k: int, owners: np.ndarray | None) -> np.ndarray:
    """Places of the k smallest of each row, the earlier one of equal ones; of an owner once."""
    if owners is not None:
        rows = []
        for ordered in np.argsort(d2, axis=1, kind="stable"):
            rows.append(ordered[np.sort(np.unique(owners[ordered], return_index=True)[1])[:k]])
        return np.stack(rows)
    if k == 1:
        return d2.argmin(axis=1)[:, None]
    if d2.shape[1] > 2 * k:
        border = np.partition(d2, k - 1, axis=1)[:, k - 1 : k]
        columns = np.flatnonzero((d2 <= border).any(axis=0))
        return columns[np.argsort(d2[:, columns], axis=1, kind="stable")[:, :k]]
    return np.argsort(d2, axis=1, kind="stable")[:, :k]


def _block_search(k: int, lead: list[str], columns: list[str], order: str, shape: Sequence[str], distance2: Distance, owner: str | None, reduce: Reduce | None):
    """The k nearest of every query of a block, among the items that the block meets."""

    def run(queries: pa.Table, items: pa.Table) -> pa.Table:
        queries = queries.sort_by("_at")
        items = items.take(pc.sort_indices(items, sort_keys=[(order, "ascending")], null_placement="at_start"))
        x, y = (queries[c].to_numpy() for c in ("x", "y"))
        ends = [items[c].to_numpy() for c in shape]
        boxes = [np.minimum(ends[0], ends[2]), np.minimum(ends[1], ends[3]), np.maximum(ends[0], ends[2]), np.maximum(ends[1], ends[3])]
        owners = items[owner].combine_chunks().dictionary_encode().indices.to_numpy() if owner else None
        found, distances = [np.zeros((0, 0), np.int64)], [np.zeros((0, 0))]
        todo = [(a, min(a + TOGETHER, len(x))) for a in reversed(range(0, len(x), TOGETHER))] if len(items) else []
        while todo:
            a, b = todo.pop()
            some = _possible(x[a:b], y[a:b], boxes, k, owners)
            if b - a > 1 and (b - a) * len(some) > MATRIX:
                todo += [((a + b) // 2, b), (a, (a + b) // 2)]
                continue
            d2 = distance2(x[a:b, None], y[a:b, None], *[e[some] for e in ends])
            best = _best(d2, k, None if owners is None else owners[some])
            found.append(some[best])
            distances.append(np.take_along_axis(d2, best, axis=1))
        place, d2 = (np.concatenate(p[min(1, len(p) - 1):]) for p in (found, distances))
        if reduce:
            own = {c: queries[c].slice(0, len(place)) for c in lead}
            return pa.table(own | reduce(x[: len(place)], y[: len(place)], items, place))
        row = np.repeat(np.arange(len(place)), place.shape[1])
        out = {c: queries[c].take(pa.array(row)) for c in lead} | {c: items[c].take(pa.array(place.reshape(-1))) for c in columns}
        rank = np.tile(np.arange(1, place.shape[1] + 1, dtype=np.int32), len(place))
        return pa.table(out | {"d2": pa.array(d2.reshape(-1), pa.float64()), "rank": pa.array(rank, pa.int32())})

    return run


def nearest_items(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    group: str,
    query_key: str,
    item_columns: Sequence[str],
    order: str,
    shape: Sequence[str],
    distance2: Distance,
    owner: str | None = None,
    reduce: Reduce | None = None,
    reduced: Sequence[StructField] = (),
) -> DataFrame:
    """Exact k nearest items per query point: blocks of queries descend a tree of boxes of items.

    `queries` has (group, query_key, x, y). `items` has the group, `order` (tie rank), the
    item columns and the coordinates `shape` names: both ends of a side, or a point twice;
    `distance2` gives squared distances from arrays of both. With `owner`, items of one
    owner count once.

    Both sides are numbered along a curve; neighbouring numbers are a block of queries, a leaf
    of items, a node of leaves and so on, so a crowded spot only means more blocks there.
    Level by level a block drops the boxes that cannot matter to any of its queries, and meets
    the items of the leaves that are left in one task; blocks that would meet too many are cut
    into smaller ones, down to single queries. Blocks and boxes travel, never pairs of a query
    and an item. Points that are null, NaN or infinite are on neither side. The result is
    (group, query_key, item columns, d2, rank), or one row per query with the fields that
    `reduce` makes of its nearest items.
    """
    ends = list(dict.fromkeys(shape))
    columns = list(dict.fromkeys([*item_columns, order]))
    items = items.withColumns(
        {f"{a}{i + 1}": pick(F.col(one), F.col(other)) for a, one, other in (("x", shape[0], shape[2]), ("y", shape[1], shape[3])) for i, pick in enumerate((F.least, F.greatest))}
    )
    whole = [finite(F.col(c)).isNotNull() for c in ("x", "y", "x1", "y1", "x2", "y2")]
    queries = queries.filter(whole[0] & whole[1]).filter(F.col(group).isNotNull()).select(group, query_key, "x", "y")
    items = items.filter(whole[2] & whole[3] & whole[4] & whole[5]).filter(F.col(group).isNotNull())
    types = {f.name: f for f in [*items.schema, *queries.schema]}
    lead = [group, query_key]
    fields = list(reduced) if reduce else [*[types[c] for c in columns], StructField("d2", DoubleType()), StructField("rank", IntegerType())]
    schema = StructType([*[types[c] for c in lead], *fields])
    sizes = items.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(c) for f, c in ((F.min, "x1"), (F.max, "x2"), (F.min, "y1"), (F.max, "y2"))])
    q_ext, i_ext = _extent(queries, ["x"], ["y"]), _extent(sizes, ["x1", "x2"], ["y1", "y2"], F.max("n"))
    if q_ext[0] is None or i_ext[0] is None:
        return queries.sparkSession.createDataFrame([], schema)
    start = (float(min(q_ext[0], i_ext[0])), float(min(q_ext[2], i_ext[2])))
    span = max(max(q_ext[1], i_ext[1]) - start[0], max(q_ext[3], i_ext[3]) - start[1]) * (1 + 1e-9) or 1.0
    top = 0
    while i_ext[4] >> (FAN_BITS * (top + 1)) > 1 << FAN_BITS:
        top += 1

    centred = items.withColumns({f"_m{a}": (F.col(f"{a}1") + F.col(f"{a}2")) / 2.0 for a in "xy"})
    own = [owner] if owner else []
    it = _on_curve(centred, [group, *own], "_mx", "_my", order, start, span).drop("_mx", "_my")
    q = _on_curve(queries, [group], "x", "y", query_key, start, span)
    box = [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]

    def nodes(level: int) -> DataFrame:
        node = F.shiftright("_at", FAN_BITS * (level + 1)).alias("node")
        return it.groupBy(group, *own, node).agg(F.count(F.lit(1)).alias("n"), *box)

    key = [group, "block"]
    edges = [f(c).alias(f"q{c}{i}") for c in "xy" for i, f in ((1, F.min), (2, F.max))]
    search = _block_search(k, lead, columns, order, shape, distance2, owner, reduce)
    found = None
    for bits in BLOCK_BITS:
        here = q.withColumn("block", F.shiftright("_at", bits))
        blocks = here.groupBy(*key).agg(*edges)
        kept = _near_boxes(blocks.join(nodes(top), group), k, key, owner)
        for level in reversed(range(top)):
            below = nodes(level).withColumn("up", F.shiftright("node", FAN_BITS))
            opened = kept.select(*key, *own, "qx1", "qx2", "qy1", "qy2", F.col("node").alias("up"))
            kept = _near_boxes(opened.join(below, [group, *own, "up"]).drop("up"), k, key, owner)
        met = F.sum("n").over(Window.partitionBy(*key)).alias("met")
        kept = cut_lineage(kept.select(*key, *own, "node", met))
        fits = F.col("met") <= (WIDE if bits else 1 << 62)
        leaves = it.withColumn("node", F.shiftright("_at", FAN_BITS))
        meets = leaves.join(kept.filter(fits).drop("met"), [group, *own, "node"])
        # names of their own: both sides of the search come from one table of queries
        meets = meets.select(*[F.col(c).alias(c) for c in dict.fromkeys([*key, *columns, *own, *ends])])
        part = here.groupBy(*key).cogroup(meets.groupBy(*key)).applyInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
        crowded = kept.filter(~fits).select(*key).distinct()
        if not bits or crowded.isEmpty():
            return found
        q = here.join(crowded, key, "left_semi").drop("block")
    return found


def _to_point2(x: np.ndarray, y: np.ndarray, tx: np.ndarray, ty: np.ndarray, *_: np.ndarray) -> np.ndarray:
    return (x - tx) * (x - tx) + (y - ty) * (y - ty)


def _to_side2(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray, ex: np.ndarray, ey: np.ndarray) -> np.ndarray:
    dx, dy = ex - sx, ey - sy
    length2 = dx * dx + dy * dy
    along = ((x - sx) * dx + (y - sy) * dy) / np.where(length2 == 0, 1.0, length2)
    t = np.where(length2 == 0, 0.0, np.clip(along, 0.0, 1.0))
    return _to_point2(x, y, sx + t * dx, sy + t * dy)


def k_nearest_points(
    queries: DataFrame,
    targets: DataFrame,
    k: int,
    group: str,
    query_key: str,
    target_columns: Sequence[str],
    order: str,
    reduce: Reduce | None = None,
    reduced: Sequence[StructField] = (),
) -> DataFrame:
    """k nearest target points in degrees; ties go to the lower `order`.

    `queries` has x and y, `targets` has tx and ty. Of targets at one exact point only
    the k lowest in order can ever be chosen, so the others are left out beforehand.
    """
    distinct = top_per_group(targets, [group, "tx", "ty"], [F.col(order)], k)
    shape = ("tx", "ty", "tx", "ty")
    return nearest_items(queries, distinct, k, group, query_key, list(target_columns), order, shape, _to_point2, reduce=reduce, reduced=reduced)


def nearest_polygons(points: DataFrame, edges: DataFrame, k: int, key: str, group: str = "adm0_pcode") -> DataFrame:
    """k nearest polygons of each point's group (its country), by the distance to their edges."""
    shape = ("sx", "sy", "ex", "ey")
    return nearest_items(points, edges, k, group, key, ["pcode"], "poly_seq", shape, _to_side2, owner="pcode" if k > 1 else None)


def nearest_value(cells: DataFrame, tiles: DataFrame, values: Sequence[str], mask_km: float, name: str) -> DataFrame:
    """Attach the values of the nearest tile; beyond the mask they are null, the distance stays."""
    from access_spark.functions.geo import degrees_to_km

    points = cells.select("iso", "cell_id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    targets = tiles.select("iso", "tile_seq", *values, F.col("lon").alias("tx"), F.col("lat").alias("ty"))
    found = k_nearest_points(points, targets, 1, "iso", "cell_id", list(values), "tile_seq")
    km = degrees_to_km(F.sqrt("d2"))
    masked = [F.when(km <= mask_km, F.col(v)).alias(v) for v in values]
    return cells.join(found.select("iso", "cell_id", *masked, km.alias(name)), ["iso", "cell_id"], "left")


# ---- lattice and raster ---------------------------------------------------------------------


def lattice_join(
    points: DataFrame, cells: DataFrame, inherit: Sequence[str], pitch: float, group: str = "iso"
) -> DataFrame:
    """Left join of points (lat, lon) to lattice cells on whole lattice steps.

    The lattice of a country is anchored on its first cell (lowest cell_id); one row per
    country carries the anchor.
    """
    anchor = cells.groupBy(group).agg(F.min_by("lat", "cell_id").alias("_lat0"), F.min_by("lon", "cell_id").alias("_lon0"))

    def indexed(df: DataFrame) -> DataFrame:
        return df.join(anchor, group, "left").withColumns(
            {
                "_i": lattice_index(F.col("lat"), F.col("_lat0"), pitch),
                "_j": lattice_index(F.col("lon"), F.col("_lon0"), pitch),
            }
        ).drop("_lat0", "_lon0")

    right = indexed(cells).select(group, "_i", "_j", *inherit)
    return indexed(points).join(right, [group, "_i", "_j"], "left").drop("_i", "_j")


def sample_raster(points: DataFrame, raster: DataFrame, name: str, nodata: float | None = None) -> DataFrame:
    """Value of the raster cell (row, col) under each point; nodata, NaN and cells that do
    not exist give null."""
    value = finite(F.col("value"))
    if nodata is not None:
        value = F.when(F.col("value") != nodata, value)
    return points.join(raster.select("iso", "row", "col", value.alias(name)), ["iso", "row", "col"], "left")


def sample_sum(points: DataFrame, rasters: Sequence[DataFrame], name: str, nodata: float | None = None) -> DataFrame:
    """Sum of several rasters under each point; missing and negative values count as zero."""
    out = points
    parts = []
    for i, raster in enumerate(rasters):
        out = sample_raster(out, raster, f"_s{i}", nodata)
        parts.append(F.greatest(F.coalesce(F.col(f"_s{i}"), F.lit(0.0)), F.lit(0.0)))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return out.withColumn(name, total).drop(*[f"_s{i}" for i in range(len(rasters))])


def window_sum(tiles: DataFrame, raster: DataFrame, half_rows: int, half_cols: int, name: str = "pop") -> DataFrame:
    """Sum of the raster cells in a window around each tile's (row, col).

    Raster and tiles meet on coarse blocks the size of the window, so each side looks at
    a few blocks only; negative and missing cells count as zero.
    """
    rows, cols = 2 * half_rows + 1, 2 * half_cols + 1
    r, c = F.col("row"), F.col("col")
    wanted = tiles.select("iso", "tile_seq", "row", "col").select(
        "*",
        F.explode(
            F.sequence(
                F.floor((r - half_rows) / rows).cast("bigint"), F.floor((r + half_rows) / rows).cast("bigint")
            )
        ).alias("_br"),
    ).select(
        "*",
        F.explode(
            F.sequence(
                F.floor((c - half_cols) / cols).cast("bigint"), F.floor((c + half_cols) / cols).cast("bigint")
            )
        ).alias("_bc"),
    )
    cells = raster.select(
        "iso", F.col("row").alias("_r"), F.col("col").alias("_c"),
        F.greatest(F.coalesce(finite(F.col("value")), F.lit(0.0)), F.lit(0.0)).alias("_v"),
        F.floor(r / rows).cast("bigint").alias("_br"), F.floor(c / cols).cast("bigint").alias("_bc"),
    )
    near = F.col("_r").between(r - half_rows, r + half_rows) & F.col("_c").between(c - half_cols, c + half_cols)
    sums = (
        wanted.join(cells, ["iso", "_br", "_bc"]).filter(near)
        .groupBy("iso", "tile_seq").agg(F.sum("_v").alias(name))
    )
    return tiles.join(sums, ["iso", "tile_seq"], "left").fillna(0.0, [name])
