"""Population grid steps: block sums, settlements and area classes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.geo import cell_area_km2
from access_spark.functions.numeric import finite, percent, round_even
from access_spark.session import cut_lineage

TILE = 256  # side of the squares of cells in which components are found first
WIDE = 1 << 31  # a cell's number is its row times this, plus its column


def block_sum(raster: DataFrame, block: int, rows: Column | None = None, cols: Column | None = None) -> DataFrame:
    """Fine cells summed into blocks; missing values count as zero and so does a negative
    sum. With the raster's size given, incomplete blocks at its far edges are left out."""
    out = raster.select(
        "iso",
        F.floor(F.col("row") / block).cast("bigint").alias("_r"),
        F.floor(F.col("col") / block).cast("bigint").alias("_c"),
        F.coalesce(finite(F.col("value")), F.lit(0.0)).alias("_v"),
        *([rows.alias("_h"), cols.alias("_w")] if rows is not None else []),
    )
    if rows is not None:
        out = out.filter(
            (F.col("_r") < F.floor(F.col("_h") / block)) & (F.col("_c") < F.floor(F.col("_w") / block))
        )
    sums = out.groupBy("iso", F.col("_r").alias("row"), F.col("_c").alias("col")).agg(F.sum("_v").alias("value"))
    return sums.withColumn("value", F.greatest(F.col("value"), F.lit(0.0)))


def _labelled_tile(cells: pd.DataFrame) -> pd.DataFrame:
    """Cells of one tile with the smallest cell number of those that hang together in it.

    Runs of touching cells in a row are the nodes; two runs of neighbouring rows touch,
    corners included, if one starts no later than just past the end of the other. Roots hook
    onto the smallest root they touch until nothing changes.
    """
    cells = cells.sort_values(["row", "col"], ignore_index=True)
    row, col = cells["row"].to_numpy(), cells["col"].to_numpy()
    first = np.ones(len(cells), bool)
    first[1:] = (np.diff(row) != 0) | (np.diff(col) > 1)
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(cells)) - 1
    stride = 2 * TILE  # wider than a tile and the columns just past it
    line, base = row - row[0], col.min() - 1
    start_key, end_key = line[starts] * stride + col[starts] - base, line[ends] * stride + col[ends] - base
    low = np.searchsorted(end_key, start_key + stride - 1)
    counts = np.maximum(np.searchsorted(start_key, end_key + stride + 1, side="right") - low, 0)
    upper = np.repeat(np.arange(len(starts)), counts)
    lower = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    root = np.arange(len(starts))
    while True:
        least, before = np.minimum(root[upper], root[lower]), root
        root = before.copy()
        np.minimum.at(root, before[upper], least)
        np.minimum.at(root, before[lower], least)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    number = row[starts] * WIDE + col[starts]
    return cells[["iso", "row", "col"]].assign(label=number[root][np.cumsum(first) - 1])


def smallest_reachable(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The smallest node that each node of a graph (iso, a, b) reaches, as (iso, node, root).

    Alternates large-star and small-star steps (Kiveris et al., 2014): each step points
    nodes at the smallest neighbour, and the number of steps grows with the logarithm of
    the graph, not with the length of a component.
    """
    for _ in range(max_rounds):
        both = edges.select("iso", "a", "b").union(edges.select("iso", F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("iso", "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter("b > a").join(low, ["iso", "a"])
            .select("iso", F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        )
        down = large.select("iso", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("iso", "a").agg(F.min("b").alias("m"))
        small = (
            down.join(least, ["iso", "a"]).select("iso", F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("iso", "a", F.col("m").alias("b"))).filter("a <> b").distinct()
        )
        edges = cut_lineage(small)
        # finished when every node hangs on one other, which itself hangs on none
        chained = edges.join(edges.select("iso", F.col("a").alias("b")).distinct(), ["iso", "b"], "left_semi")
        if chained.isEmpty() and edges.groupBy("iso", "a").count().filter("count > 1").isEmpty():
            return edges.select("iso", F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("settlement labelling did not settle")


def dense_components(cells: DataFrame) -> DataFrame:
    """Cells (iso, row, col) with the component of touching cells they belong to, corners
    included; `component` numbers its smallest cell, in the order (row, col).

    Components are found inside tiles first, each tile in one task. Only cells on tile
    borders then look across, and only labels that meet there are joined to components.
    """
    tile = [F.floor(F.col(c) / TILE).alias(f"_{c}") for c in ("row", "col")]
    places = cells.select("iso", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col")).na.drop(subset=["row", "col"])
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in places.schema)
    labelled = cut_lineage(places.groupBy("iso", *tile).applyInPandas(_labelled_tile, f"{types}, label bigint"))
    at_border = F.pmod("row", F.lit(TILE)).isin(0, TILE - 1) | F.pmod("col", F.lit(TILE)).isin(0, TILE - 1)
    border = labelled.filter(at_border)
    back = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((-1, -1), (-1, 0), (-1, 1), (0, -1))])
    looks = border.select("iso", "row", "col", F.col("label").alias("a"), F.explode(back).alias("d")).select(
        "iso", (F.col("row") + F.col("d.r")).alias("row"), (F.col("col") + F.col("d.c")).alias("col"), "a"
    )
    edges = looks.join(border.withColumnRenamed("label", "b"), ["iso", "row", "col"]).filter("a <> b").select("iso", "a", "b").distinct()
    roots = smallest_reachable(cut_lineage(edges))
    return labelled.join(roots.withColumnRenamed("node", "label"), ["iso", "label"], "left").select(
        "iso", "row", "col", F.coalesce("root", "label").alias("component")
    )


def classify_area(grid: DataFrame, pitch: float = config.GRID_PITCH) -> DataFrame:
    """Area class of every populated cell from the settlement it belongs to.

    A settlement of 5 000 people or more is urban when it is dense enough, otherwise
    semi-urban, as is one of 200 to 5 000; the rest is dispersed. Adds `area_class`,
    `component` and the settlement's population and density.
    """
    area = cell_area_km2(F.col("lat"), pitch)
    density = F.when(area > 0, F.col("pop_total") / area).otherwise(F.lit(0.0))
    rows = grid.withColumns({"_area": area, "_density": density})
    dense = rows.filter(F.col("_density") >= config.SETTLEMENT_MIN_DENSITY)
    labelled = dense_components(dense)
    members = labelled.join(rows.select("iso", "row", "col", "pop_total", "_area"), ["iso", "row", "col"])
    totals = members.groupBy("iso", "component").agg(
        F.sum("pop_total").alias("settlement_pop"), F.sum("_area").alias("_a")
    ).select("iso", "component", "settlement_pop", (F.col("settlement_pop") / F.col("_a")).alias("settlement_density"))
    pop, dens = F.col("settlement_pop"), F.col("settlement_density")
    kind = (
        F.when((dens >= config.URBAN_MIN_DENSITY) & (pop >= config.URBAN_MIN_POPULATION), "urbana")
        .when(pop >= config.SETTLEMENT_MIN_POPULATION, "no_urbana")
        .otherwise("dispersa")
    )
    classes = labelled.join(totals, ["iso", "component"]).select(
        "iso", "row", "col", "component", "settlement_pop", "settlement_density", kind.alias("area_class")
    )
    return (
        grid.drop("area_class").join(classes, ["iso", "row", "col"], "left")
        .withColumn("area_class", F.coalesce("area_class", F.lit("dispersa")))
    )


def area_shares(grid: DataFrame) -> DataFrame:
    """Population per country and the share of each area class."""
    pop = F.col("pop_total")
    sums = grid.groupBy("iso").agg(
        F.sum(pop).alias("pop_total"),
        *[F.sum(F.when(F.col("area_class") == c, pop).otherwise(0.0)).alias(f"_{c}") for c in config.AREA_LABELS],
    )
    return sums.select(
        "iso", F.round("pop_total", 2).alias("pop_total"),
        *[percent(F.col(f"_{c}"), F.col("pop_total"), 2).alias(f"pct_pop_{c}") for c in config.AREA_LABELS],
    )


def population_check(grid: DataFrame, external: DataFrame) -> DataFrame:
    """Grid population against external totals: absolute and relative difference."""
    sums = grid.groupBy("iso").agg(F.sum("pop_total").alias("pop_total"))
    diff = F.col("pop_total") - F.col("pop_external")
    return sums.join(external, "iso").select(
        "iso", F.round("pop_total", 2).alias("pop_total"), "pop_external", F.round(diff, 2).alias("diff_abs"),
        round_even(100.0 * diff / F.nullif(F.col("pop_external"), F.lit(0.0)), 2).alias("diff_pct"),
    )


def raster_stats(raster: DataFrame, nodata: float | None = None) -> DataFrame:
    """Valid and total cells, smallest, largest and mean value per raster."""
    value = finite(F.col("value"))
    if nodata is not None:
        value = F.when(F.col("value") != nodata, value)
    return raster.groupBy("iso").agg(
        F.count(value).alias("n_valid"), F.count(F.lit(1)).alias("n_total"),
        F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value), 6).alias("mean"),
    )


def clip_window(raster: DataFrame, boxes: DataFrame, origin_lat: float, origin_lon: float, pitch: float, pad: float) -> DataFrame:
    """Cells of a raster inside each country's padded box: the offset is rounded down, the
    length up. `boxes` has iso and the limits; the raster is global (row, col, value)."""
    top, left = F.col("lat_max") + pad, F.col("lon_min") - pad
    bottom, right = F.col("lat_min") - pad, F.col("lon_max") + pad
    r0 = F.floor((F.lit(origin_lat) - top) / pitch).cast("bigint")
    c0 = F.floor((left - F.lit(origin_lon)) / pitch).cast("bigint")
    windows = boxes.select(
        "iso", r0.alias("r0"), c0.alias("c0"),
        (r0 + F.ceil((top - bottom) / pitch).cast("bigint") - 1).alias("r1"),
        (c0 + F.ceil((right - left) / pitch).cast("bigint") - 1).alias("c1"),
    )
    # raster and windows meet on coarse tiles: a cell lies in one tile, a window in few
    tile = 64
    tiles = windows.select(
        "*", F.explode(F.sequence(F.floor(F.col("r0") / tile), F.floor(F.col("r1") / tile))).alias("tr")
    ).select("*", F.explode(F.sequence(F.floor(F.col("c0") / tile), F.floor(F.col("c1") / tile))).alias("tc"))
    cells = raster.select("row", "col", "value", F.floor(F.col("row") / tile).alias("tr"), F.floor(F.col("col") / tile).alias("tc"))
    inside = F.col("row").between(F.col("r0"), F.col("r1")) & F.col("col").between(F.col("c0"), F.col("c1"))
    return cells.join(tiles, ["tr", "tc"]).filter(inside).select("iso", "row", "col", "value")
