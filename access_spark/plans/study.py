"""Wealth-against-poverty study: tiles to admin units, correlation tests and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_spark.operators import spatial, study
from access_spark.operators.bootstrap import bootstrap_interval
from access_spark.session import cut_lineage

MIN_TILES = 5


def wealth_by_unit(tiles: DataFrame, raster: DataFrame, boundaries: DataFrame, edges: DataFrame, half_rows: int, half_cols: int) -> DataFrame:
    """Population-weighted wealth per level 2 unit.

    `tiles` has iso, tile_seq, lon, lat, row, col, rwi, rwi_error; the population of a tile
    is the window sum of the fine raster. Units without a tile keep zero counts.
    """
    peopled = spatial.window_sum(tiles, raster, half_rows, half_cols)
    points = peopled.select(F.col("iso").alias("adm0_pcode"), "tile_seq", F.col("lon").alias("x"), F.col("lat").alias("y"))
    units = boundaries.filter("level = 2")
    inside = spatial.locate(points, units, edges.filter("level = 2"), ["adm0_pcode", "tile_seq"], ("pcode",)).select(
        F.col("adm0_pcode").alias("iso"), "tile_seq", F.col("pcode").alias("adm2_pcode")
    )
    rows = peopled.join(inside, ["iso", "tile_seq"])
    stats = study.weighted_stats(rows, ["iso", "adm2_pcode"], "rwi", "rwi_error", "pop")
    frame = units.select(F.col("adm0_pcode").alias("iso"), F.col("pcode").alias("adm2_pcode"), "adm1_pcode", F.col("name").alias("adm2_name"))
    return frame.join(stats, ["iso", "adm2_pcode"], "left").fillna({"n_cells": 0, "pop_total": 0.0})


def correlation_tests(
    units: DataFrame, poverty: DataFrame, draws: int = 1000, seed: int = 42, min_tiles: int = MIN_TILES
) -> DataFrame:
    """Spearman, Pearson, interval and decile agreement per country and poverty measure, over
    populated units with enough tiles."""
    rates = F.array(
        F.struct(F.lit("POVERTY_RATE").alias("target"), F.col("poverty_rate").cast("double").alias("rate")),
        F.struct(F.lit("NBI_RATE").alias("target"), F.col("nbi_rate").cast("double").alias("rate")),
    )
    rows = (
        units.filter((F.col("n_cells") >= min_tiles) & (F.col("pop_total") > 0))
        .join(poverty, ["iso", "adm2_pcode"])
        .select("iso", "adm2_pcode", "weighted_mean", F.explode(rates).alias("r"))
        .select("iso", F.col("adm2_pcode").alias("unit_id"), "weighted_mean", "r.*")
    )
    rows = cut_lineage(rows)
    keys = ["iso", "target"]
    return (
        study.correlations(rows, keys, "weighted_mean", "rate")
        .join(bootstrap_interval(rows, keys, "weighted_mean", "rate", draws, seed), keys, "left")
        .join(study.decile_agreement(rows, keys, "weighted_mean", "rate"), keys, "left")
    )
