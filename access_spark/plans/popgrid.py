"""Population grid: settlements, admin codes, ages, nearest wealth tile and poverty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.operators import settlements, spatial
from access_spark.operators.keyed import number_rows
from access_spark.session import cut_lineage

GRID_COLUMNS = (
    "cell_id", "lat", "lon", "pop_total", "pop_5_9", "pop_10_14", "pop_15_19", "area_class",
    "adm1_pcode", "adm2_pcode", "rwi", "rwi_error", "rwi_dist_km", "poverty_rate", "nbi_rate",
)


def assign_admin(cells: DataFrame, boundaries: DataFrame, edges: DataFrame) -> DataFrame:
    """Admin codes at cell centres; a country without level 2 polygons uses level 1. Where
    polygons overlap the later one counts. Cells outside every polygon get null."""
    fine = edges.filter("level = 2").select("adm0_pcode").distinct().withColumn("_fine", F.lit(True))
    used = edges.filter("level > 0").join(fine, "adm0_pcode", "left").filter(
        F.col("level") == F.when(F.col("_fine"), 2).otherwise(1)
    ).drop("_fine")
    points = cells.select(F.col("iso").alias("adm0_pcode"), "row", "col", F.col("lon").alias("x"), F.col("lat").alias("y"))
    hits = spatial.polygons_of_points(points, used, ["adm0_pcode", "row", "col"]).filter("inside")
    units = boundaries.select("adm0_pcode", "level", "pcode", "adm1_pcode", "poly_seq")
    last = F.max(F.struct("poly_seq", "level", "pcode", "adm1_pcode")).alias("u")
    found = hits.join(units, ["adm0_pcode", "level", "pcode"]).groupBy(F.col("adm0_pcode").alias("iso"), "row", "col").agg(last)
    codes = found.select(
        "iso", "row", "col", F.col("u.adm1_pcode").alias("adm1_pcode"), F.when(F.col("u.level") == 2, F.col("u.pcode")).alias("adm2_pcode")
    )
    return cells.join(codes, ["iso", "row", "col"], "left")


def build_grid(
    fine: DataFrame, block: int, transforms: DataFrame, pitch: float,
    boundaries: DataFrame, edges: DataFrame, ages: dict[str, list[DataFrame]], tiles: DataFrame, poverty: DataFrame,
) -> DataFrame:
    """One row per populated cell of every country, with the published grid columns.

    `fine` is the fine population raster, `transforms` has its top-left corner per country
    (iso, lat0, lon0), `pitch` is the coarse cell size, `ages` maps a population column to
    its rasters (on the coarse lattice), `tiles` are wealth tiles, `poverty` has adm2 rates.
    """
    coarse = settlements.block_sum(fine, block).join(transforms, "iso").withColumns(
        {
            "lat": F.col("lat0") - (F.col("row") + 0.5) * pitch,
            "lon": F.col("lon0") + (F.col("col") + 0.5) * pitch,
        }
    ).withColumnRenamed("value", "pop_total").drop("lat0", "lon0")
    coarse = cut_lineage(coarse)
    classed = settlements.classify_area(coarse, pitch).filter("pop_total > 0").select(
        "iso", "row", "col", "lat", "lon", "pop_total", "area_class"
    )
    cells = assign_admin(classed, boundaries, edges)
    cells = number_rows(cells, ["iso"], "row", "col", "cell_id", start=0)
    for name, rasters in ages.items():
        cells = spatial.sample_sum(cells, rasters, name)
    cells = cut_lineage(cells)
    cells = spatial.nearest_value(cells, tiles, ["rwi", "rwi_error"], config.WEALTH_MASK_KM, "rwi_dist_km")
    cells = cells.join(poverty, ["iso", "adm2_pcode"], "left")
    return cells.select("iso", "row", "col", *GRID_COLUMNS)


def grid_manifest(grid: DataFrame) -> DataFrame:
    """Counts and totals per country for the run manifest."""
    return grid.groupBy("iso").agg(
        F.count(F.lit(1)).alias("n_populated_cells"),
        F.round(F.sum("pop_total"), 2).alias("pop_total"),
        *[F.round(F.sum(c), 2).alias(f"{c}_total") for c in ("pop_5_9", "pop_10_14", "pop_15_19")],
        F.count_if(F.col("adm2_pcode").isNull()).alias("n_cells_outside_adm2"),
        F.count("rwi").alias("n_cells_with_rwi"),
        F.count_if(F.col("rwi_dist_km") > config.WEALTH_MASK_KM).alias("n_cells_rwi_masked"),
        F.count("poverty_rate").alias("n_cells_with_poverty"),
    )
