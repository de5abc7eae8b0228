"""First pass over a registry: admin status of every located school for the summary reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_spark.functions.geo import in_box, looks_swapped
from access_spark.operators import quality, spatial


def check_registry(
    registry: DataFrame, addresses: DataFrame, boundaries: DataFrame, edges: DataFrame, countries: DataFrame, level: int = 1
) -> DataFrame:
    """Registry rows with qc_status (null without coordinates).

    `countries` has iso, final_match_level and the box; polygons of `level` are used.
    """
    lat, lon = F.col("latitud"), F.col("longitud")
    box = {c: F.col(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")}
    declared = addresses.select(F.col("adm0_pcode").alias("iso"), "id_centro", "raw_adm1", F.col("raw_adm1_code").alias("_code"))
    settings = countries.select("iso", "final_match_level", *box)
    rows = (
        registry.select("iso", "id_centro", "latitud", "longitud")
        .join(declared, ["iso", "id_centro"], "left").join(settings, "iso", "left")
        .withColumns({"_in": in_box(lat, lon, box), "_swap": looks_swapped(lat, lon, box)})
    )
    points = rows.filter("_in").select(F.col("iso").alias("adm0_pcode"), "id_centro", lon.alias("x"), lat.alias("y"))
    found = spatial.locate(
        points, boundaries.filter(F.col("level") == level), edges.filter(F.col("level") == level), ["adm0_pcode", "id_centro"], ("pcode", "name")
    ).withColumnRenamed("adm0_pcode", "iso")
    status = quality.prepass_status(
        F.col("_swap"), F.col("_in"), F.col("name"), F.col("pcode"), F.col("_code"), F.col("raw_adm1"), F.col("iso"),
        F.col("final_match_level") == "spatial_only", level,
    )
    located = lat.isNotNull() & lon.isNotNull()
    return rows.join(found, ["iso", "id_centro"], "left").withColumn("qc_status", F.when(located, status)).drop("_in", "_swap", "_code", *box)
