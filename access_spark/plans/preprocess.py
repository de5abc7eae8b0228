"""Admin files that have to be put together before addresses can be extracted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_spark.functions.text import compose_street, fix_mojibake, integer_id
from access_spark.operators.keyed import keep_first, union_columns


def combined_admin(layers: Sequence[DataFrame], places: DataFrame, systems: Sequence[str] = ("CEIP", "CES", "CETP")) -> DataFrame:
    """Ids and departments of several layers, repaired and distinct, with addresses attached.

    A layer has id, department and row_seq; `places` has ruee, subsystem, localidad, paraje,
    calle, n_de_puerta and row_seq.
    """
    rows = union_columns(
        *[layer.withColumn("row_seq", F.col("row_seq") + F.lit(i << 40)) for i, layer in enumerate(layers)]
    ).select(F.trim("id").alias("id_centro"), fix_mojibake(F.trim("department")).alias("departamento"), "row_seq")
    rows = rows.filter(~F.col("id_centro").isin("", "0", "0.0", "nan", "None"))
    schools = keep_first(rows, ["id_centro"], F.col("row_seq")).drop("row_seq")
    known = places.filter(F.col("subsystem").isin(*systems) & F.col("ruee").isNotNull()).select(
        integer_id(F.col("ruee")).alias("id_centro"), "localidad", "paraje", compose_street(F.col("calle"), F.col("n_de_puerta")).alias("calle"),
        F.trim("n_de_puerta").alias("n_de_puerta"), "row_seq",
    )
    return schools.join(keep_first(known, ["id_centro"], F.col("row_seq")).drop("row_seq"), "id_centro", "left")


def names_by_code(directory: DataFrame, units: DataFrame, prefix: str) -> DataFrame:
    """Province name by its numeric code: the unit's code without prefix and padding.

    `directory` has id, province_code, comuna, region_code; `units` has pcode and name.
    """
    codes = units.select(
        F.regexp_replace("pcode", f"^{prefix}0?", "").try_cast("int").alias("_code"), F.col("name").alias("provincia_bid")
    ).filter("_code IS NOT NULL")
    rows = directory.withColumn("_code", F.col("province_code").cast("string").try_cast("int"))
    return rows.join(codes, "_code", "left").select(
        F.col("id").cast("string").alias("id_centro"), "provincia_bid", "comuna", F.col("region_code").alias("cod_reg_rbd")
    )
