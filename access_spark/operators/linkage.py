"""Linking registries: coordinate cascades, building ids and vintage comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark.functions.geo import haversine_km
from access_spark.functions.numeric import flag, percent, round_even
from access_spark.functions.text import normalize_id
from access_spark.operators.keyed import exact_quantiles, number_rows, one_to_one_join, union_columns

MEAN_EARTH_RADIUS_KM = 6371.0088
CONFIRMED_KM = 0.1
COHERENCE_THRESHOLD = 0.85
NO_TOTAL_FILE = ("BRA",)


def coordinate_cascade(df: DataFrame, sources: Sequence[DataFrame], key: str = "id_centro") -> DataFrame:
    """Fill missing coordinates from the first source that has both; a pair is never mixed.

    Each source has the key, latitud, longitud and row_seq (its first row counts).
    """
    both = F.col("latitud").isNotNull() & F.col("longitud").isNotNull()
    pair = F.when(both, F.struct(F.col("latitud").alias("lat"), F.col("longitud").alias("lon")))
    out = df.withColumn("_p", F.when(F.col("latitud").isNotNull(), F.struct(F.col("latitud").alias("lat"), F.col("longitud").alias("lon"))))
    picks = [F.col("_p")]
    for i, source in enumerate(sources):
        usable = source.filter(both & ~((F.col("latitud") == 0) & (F.col("longitud") == 0)))
        lookup = usable.groupBy(key).agg(F.min_by(pair, F.col("row_seq")).alias(f"_p{i}"))
        out = out.join(lookup, key, "left")
        picks.append(F.col(f"_p{i}"))
    chosen = F.coalesce(*picks)
    origin = F.when(picks[0].isNotNull(), F.lit(0))
    for i, pick in enumerate(picks[1:], start=1):
        origin = origin.when(pick.isNotNull(), F.lit(i))
    return out.withColumns(
        {"latitud": chosen["lat"], "longitud": chosen["lon"], "coord_source_rank": origin}
    ).drop("_p", *[f"_p{i}" for i in range(len(sources))])


def prior_period_fallback(current: DataFrame, prior: DataFrame, valid: Column, key: str = "id_centro") -> DataFrame:
    """Take last period's coordinates where this period's are not valid.

    `valid` is a condition on latitud and longitud; of several prior rows the first valid
    one counts. The pair is replaced as a whole.
    """
    lookup = prior.filter(F.coalesce(valid, F.lit(False))).groupBy(key).agg(
        F.min_by(F.struct("latitud", "longitud"), F.col("row_seq")).alias("_prev")
    )
    use = ~F.coalesce(valid, F.lit(False)) & F.col("_prev").isNotNull()
    return current.join(lookup, key, "left").withColumns(
        {
            "used_prior": F.coalesce(use, F.lit(False)),
            "latitud": F.when(use, F.col("_prev.latitud")).otherwise(F.col("latitud")),
            "longitud": F.when(use, F.col("_prev.longitud")).otherwise(F.col("longitud")),
        }
    ).drop("_prev")


def _ids(df: DataFrame) -> DataFrame:
    """First building id per (country, school id)."""
    rows = df.filter(F.col("id_edificio").isNotNull()).select(
        "adm0_pcode", normalize_id(F.col("id_centro")).alias("_id"), F.col("id_edificio").cast("string"), "row_seq"
    ).filter(F.col("_id") != "")
    return rows.groupBy("adm0_pcode", "_id").agg(F.min_by("id_edificio", "row_seq").alias("_edif"))


def building_ids(schools: DataFrame, total: DataFrame, regional: DataFrame, skip: Sequence[str] = NO_TOTAL_FILE) -> DataFrame:
    """Building id of every school with the path that found it.

    A_total: country file by id; B_lac_id: regional file by id; C_lac_coords: regional file
    by rounded point when the point names one building only; D_synthetic: numbered per
    country in row order. `schools` needs adm0_pcode, id_centro, row_seq, coordinates.
    """
    both = F.col("latitud").isNotNull() & F.col("longitud").isNotNull()
    keyed = schools.withColumns(
        {
            "_id": normalize_id(F.col("id_centro")),
            "_lat": F.when(both, round_even(F.col("latitud"), 5)),
            "_lon": F.when(both, round_even(F.col("longitud"), 5)),
        }
    )
    by_total = _ids(total.filter(~F.col("adm0_pcode").isin(*skip))).withColumnRenamed("_edif", "_a")
    by_region = _ids(regional).withColumnRenamed("_edif", "_b")
    at_point = (
        regional.filter(F.col("id_edificio").isNotNull() & F.col("latitud").isNotNull() & F.col("longitud").isNotNull())
        .groupBy(
            "adm0_pcode", round_even(F.col("latitud"), 5).alias("_lat"), round_even(F.col("longitud"), 5).alias("_lon")
        )
        .agg(F.min("id_edificio").alias("_c"), F.max("id_edificio").alias("_c2"))
        .filter("_c = _c2")
        .drop("_c2")
    )
    found = (
        keyed.join(by_total, ["adm0_pcode", "_id"], "left")
        .join(by_region, ["adm0_pcode", "_id"], "left")
        .join(at_point, ["adm0_pcode", "_lat", "_lon"], "left")
        .withColumns(
            {
                "id_edificio": F.coalesce("_a", "_b", "_c"),
                "match_path": F.when(F.col("_a").isNotNull(), "A_total")
                .when(F.col("_b").isNotNull(), "B_lac_id")
                .when(F.col("_c").isNotNull(), "C_lac_coords")
                .otherwise("D_synthetic"),
            }
        )
        .drop("_id", "_lat", "_lon", "_a", "_b", "_c")
    )
    missing = found.filter(F.col("id_edificio").isNull()).select("adm0_pcode", "id_centro", "row_seq")
    numbered = number_rows(missing, ["adm0_pcode"], "row_seq", "row_seq", "_n").select(
        "adm0_pcode", "row_seq", F.format_string("%s_SYN_%05d", F.col("adm0_pcode"), F.col("_n")).alias("_syn")
    )
    return (
        found.join(numbered, ["adm0_pcode", "row_seq"], "left")
        .withColumn("id_edificio", F.coalesce("id_edificio", "_syn"))
        .drop("_syn")
    )


def building_audit(matched: DataFrame) -> DataFrame:
    """Rows with building_match and building_match_suspect: a real building with several schools of
    which one stands alone at its point."""
    size = F.coalesce(F.col("qc_cluster_size_exact"), F.lit(0))
    real = F.col("match_path") != "D_synthetic"
    buildings = (
        matched.filter(real)
        .groupBy("adm0_pcode", "id_edificio")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(size).alias("_least"))
    )
    suspect = (F.col("_n") > 1) & (F.col("_least") <= 1)
    return (
        matched.join(buildings, ["adm0_pcode", "id_edificio"], "left")
        .withColumns({"building_match": real, "building_match_suspect": F.coalesce(suspect, F.lit(False))})
        .drop("_n", "_least")
    )


def building_summary(matched: DataFrame) -> DataFrame:
    """Per country: rows per path and agreement of shared buildings with point clusters."""
    size = F.coalesce(F.col("qc_cluster_size_exact"), F.lit(0))
    differs = F.coalesce(F.col("qc_cluster_diff_addr_exact"), F.lit(False))
    real = F.col("match_path") != "D_synthetic"
    paths = matched.groupBy("adm0_pcode").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col("match_path") == p).alias(p) for p in ("A_total", "B_lac_id", "C_lac_coords", "D_synthetic")],
    )
    buildings = (
        matched.filter(real)
        .groupBy("adm0_pcode", "id_edificio")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min((size > 1).cast("int")).alias("sizes_ok"),
            F.min((~differs).cast("int")).alias("addr_ok"),
            F.min(size).alias("least"),
        )
        .filter("n > 1")
    )
    ok_size, ok_addr = F.col("sizes_ok") == 1, F.col("addr_ok") == 1
    checks = buildings.groupBy("adm0_pcode").agg(
        F.count(F.lit(1)).alias("real_buildings_multi"),
        F.count_if(ok_size & ok_addr).alias("coherent_buildings"),
        F.count_if(~ok_size).alias("incoherent_size"),
        F.count_if(ok_size & ~ok_addr).alias("incoherent_diff_addr"),
        F.sum(F.when(F.col("least") <= 1, F.col("n")).otherwise(0)).alias("building_match_suspect_rows"),
    )
    counts = ("real_buildings_multi", "coherent_buildings", "incoherent_size", "incoherent_diff_addr", "building_match_suspect_rows")
    out = paths.join(checks, "adm0_pcode", "left").fillna(0, list(counts))
    coherence = F.when(F.col("real_buildings_multi") == 0, 1.0).otherwise(
        F.col("coherent_buildings") / F.col("real_buildings_multi")
    )
    return out.withColumns(
        {
            "coherence": F.round(coherence, 6),
            "meets_threshold": (coherence >= COHERENCE_THRESHOLD) | (F.col("real_buildings_multi") == 0),
        }
    )


def compare_vintages(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("adm0_pcode", "id_centro")) -> DataFrame:
    """State of every school between two vintages of a registry, with the move in km. A
    coordinate outside the globe counts as missing."""
    lat = F.when(F.abs("latitud") <= 90, F.col("latitud"))
    lon = F.when(F.abs("longitud") <= 180, F.col("longitud"))
    a = old.select(*keys, lat.alias("lat_prev"), lon.alias("lon_prev"), F.lit(True).alias("_old"))
    b = new.select(*keys, lat.alias("lat_new"), lon.alias("lon_new"), F.lit(True).alias("_new"))
    pair = a.join(b, list(keys), "full_outer")
    km = haversine_km(F.col("lat_prev"), F.col("lon_prev"), F.col("lat_new"), F.col("lon_new"), MEAN_EARTH_RADIUS_KM)
    state = (
        F.when(F.col("_old").isNull(), "alta")
        .when(F.col("_new").isNull(), "baja")
        .when(F.col("lat_prev").isNull() | F.col("lon_prev").isNull(), "coord_nueva_sin_previa")
        .when(F.col("lat_new").isNull() | F.col("lon_new").isNull(), "sin_coord_nueva")
        .when(F.col("delta_km") <= CONFIRMED_KM, "coord_confirmada")
        .otherwise("coord_actualizada")
    )
    return pair.withColumn("delta_km", km).withColumn("estado", state).drop("_old", "_new")


def vintage_summary(compared: DataFrame) -> DataFrame:
    """Rows per state, and how far updated coordinates moved."""
    moved = F.when(F.col("estado") == "coord_actualizada", F.col("delta_km"))
    rows = compared.select("estado", moved.alias("_moved"))
    quantiles = exact_quantiles(rows, ["estado"], "_moved", [0.5, 0.9, 0.99], "_q")
    counts = rows.groupBy("estado").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.coalesce(F.col("_moved") > k, F.lit(False))).alias(f"n_gt_{k}km") for k in (1, 10, 50)],
    )
    return counts.join(quantiles, "estado", "left").withColumns(
        {name: F.round(F.get("_q", F.lit(i)), 4) for i, name in enumerate(("km_p50", "km_p90", "km_p99"))}
    ).drop("_q")


def collapse_schools(rows: DataFrame, key: str = "id_centro") -> DataFrame:
    """One row per school: first known name and point, any private row makes it private,
    a level counts when any row has it."""

    def first(name: str) -> Column:
        known = F.col(name).isNotNull()
        return F.min_by(F.when(known, F.col(name)), F.when(known, F.col("row_seq"))).alias(name)

    return rows.groupBy(key).agg(
        first("nombre_centro"),
        F.when(F.max(flag(F.col("sector") == "Private")) == 1, "Private").otherwise("Public").alias("sector"),
        *[F.max(c).alias(c) for c in ("nivel_primaria", "nivel_secbaja", "nivel_secalta")],
        first("latitud"),
        first("longitud"),
    )


def k12(df: DataFrame) -> DataFrame:
    """Rows with at least one level flag; a missing flag counts as zero."""
    total = sum((F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in ("nivel_primaria", "nivel_secbaja", "nivel_secalta")), F.lit(0))
    return df.filter(total > 0)


def levels_from_services(services: DataFrame, key: str, level: str) -> DataFrame:
    """Level flags from a table of one row per service: codes 2, 3 and 4."""
    return services.filter(F.col(level).isin(2, 3, 4)).groupBy(key).agg(
        *[
            F.max(flag(F.col(level) == code)).alias(name)
            for code, name in ((2, "nivel_primaria"), (3, "nivel_secbaja"), (4, "nivel_secalta"))
        ]
    )


def add_extra_rows(base: DataFrame, extra: DataFrame, key: str = "id_centro") -> DataFrame:
    """Append rows of `extra` whose key is not in `base`."""
    return union_columns(base, extra.join(base.select(key).distinct(), key, "left_anti"))


def school_context(schools: DataFrame, flags: DataFrame, cells: DataFrame, inherit: Sequence[str], pitch: float) -> DataFrame:
    """Schools with the registry flags and the attributes of their grid cell; running it fails
    if a school or its flags occur twice."""
    from access_spark.operators.spatial import lattice_join

    joined = one_to_one_join(schools, flags, ["iso", "id_centro"], "school context")
    return lattice_join(joined, cells, inherit, pitch)


def context_metrics(joined: DataFrame) -> DataFrame:
    """Per country: totals, located schools and schools that found a cell."""
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    matched = F.col("cell_id").isNotNull()
    included = F.coalesce(F.col("include_in_spatial_indicators"), F.lit(False))
    out = joined.groupBy("iso").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(located).alias("n_georef"),
        F.count_if(matched).alias("n_cell_matched"),
        F.count_if(located & ~matched).alias("n_cell_unmatched_georef"),
        F.count_if(included).alias("n_spatial_in"),
        F.count_if(included & matched).alias("n_spatial_in_matched"),
    )
    return out.withColumn(
        "pct_matched_of_georef", percent(F.col("n_cell_matched"), F.greatest(F.col("n_georef"), F.lit(1)))
    )


def k12_summary(joined: DataFrame) -> DataFrame:
    return k12(joined).groupBy("iso").agg(
        F.count(F.lit(1)).alias("n_k12"),
        F.count("lat").alias("n_georef"),
        F.count("cell_id").alias("n_cell_matched"),
    )
