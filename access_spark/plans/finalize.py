"""Registry finalisation: evidence, final label and inclusion flag for every school."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.geo import dms_to_degrees, in_box, looks_swapped
from access_spark.functions.numeric import number
from access_spark.functions.text import blank_null_words, normalize_name
from access_spark.operators import quality, spatial
from access_spark.operators.clusters import with_exact_clusters, with_near_clusters
from access_spark.operators.keyed import keep_first
from access_spark.session import cut_lineage

ADDRESS_COLUMNS = (
    "raw_adm1", "raw_adm2", "qc_raw_adm1", "qc_raw_adm2", "raw_locality", "raw_street",
    "raw_adm1_code", "raw_adm2_code",
)


def promote_backup(df: DataFrame) -> DataFrame:
    """Bring filled coordinates back when a rebuild lost them but the backup columns remain."""
    if not {"latitud_geocoded", "longitud_geocoded", "coordinate_source"} <= set(df.columns):
        return df
    lat, lon = number(F.col("latitud")), number(F.col("longitud"))
    glat, glon = number(F.col("latitud_geocoded")), number(F.col("longitud_geocoded"))
    lost = lat.isNull() | lon.isNull() | ((lat == 0) & (lon == 0))
    kept = glat.isNotNull() & glon.isNotNull() & ~((glat == 0) & (glon == 0))
    use = F.coalesce(F.col("coordinate_source").isin("geocoded", "centroid_cascade") & lost & kept, F.lit(False))
    kind = dict(df.dtypes)
    return df.withColumns(
        {
            "latitud": F.when(use, glat.cast(kind["latitud"])).otherwise(F.col("latitud")),
            "longitud": F.when(use, glon.cast(kind["longitud"])).otherwise(F.col("longitud")),
        }
    )


def normalize_coordinates(df: DataFrame, group: str = "adm0_pcode") -> DataFrame:
    """Coordinates as doubles. A country whose latitudes hold no plain number at all is
    read as degrees, minutes and seconds; the pair (0, 0) becomes null."""
    if dict(df.dtypes)["latitud"] == "string":
        facts = df.groupBy(group).agg(
            (F.count(number(F.col("latitud"))) == 0).alias("_dms")
        )
        dms = F.coalesce(F.col("_dms"), F.lit(False))
        df = df.join(facts, group, "left").withColumns(
            {
                c: F.when(dms, dms_to_degrees(F.col(c))).otherwise(number(F.col(c)))
                for c in ("latitud", "longitud")
            }
        ).drop("_dms")
    zero = F.coalesce((F.col("latitud") == 0) & (F.col("longitud") == 0), F.lit(False))
    clean = {c: F.when(~zero, F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))) for c in ("latitud", "longitud")}
    return df.withColumns(clean)


def with_addresses(df: DataFrame, addresses: DataFrame | None) -> DataFrame:
    """Attach declared places (one row per school); absent columns become ''."""
    stale = [c for c in ADDRESS_COLUMNS if c in df.columns]
    df = df.drop(*stale)
    if addresses is not None:
        keep = [c for c in ADDRESS_COLUMNS if c in addresses.columns]
        df = df.join(addresses.select("adm0_pcode", "id_centro", *keep), ["adm0_pcode", "id_centro"], "left")
    out = {c: (blank_null_words(F.col(c)) if c in df.columns else F.lit("")) for c in ADDRESS_COLUMNS}
    for level in (1, 2):
        if f"qc_raw_adm{level}" not in df.columns:
            out[f"qc_raw_adm{level}"] = out[f"raw_adm{level}"]
    return df.withColumns(out)


def _located(df: DataFrame, boundaries: DataFrame, edges: DataFrame) -> DataFrame:
    """Cover by the country outline and the first unit at both levels, in one pass."""
    lat, lon = F.col("latitud"), F.col("longitud")
    points = df.filter((F.abs(lat) <= 90) & (F.abs(lon) <= 180)).select(
        "adm0_pcode", "_row", "qc_in_bounds", lon.alias("x"), lat.alias("y")
    )
    hits = spatial.polygons_of_points(points, edges, ["adm0_pcode", "_row", "qc_in_bounds"])
    units = boundaries.filter(F.col("level") > 0).select("adm0_pcode", "level", "pcode", "name", "poly_seq")
    named = hits.join(units, ["adm0_pcode", "level", "pcode"], "left")
    unit = F.struct("poly_seq", "pcode", "name")
    usable = F.col("inside") & F.col("qc_in_bounds")
    found = named.groupBy("_row").agg(
        F.max(F.col("level") == 0).alias("_covered"),
        *[F.min(F.when(usable & (F.col("level") == lv), unit)).alias(f"_u{lv}") for lv in (1, 2)],
    )
    return df.join(found, "_row", "left").withColumns(
        {
            "_covered": F.coalesce("_covered", F.lit(False)),
            **{f"_code{lv}": F.col(f"_u{lv}.pcode") for lv in (1, 2)},
            **{f"_name{lv}": F.col(f"_u{lv}.name") for lv in (1, 2)},
        }
    ).drop("_u1", "_u2")


def _rescued(df: DataFrame, boundaries: DataFrame, edges: DataFrame, aliases: Mapping, groups: Mapping) -> DataFrame:
    """Schools just outside every polygon: trust a declared code among the two nearest
    polygons, then a declared name that fits the nearest one within a kilometre."""
    area = F.concat_ws("|", "adm0_pcode", "level").alias("_area")
    polygons = boundaries.filter(F.col("level") > 0).select("adm0_pcode", "level", "pcode", "name", "poly_seq")
    sides = edges.filter(F.col("level") > 0).join(
        polygons.select("adm0_pcode", "level", "pcode", "poly_seq"), ["adm0_pcode", "level", "pcode"]
    ).select("*", area)
    asked = F.array(
        *[
            F.when(
                F.col(f"_code{lv}").isNull(),
                F.struct(
                    F.lit(lv).alias("level"), F.col(f"raw_adm{lv}_code").alias("_declared"),
                    F.col(f"qc_raw_adm{lv}").alias("_raw"), F.col(f"_said{lv}").alias("_a"),
                ),
            )
            for lv in (1, 2)
        ]
    )
    points = (
        df.filter("qc_in_bounds")
        .select("adm0_pcode", "_row", F.col("longitud").alias("x"), F.col("latitud").alias("y"), F.explode(asked).alias("q"))
        .filter("q IS NOT NULL AND (q._declared <> '' OR q._raw <> '')")
        .select("adm0_pcode", "_row", "x", "y", "q.*")
        .select("*", area, F.concat_ws("|", "_row", "level").alias("_ask"))
    )
    points = cut_lineage(points)
    two = spatial.nearest_polygons(points.select("_area", "_ask", "x", "y"), sides.drop("adm0_pcode", "level"), 2, "_ask", "_area")
    near = two.select("_ask", "pcode", "rank").join(points, "_ask").join(
        polygons.drop("poly_seq"), ["adm0_pcode", "level", "pcode"]
    )
    near = cut_lineage(near)
    by_code = near.filter((F.col("_declared") == F.col("pcode")) & (F.col("_declared") != "")).select(
        "_row", "level", F.lit(0).alias("_pick"), "pcode", "name"
    )
    first = near.filter((F.col("rank") == 1) & (F.col("_raw") != "")).withColumn("_b", normalize_name(F.col("name")))
    fits = quality.match_normalized(F.col("_a"), F.col("_b"), F.col("adm0_pcode"), 1, aliases, groups)
    fits2 = quality.match_normalized(F.col("_a"), F.col("_b"), F.col("adm0_pcode"), 2, aliases, groups)
    matching = first.filter(F.when(F.col("level") == 1, fits).otherwise(fits2) == "MATCH")
    km = spatial.distance_to_boundary(matching, edges, ["_row", "level"], ["adm0_pcode", "level", "pcode"])
    by_name = matching.join(km, ["_row", "level"]).filter(F.col("km") <= config.NAME_RESCUE_KM).select(
        "_row", "level", F.lit(1).alias("_pick"), "pcode", "name"
    )
    pick = F.struct("_pick", "pcode", "name")
    choice = by_code.unionByName(by_name).groupBy("_row").agg(
        *[F.min(F.when(F.col("level") == lv, pick)).alias(f"_r{lv}") for lv in (1, 2)]
    )
    return df.join(choice, "_row", "left").withColumns(
        {
            **{f"_code{lv}": F.coalesce(f"_code{lv}", f"_r{lv}.pcode") for lv in (1, 2)},
            **{f"_name{lv}": F.coalesce(f"_name{lv}", f"_r{lv}.name") for lv in (1, 2)},
        }
    ).drop("_r1", "_r2")


def _with_country_codes(edges: DataFrame, codes: DataFrame) -> DataFrame:
    """Outlines carry the boundary layer's own country code; the others the published one."""
    outline = edges.filter(F.col("level") == 0).withColumnRenamed("adm0_pcode", "boundary_code")
    renamed = outline.join(codes.select("boundary_code", "adm0_pcode"), "boundary_code").drop("boundary_code")
    return edges.filter(F.col("level") != 0).unionByName(renamed.select(*edges.columns))


def _with_declared_distance(df: DataFrame, boundaries: DataFrame, edges: DataFrame, aliases: Mapping) -> DataFrame:
    """Distance to the declared polygon, only for rows that mismatch at the policy level."""
    policy = F.col("final_match_level")
    parts = []
    for level, name in ((1, "adm1"), (2, "adm2")):
        wanted = quality.canonical_admin(F.col("adm0_pcode"), F.col(f"_said{level}"), level, aliases)
        parts.append(
            df.filter((policy == name) & (F.col(f"qc_adm{level}_status") == "MISMATCH")).select(
                "_row", "adm0_pcode", F.lit(level).alias("level"), wanted.alias("_norm"),
                F.col("longitud").alias("x"), F.col("latitud").alias("y"),
            )
        )
    points = parts[0].unionByName(parts[1])
    named = keep_first(
        boundaries.select("adm0_pcode", "level", normalize_name(F.col("name")).alias("_norm"), "pcode", "poly_seq"),
        ["adm0_pcode", "level", "_norm"], F.col("poly_seq"),
    ).select("adm0_pcode", "level", "_norm", "pcode")
    targets = points.filter(F.col("_norm") != "").join(named, ["adm0_pcode", "level", "_norm"])
    km = spatial.distance_to_boundary(targets, edges, ["_row"], ["adm0_pcode", "level", "pcode"])
    return df.join(km.withColumnRenamed("km", "qc_distance_to_raw_polygon_km"), "_row", "left")


def _scope(df: DataFrame, outline: DataFrame) -> DataFrame:
    lat, lon = F.col("latitud"), F.col("longitud")
    valid = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    outside = df.filter(valid & ~F.col("_covered")).select("adm0_pcode", "_row", lon.alias("x"), lat.alias("y"))
    # only edges near enough to matter take part: 0.06 degrees exceed 5 km on a meridian,
    # and the square grows with latitude so that the edge nearest in degrees is in it
    wide = 0.06 / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("y")), F.lit(85.0)))), F.lit(0.08))
    size = spatial.CELL_DEGREES
    def cell(c):
        return F.floor(c / size).cast("bigint")
    asked = outside.select(
        "*", F.explode(F.sequence(cell(F.col("x") - wide), cell(F.col("x") + wide))).alias("cx")
    ).select("*", F.explode(F.sequence(cell(F.col("y") - wide), cell(F.col("y") + wide))).alias("cy"))
    sides = outline.select(
        "adm0_pcode", "sx", "sy", "ex", "ey",
        F.explode(F.sequence(cell(F.least("sx", "ex")), cell(F.greatest("sx", "ex")))).alias("cx"),
    ).select("*", F.explode(F.sequence(cell(F.least("sy", "ey")), cell(F.greatest("sy", "ey")))).alias("cy"))
    km = spatial.distance_to_boundary(asked, sides, ["_row"], ["adm0_pcode", "cx", "cy"])
    borders = outline.select("adm0_pcode").distinct().withColumn("_has_border", F.lit(True))
    out = df.join(km.withColumnRenamed("km", "_border"), "_row", "left").join(borders, "adm0_pcode", "left")
    return out.withColumn(
        "qc_scope_class",
        quality.scope_class(
            lat, lon, F.col("qc_in_bounds"), F.col("_has_border"), F.col("_covered"), F.col("_border")
        ),
    ).drop("_covered", "_border", "_has_border")


def finalize(
    registry: DataFrame,
    addresses: DataFrame | None,
    boundaries: DataFrame,
    edges: DataFrame,
    countries: DataFrame,
    border_codes: DataFrame | None = None,
    aliases: Mapping = config.ADMIN_ALIASES,
    groups: Mapping = config.ADMIN_GROUPS,
) -> DataFrame:
    """Label every school of every country in one job; running it again changes nothing.

    `registry` needs adm0_pcode, id_centro and the coordinates and may carry earlier
    evidence. `countries` has adm0_pcode, final_match_level and the box lat_min, lat_max,
    lon_min, lon_max (null for no box). `boundaries`/`edges` hold levels 0, 1 and 2.
    """
    settings = countries.select("adm0_pcode", "final_match_level", "lat_min", "lat_max", "lon_min", "lon_max")
    own = [c for c in registry.columns if c not in ("adm1_pcode", "adm2_pcode") and not c.startswith("qc_")]
    kept = [c for c in ("qc_centroid_bias",) if c in registry.columns]
    df = registry.select(*own, *kept)
    df = normalize_coordinates(promote_backup(df))
    df = df.join(settings, "adm0_pcode", "left")
    box = {c: F.col(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")}
    lat, lon = F.col("latitud"), F.col("longitud")
    has_box = F.col("lat_min").isNotNull()
    df = with_addresses(df, addresses).withColumns(
        {
            "qc_in_bounds": in_box(lat, lon, box),
            "qc_swapped": has_box & looks_swapped(lat, lon, box),
            "_row": F.monotonically_increasing_id(),
        }
    ).drop(*box)
    # row ids must not change when a task is run again, so this table is written once
    df = cut_lineage(df)
    if border_codes is not None:
        edges = _with_country_codes(edges, border_codes)
    df = cut_lineage(_located(df, boundaries, edges))
    df = _scope(df, edges.filter(F.col("level") == 0))
    df = df.withColumns({f"_said{lv}": normalize_name(F.col(f"qc_raw_adm{lv}")) for lv in (1, 2)})
    df = _rescued(df, boundaries, edges, aliases, groups)
    df = df.withColumns({f"_found{lv}": normalize_name(F.col(f"_name{lv}")) for lv in (1, 2)})
    has_coords = lat.isNotNull() & lon.isNotNull()
    policy = F.col("final_match_level")
    statuses: dict[str, Column] = {
        f"qc_adm{lv}_status": quality.admin_status(
            lv, policy, F.col("adm0_pcode"), has_coords, F.col("qc_in_bounds"), F.col(f"_said{lv}"),
            F.col(f"raw_adm{lv}_code"), F.col(f"_found{lv}"), F.col(f"_code{lv}"), aliases, groups,
        )
        for lv in (1, 2)
    }
    df = df.withColumns(
        {
            **statuses,
            "adm1_pcode": F.coalesce("_code1", F.lit("")),
            "adm2_pcode": F.coalesce("_code2", F.lit("")),
            "qc_match_level": quality.match_level(policy),
        }
    ).drop("_code1", "_code2", "_name1", "_name2", "_found1", "_found2")
    df = cut_lineage(df)
    df = _with_declared_distance(df, boundaries, edges, aliases)
    df = with_near_clusters(with_exact_clusters(df))
    source = F.col("coordinate_source") if "coordinate_source" in df.columns else F.lit("")
    bias = F.col("qc_centroid_bias") if "qc_centroid_bias" in df.columns else F.lit("unknown")
    df = df.withColumn("_src", quality.canonical_source(source, bias, lat, lon)).withColumns(
        {
            "coordinate_source": F.col("_src.coordinate_source"),
            "qc_centroid_bias": F.col("_src.qc_centroid_bias"),
        }
    ).drop("_src")
    ev = quality.evidence(set(df.columns))
    df = df.withColumn("_q", quality.coordinate_quality(ev, policy))
    df = df.withColumns(
        {
            "coordinate_quality": F.col("_q.label"),
            "coordinate_quality_reason": F.col("_q.reason"),
            "include_in_spatial_indicators": quality.inclusion_policy(
                F.col("qc_scope_class"), F.col("_q.label"), F.col("qc_adm1_status")
            ),
            "qc_cluster_diff_addr_50m": F.lit(None).cast("boolean"),
            "qc_evidence_version": F.lit(config.EVIDENCE_VERSION),
        }
    )
    return conform(df, config.ENRICHED_COLUMNS)


def conform(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Exactly the contract's columns, in order; absent ones are null."""
    return df.select(
        *[
            (F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c)
            for c, t in contract.items()
        ]
    )
