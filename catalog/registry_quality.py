"""Queries on coordinate evidence, quality labels and shared points."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from access_spark.operators import clusters, quality, spatial
from access_spark.plans import finalize
from access_spark.session import shared_dir
from access_spark.sources import geojson
from catalog.domain import Tables, with_views
from catalog.registry import query

# Independent statement of the labels. Boxes are 4 degrees wide and each is cut by its
# diagonal, so containment is arithmetic here while Spark uses the edge table.
NAMED = "trim(regexp_replace(lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')), '\\s+', ' ', 'g'))"


def _foot_km(seg: str, px: str = "x", py: str = "y") -> str:
    """Squared degree distance and kilometres from (px, py) to a segment (sx, sy, ex, ey)."""
    t = (
        f"greatest(0e0, least(1e0, (({px}-sx)*(ex-sx)+({py}-sy)*(ey-sy))"
        f"/((ex-sx)*(ex-sx)+(ey-sy)*(ey-sy))))"
    )
    return f"""SELECT *, ({px}-fx)*({px}-fx)+({py}-fy)*({py}-fy) AS d2,
      2*6371.0*asin(sqrt(least(1e0, pow(sin(radians(fy-{py})/2),2)
        + cos(radians({py}))*cos(radians(fy))*pow(sin(radians(fx-{px})/2),2)))) AS km
      FROM (SELECT *, sx + {t}*(ex-sx) AS fx, sy + {t}*(ey-sy) AS fy FROM ({seg}))"""


FINAL = (
    """
    s0 AS (
      SELECT s.*, c.final_match_level AS policy, c.lat_min, c.lat_max, c.lon_min, c.lon_max, c.rk,
        CASE WHEN s.coordinate_source IN ('geocoded', 'centroid_cascade')
          AND (s.latitud IS NULL OR s.longitud IS NULL OR (s.latitud = 0 AND s.longitud = 0))
          AND s.latitud_geocoded IS NOT NULL THEN s.latitud_geocoded ELSE s.latitud END AS la0,
        CASE WHEN s.coordinate_source IN ('geocoded', 'centroid_cascade')
          AND (s.latitud IS NULL OR s.longitud IS NULL OR (s.latitud = 0 AND s.longitud = 0))
          AND s.latitud_geocoded IS NOT NULL THEN s.longitud_geocoded ELSE s.longitud END AS lo0,
        a.raw_adm1, CASE WHEN a.raw_adm2 = 'nan' THEN '' ELSE a.raw_adm2 END AS raw_adm2,
        a.raw_adm1_code, a.raw_adm2_code, a.raw_locality, a.raw_street
      FROM {school} s JOIN {country} c ON c.iso = s.adm0_pcode JOIN {address} a USING (id_centro)),
    s1 AS (
      SELECT *, CASE WHEN la0 = 0 AND lo0 = 0 THEN NULL ELSE la0 END AS y,
        CASE WHEN la0 = 0 AND lo0 = 0 THEN NULL ELSE lo0 END AS x FROM s0),
    s2 AS (
      SELECT *, coalesce(y BETWEEN lat_min AND lat_max AND x BETWEEN lon_min AND lon_max, FALSE) AS inb
      FROM s1),
    s3 AS (
      SELECT *, NOT inb AND coalesce(y BETWEEN lon_min AND lon_max AND x BETWEEN lat_min AND lat_max, FALSE) AS swapped
      FROM s2),
    cov AS (SELECT DISTINCT id_centro FROM s3 JOIN {corner} b ON b.iso = adm0_pcode
      WHERE x BETWEEN b.x0 AND b.x1 AND y BETWEEN b.y0 AND b.y1),
    borderseg AS (
      SELECT s3.id_centro, s3.x, s3.y, e.sx, e.sy, e.ex, e.ey FROM s3
      JOIN {edge} e ON e.adm0_pcode = s3.adm0_pcode AND e.level = 0
      WHERE abs(y) <= 90 AND abs(x) <= 180 AND id_centro NOT IN (SELECT id_centro FROM cov)),
    border AS (SELECT id_centro, arg_min(km, d2) AS km FROM ("""
    + _foot_km("SELECT * FROM borderseg")
    + """) GROUP BY 1),
    s4 AS (
      SELECT s3.*,
        CASE WHEN y IS NULL OR x IS NULL THEN 'missing'
          WHEN abs(y) > 90 OR abs(x) > 180 THEN 'invalid_numeric'
          WHEN cov.id_centro IS NOT NULL THEN CASE WHEN inb THEN 'inside_mainland_bbox' ELSE 'remote_territory_or_island' END
          WHEN border.km <= 5 THEN 'near_border_review' ELSE 'outside_country' END AS scope
      FROM s3 LEFT JOIN cov USING (id_centro) LEFT JOIN border USING (id_centro)),
    at1 AS (SELECT id_centro, arg_min('N' || b.nk, b.nk) AS code, arg_min(b.n_name, b.nk) AS name FROM s4
      JOIN {corner} k ON k.iso = adm0_pcode AND x > k.x0 AND x < k.x1 AND y > k.y0 AND y < k.y1
      JOIN {box} b ON b.nk = k.nk WHERE inb GROUP BY 1),
    at2 AS (SELECT id_centro,
        arg_min('N' || b.nk || CASE WHEN y - k.y0 < x - k.x0 THEN 'E' ELSE 'W' END, b.nk) AS code,
        arg_min(b.n_name || CASE WHEN y - k.y0 < x - k.x0 THEN ' East' ELSE ' West' END, b.nk) AS name FROM s4
      JOIN {corner} k ON k.iso = adm0_pcode AND x > k.x0 AND x < k.x1 AND y > k.y0 AND y < k.y1
        AND (y - k.y0) <> (x - k.x0)
      JOIN {box} b ON b.nk = k.nk WHERE inb GROUP BY 1),
    lost AS (
      SELECT s4.*, 1 AS lv, raw_adm1_code AS rc, raw_adm1 AS rn FROM s4 WHERE inb AND id_centro NOT IN (SELECT id_centro FROM at1)
      UNION ALL
      SELECT s4.*, 2, raw_adm2_code, raw_adm2 FROM s4 WHERE inb AND id_centro NOT IN (SELECT id_centro FROM at2)),
    lostseg AS (SELECT l.id_centro, l.lv, l.x, l.y, l.rc, l.rn, e.pcode, p.name, p.poly_seq, e.sx, e.sy, e.ex, e.ey
      FROM lost l JOIN {edge} e ON e.adm0_pcode = l.adm0_pcode AND e.level = l.lv
      JOIN {boundary} p ON p.pcode = e.pcode AND p.level = e.level),
    lostpoly AS (SELECT id_centro, lv, rc, rn, pcode, name, poly_seq, min(d2) AS d2, arg_min(km, d2) AS km
      FROM ("""
    + _foot_km("SELECT * FROM lostseg")
    + """) GROUP BY ALL),
    lostrank AS (SELECT *, row_number() OVER (PARTITION BY id_centro, lv ORDER BY d2, poly_seq) AS rk FROM lostpoly),
    rescue AS (
      SELECT id_centro, lv, arg_min(pcode, pick) AS code, arg_min(name, pick) AS name FROM (
        SELECT id_centro, lv, 0 AS pick, pcode, name FROM lostrank WHERE rk <= 2 AND rc <> '' AND rc = pcode
        UNION ALL
        SELECT id_centro, lv, 1, pcode, name FROM lostrank WHERE rk = 1 AND rn <> '' AND km <= 1
          AND (contains(lower(name), lower(rn)) OR contains(lower(rn), lower(name)))) GROUP BY 1, 2),
    s5 AS (
      SELECT s4.*, coalesce(at1.code, r1.code, '') AS c1, coalesce(at1.name, r1.name, '') AS n1,
        coalesce(at2.code, r2.code, '') AS c2, coalesce(at2.name, r2.name, '') AS n2
      FROM s4 LEFT JOIN at1 USING (id_centro) LEFT JOIN at2 USING (id_centro)
      LEFT JOIN (SELECT * FROM rescue WHERE lv = 1) r1 USING (id_centro)
      LEFT JOIN (SELECT * FROM rescue WHERE lv = 2) r2 USING (id_centro)),
    s6 AS (
      SELECT *,
        CASE WHEN policy = 'bbox_only' THEN 'NOT_RUN'
          WHEN policy = 'spatial_only' THEN CASE WHEN n1 <> '' THEN 'MATCH' WHEN x IS NULL OR y IS NULL THEN 'NO_DATA' ELSE 'NO_POLYGON' END
          WHEN x IS NULL OR y IS NULL THEN 'NO_DATA' WHEN NOT inb THEN 'NOT_RUN' WHEN n1 = '' THEN 'NO_POLYGON'
          WHEN raw_adm1_code <> '' AND c1 <> '' THEN CASE WHEN raw_adm1_code = c1 THEN 'MATCH' ELSE 'MISMATCH' END
          WHEN raw_adm1 = '' THEN 'NO_RAW_ADM'
          WHEN contains(lower(n1), lower(raw_adm1)) OR contains(lower(raw_adm1), lower(n1)) THEN 'MATCH' ELSE 'MISMATCH' END AS st1,
        CASE WHEN policy IN ('bbox_only', 'spatial_only') THEN 'NOT_RUN'
          WHEN x IS NULL OR y IS NULL THEN 'NO_DATA' WHEN NOT inb THEN 'NOT_RUN' WHEN n2 = '' THEN 'NO_POLYGON'
          WHEN raw_adm2_code <> '' AND c2 <> '' THEN CASE WHEN raw_adm2_code = c2 THEN 'MATCH' ELSE 'MISMATCH' END
          WHEN raw_adm2 = '' THEN 'NO_RAW_ADM'
          WHEN contains(lower(n2), lower(raw_adm2)) OR contains(lower(raw_adm2), lower(n2)) THEN 'MATCH' ELSE 'MISMATCH' END AS st2
      FROM s5),
    declared AS (
      SELECT id_centro, arg_min(km, d2) AS km FROM ("""
    + _foot_km(
        """SELECT s6.id_centro, s6.x, s6.y, e.sx, e.sy, e.ex, e.ey FROM s6
        JOIN {boundary} p ON p.adm0_pcode = s6.adm0_pcode AND p.level = CASE policy WHEN 'adm2' THEN 2 ELSE 1 END
          AND lower(p.name) = lower(CASE policy WHEN 'adm2' THEN raw_adm2 ELSE raw_adm1 END)
        JOIN {edge} e ON e.pcode = p.pcode AND e.level = p.level AND e.adm0_pcode = p.adm0_pcode
        WHERE (policy = 'adm2' AND st2 = 'MISMATCH') OR (policy = 'adm1' AND st1 = 'MISMATCH')"""
    )
    + """) GROUP BY 1),
    s7 AS (
      SELECT s6.*, declared.km AS polygon_km, round_even(x, 5) AS xr, round_even(y, 5) AS yr,
        coalesce(x <> 0 AND y <> 0, FALSE) AS usable,
        lower(raw_street || '|' || raw_adm2 || '|' || raw_locality) AS addr
      FROM s6 LEFT JOIN declared USING (id_centro)),
    points AS (
      SELECT adm0_pcode, xr, yr, count(*) FILTER (usable) AS n, count(DISTINCT addr) > 1 AS diff_addr,
        count(DISTINCT lower(raw_adm1)) FILTER (raw_adm1 <> '') > 1 OR count(DISTINCT lower(raw_adm2)) FILTER (raw_adm2 <> '') > 1
          OR count(DISTINCT lower(raw_locality)) FILTER (raw_locality <> '') > 1 AS diff_place,
        min(polygon_km) FILTER (usable) AS edge_km
      FROM s7 WHERE xr IS NOT NULL AND yr IS NOT NULL GROUP BY ALL),
    bins AS (SELECT adm0_pcode, round_even(x / (50e0 / 111320e0), 0) AS binx, round_even(y / (50e0 / 111320e0), 0) AS biny, count(*) AS n
      FROM s7 WHERE usable GROUP BY ALL),
    s8 AS (
      SELECT s7.*, CASE WHEN usable THEN coalesce(p.n, 0) ELSE 0 END AS size5,
        coalesce(p.diff_addr, FALSE) AS diff_addr, coalesce(p.diff_place, FALSE) AS diff_place,
        usable AND coalesce(p.n = 2 AND p.edge_km < 5, FALSE) AS rescue2,
        CASE WHEN usable THEN coalesce(b.n, 0) ELSE 0 END AS size50,
        CASE WHEN coordinate_source = '' THEN CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 'original' ELSE '' END
          WHEN coordinate_source = 'adm3_centroid_large' THEN 'centroid_cascade'
          WHEN coordinate_source = 'survey' THEN CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 'original' ELSE '' END
          ELSE coordinate_source END AS src,
        CASE WHEN coordinate_source = 'adm3_centroid_large' THEN 'high' ELSE 'unknown' END AS bias
      FROM s7 LEFT JOIN points p ON p.adm0_pcode = s7.adm0_pcode AND p.xr = s7.xr AND p.yr = s7.yr
      LEFT JOIN bins b ON b.adm0_pcode = s7.adm0_pcode AND s7.usable
        AND b.binx = round_even(s7.x / (50e0 / 111320e0), 0) AND b.biny = round_even(s7.y / (50e0 / 111320e0), 0)),
    s9 AS (
      SELECT *, coalesce(polygon_km < 5, FALSE) AND src = 'original' AND coalesce(geocode_distance_km < 5, FALSE) AS zone,
        acceptance = 'FLAG' AND (geocode_precision IN ('street', 'centroid')
          OR (geo_adm2_check = 'MATCH' AND orig_adm2_check = 'MISMATCH') OR coalesce(geocode_distance_km >= 10, FALSE)) AS strong
      FROM s8),
    s10 AS (
      SELECT *, CASE WHEN NOT usable THEN 'missing|missing' WHEN swapped THEN 'swapped|swapped' WHEN NOT inb THEN 'out_of_bounds|bbox'
        WHEN policy = 'adm2' AND st2 = 'MISMATCH' THEN CASE WHEN zone THEN 'boundary_zone|boundary_zone_<5km' ELSE 'adm_mismatch|adm2_mismatch' END
        WHEN policy = 'adm1' AND st1 = 'MISMATCH' THEN 'adm_mismatch|adm1_mismatch'
        WHEN policy = 'adm2' AND st1 = 'MISMATCH' THEN CASE WHEN zone THEN 'boundary_zone|boundary_zone_<5km' ELSE 'adm_mismatch|adm1_mismatch' END
        WHEN src = 'original' AND size5 >= 5 THEN 'cluster_centroid|cluster_ge5'
        WHEN src = 'original' AND size5 IN (3, 4) AND diff_place THEN 'cluster_centroid|cluster_3_4_diff_admin_locality'
        WHEN src = 'original' AND size5 = 2 AND diff_place AND NOT rescue2 THEN 'cluster_centroid|cluster_2_diff_admin_locality'
        WHEN strong THEN 'geocoder_disagrees|geocoder_compare'
        WHEN src = 'geocoded' AND geocode_precision = 'street' THEN 'geocoded_street|fill_street'
        WHEN src IN ('geocoded', 'centroid_cascade') THEN 'geocoded_centroid|fill_centroid'
        WHEN ((policy = 'adm2' AND st2 = 'MATCH') OR (policy = 'adm1' AND st1 = 'MATCH')) AND src = 'original' AND size5 < 5 THEN 'gps_validated|validated'
        WHEN acceptance = 'FLAG' THEN 'gps_unverified|geocoder_low_confidence' ELSE 'gps_unverified|default_unverified' END AS verdict
      FROM s9),
    final AS (
      SELECT *, split_part(verdict, '|', 1) AS label, split_part(verdict, '|', 2) AS reason FROM s10),
    labelled AS (
      SELECT *, CASE WHEN scope IN ('missing', 'invalid_numeric', 'outside_country') THEN FALSE
        WHEN label IN ('missing', 'swapped') THEN FALSE WHEN label IN ('geocoded_street', 'boundary_zone') THEN TRUE
        WHEN label IN ('geocoded_centroid', 'cluster_centroid') THEN NULL
        WHEN scope = 'near_border_review' THEN CASE WHEN label IN ('adm_mismatch', 'geocoder_disagrees', 'out_of_bounds') THEN NULL
          WHEN label = 'gps_validated' OR st1 = 'MATCH' THEN TRUE ELSE NULL END
        WHEN label IN ('adm_mismatch', 'geocoder_disagrees') THEN NULL
        WHEN scope IN ('inside_mainland_bbox', 'remote_territory_or_island') THEN TRUE ELSE FALSE END AS include
      FROM final)"""
)


def countries_of(t: Tables):
    return t.country.select(
        F.col("iso").alias("adm0_pcode"), "final_match_level", "lat_min", "lat_max", "lon_min", "lon_max"
    )


def finalized(t: Tables):
    return finalize.finalize(t.school.drop("row_seq"), t.address, t.boundary, t.edge, countries_of(t))


@query(
    "finalized_registry",
    with_views(
        "WITH " + FINAL.strip() + """
        SELECT id_centro, adm0_pcode, round(y, 6) AS latitud, round(x, 6) AS longitud, c1 AS adm1_pcode, c2 AS adm2_pcode,
          inb AS qc_in_bounds, swapped AS qc_swapped, scope AS qc_scope_class, st1 AS qc_adm1_status, st2 AS qc_adm2_status,
          CASE policy WHEN 'adm2' THEN 'ADM2' WHEN 'adm1' THEN 'ADM1' WHEN 'spatial_only' THEN 'SPATIAL_ONLY' ELSE 'NONE' END AS qc_match_level,
          round(polygon_km, 6) AS qc_distance_to_raw_polygon_km, size5 AS qc_cluster_size_exact,
          diff_addr AS qc_cluster_diff_addr_exact, size50 AS qc_cluster_size_50m, diff_place AS qc_cluster_diff_admin_locality,
          rescue2 AS qc_n2_frontier_rescue, src AS coordinate_source, bias AS qc_centroid_bias, label AS coordinate_quality,
          reason AS coordinate_quality_reason, include AS include_in_spatial_indicators
        FROM labelled"""
    ),
)
def _finalized(t: Tables):
    return finalized(t).select(
        "id_centro", "adm0_pcode", F.round("latitud", 6).alias("latitud"), F.round("longitud", 6).alias("longitud"),
        "adm1_pcode", "adm2_pcode", "qc_in_bounds", "qc_swapped", "qc_scope_class", "qc_adm1_status", "qc_adm2_status",
        "qc_match_level", F.round("qc_distance_to_raw_polygon_km", 6).alias("qc_distance_to_raw_polygon_km"),
        "qc_cluster_size_exact", "qc_cluster_diff_addr_exact", "qc_cluster_size_50m", "qc_cluster_diff_admin_locality",
        "qc_n2_frontier_rescue", "coordinate_source", "qc_centroid_bias", "coordinate_quality",
        "coordinate_quality_reason", "include_in_spatial_indicators",
    )


# ---- single operators ------------------------------------------------------------------------


@query(
    "point_in_polygon_with_holes",
    with_views(
        """
        WITH pts AS (SELECT id_centro, adm0_pcode, latitud - k.y0 AS y, longitud - k.x0 AS x, k.nk FROM {school} JOIN {corner} k ON k.iso = adm0_pcode WHERE latitud IS NOT NULL AND longitud IS NOT NULL)
        SELECT id_centro, 'N' || nk AS pcode FROM pts
        WHERE x > 0 AND x < 4 AND y > 0 AND y < 4 AND NOT (x BETWEEN 1 AND 2.5 AND y BETWEEN 0.5 AND 2)"""
    ),
)
def _holes(t: Tables):
    """Boundaries from a GeoJSON file: features cut out in parallel, rings with holes to edges."""
    box = lambda a, b, c, d: F.array(*[F.array(F.col("x0") + x, F.col("y0") + y) for x, y in ((a, b), (c, b), (c, d), (a, d), (a, b))])
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.col("iso").alias("country"), F.concat(F.lit("N"), F.col("nk").cast("string")).alias("code"), F.lit('a "}" in a name').alias("name")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(box(0.0, 0.0, 4.0, 4.0), box(1.0, 0.5, 2.5, 2.0)).alias("coordinates")).alias("geometry"),
    )
    path = f"{shared_dir(t.spark)}/boundaries-{uuid.uuid4().hex}"
    body = t.corner.select(F.col("nk").cast("bigint").alias("n"), F.to_json(feature).alias("value"))
    first = F.lag("n").over(Window.orderBy("n")).isNull()  # a boundary file: one row per unit
    body = body.select("n", F.concat(F.when(first, "").otherwise(","), "value").alias("value"))
    ends = t.spark.createDataFrame([(-1, '{"type": "FeatureCollection", "features": ['), (1 << 40, "]}")], "n long, value string")
    body.union(ends).coalesce(1).sortWithinPartitions("n").select("value").write.text(path)
    rings = geojson.ring_edges(geojson.read_features(t.spark, path, "country: string, code: string"))
    edges = rings.select(F.lit(2).alias("level"), F.col("properties.country").alias("adm0_pcode"), F.col("properties.code").alias("pcode"), "row_seq", "sx", "sy", "ex", "ey")
    polygons = edges.select("level", "adm0_pcode", "pcode", F.col("row_seq").alias("poly_seq")).distinct()
    points = t.school.select("id_centro", "adm0_pcode", F.col("longitud").alias("x"), F.col("latitud").alias("y"))
    return spatial.locate(points, polygons, edges.drop("row_seq"), ["id_centro"], ("pcode",)).select("id_centro", "pcode")


@query(
    "point_in_polygon",
    with_views(
        """
        WITH pts AS (SELECT id_centro, adm0_pcode, latitud AS y, longitud AS x FROM {school} WHERE latitud IS NOT NULL AND longitud IS NOT NULL)
        SELECT id_centro, 'N' || k.nk || CASE WHEN y - k.y0 < x - k.x0 THEN 'E' ELSE 'W' END AS pcode
        FROM pts JOIN {corner} k ON k.iso = adm0_pcode AND x > k.x0 AND x < k.x1 AND y > k.y0 AND y < k.y1
          AND (y - k.y0) <> (x - k.x0)"""
    ),
)
def _pip(t: Tables):
    points = t.school.select("id_centro", "adm0_pcode", F.col("longitud").alias("x"), F.col("latitud").alias("y"))
    polygons = t.boundary.filter("level = 2")
    found = spatial.locate(points, polygons, t.edge.filter("level = 2"), ["id_centro"], ("pcode",))
    return found.select("id_centro", "pcode")


@query(
    "country_cover",
    with_views(
        """
        SELECT DISTINCT id_centro FROM {school} JOIN {corner} b ON b.iso = adm0_pcode
        WHERE longitud BETWEEN b.x0 AND b.x1 AND latitud BETWEEN b.y0 AND b.y1"""
    ),
)
def _cover(t: Tables):
    points = t.school.select("id_centro", "adm0_pcode", F.col("longitud").alias("x"), F.col("latitud").alias("y"))
    return spatial.covered_by_country(points, t.edge.filter("level = 0"), ["id_centro"])


@query(
    "distance_to_declared_polygon",
    with_views(
        "SELECT id_centro, round(arg_min(km, d2), 6) AS km FROM ("
        + _foot_km(
            """SELECT s.id_centro, s.longitud AS x, s.latitud AS y, e.sx, e.sy, e.ex, e.ey
            FROM {school} s JOIN {school_base} b ON b.k = s.row_seq
            JOIN {edge} e ON e.level = 2 AND e.pcode = 'N' || b.nk || CASE WHEN b.off_lat < b.off_lon THEN 'E' ELSE 'W' END
            WHERE s.latitud IS NOT NULL AND s.longitud IS NOT NULL"""
        )
        + ") GROUP BY 1"
    ),
)
def _declared(t: Tables):
    named = t.school_base.select(
        F.col("k").alias("row_seq"),
        F.concat(F.lit("N"), F.col("nk").cast("string"), F.when(F.col("off_lat") < F.col("off_lon"), "E").otherwise("W")).alias("pcode"),
    )
    points = (
        t.school.filter("latitud IS NOT NULL AND longitud IS NOT NULL")
        .join(named, "row_seq")
        .select("id_centro", "pcode", F.col("longitud").alias("x"), F.col("latitud").alias("y"))
    )
    km = spatial.distance_to_boundary(points, t.edge.filter("level = 2"), ["id_centro"], ["pcode"])
    return km.select("id_centro", F.round("km", 6).alias("km"))


@query(
    "two_nearest_polygons",
    with_views(
        """WITH pts AS (SELECT id_centro, adm0_pcode, latitud AS y, longitud AS x FROM {school}
          WHERE latitud IS NOT NULL AND longitud IS NOT NULL),
        d AS (SELECT id_centro, pcode, poly_seq, min(d2) AS d2 FROM ("""
        + _foot_km(
            """SELECT p.id_centro, p.x, p.y, e.pcode, b.poly_seq, e.sx, e.sy, e.ex, e.ey FROM pts p
            JOIN {edge} e ON e.level = 1 AND e.adm0_pcode = p.adm0_pcode JOIN {boundary} b ON b.level = 1 AND b.pcode = e.pcode"""
        )
        + """) GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY id_centro ORDER BY d2, poly_seq) AS rank FROM d)
        SELECT id_centro, pcode, rank, round(sqrt(d2), 6) AS degrees FROM r WHERE rank <= 2"""
    ),
)
def _two_polygons(t: Tables):
    points = t.school.filter("latitud IS NOT NULL AND longitud IS NOT NULL").select(
        "adm0_pcode", "id_centro", F.col("longitud").alias("x"), F.col("latitud").alias("y")
    )
    polygons = t.boundary.filter("level = 1").select("pcode", "poly_seq")
    sides = t.edge.filter("level = 1").join(polygons, "pcode")
    near = spatial.nearest_polygons(points, sides, 2, "id_centro")
    return near.select("id_centro", "pcode", "rank", F.round(F.sqrt("d2"), 6).alias("degrees"))


def order_points(t: Tables):
    """Orders as schools that share few points, with address parts."""
    pid = F.col("o_custkey") % 50
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("id_centro"), F.lit("TST").alias("adm0_pcode"),
        F.concat(F.lit("A"), (pid % 4).cast("string")).alias("adm1_pcode"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(0.0)).otherwise(pid / 8.0).alias("latitud"),
        F.when(F.col("o_orderkey") % 13 != 0, pid / 16.0 + 1).alias("longitud"),
        F.col("o_orderpriority").alias("raw_street"), F.col("o_orderstatus").alias("raw_adm1"),
        F.when(F.col("o_orderkey") % 3 == 0, "nan").otherwise(F.col("o_orderstatus")).alias("raw_adm2"),
        F.lit("x").alias("raw_locality"),
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") / 1e5).alias("qc_distance_to_raw_polygon_km"),
    )


ORDER_POINTS = """
    op AS (SELECT cast(o_orderkey AS string) AS id_centro, 'A' || (o_custkey % 50 % 4) AS adm1_pcode,
      CASE WHEN o_orderkey % 11 = 0 THEN 0e0 ELSE (o_custkey % 50) / 8e0 END AS la,
      CASE WHEN o_orderkey % 13 <> 0 THEN (o_custkey % 50) / 16e0 + 1 END AS lo,
      o_orderpriority AS street, o_orderstatus AS a1, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS a2,
      CASE WHEN o_orderkey % 3 = 0 THEN 'nan' ELSE o_orderstatus END AS a2raw,
      CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice / 1e5 END AS km FROM {orders})"""


@query(
    "shared_point_evidence",
    with_views(
        "WITH " + ORDER_POINTS.strip() + """,
        f AS (SELECT la, lo, count(*) FILTER (la <> 0 AND lo <> 0) AS n,
          count(DISTINCT lower(street || '|' || a2raw || '|x')) > 1 AS da,
          count(DISTINCT a1) > 1 OR count(DISTINCT nullif(a2, '')) > 1 AS dp,
          min(km) FILTER (la <> 0 AND lo <> 0) AS km FROM op WHERE la IS NOT NULL AND lo IS NOT NULL GROUP BY 1, 2)
        SELECT id_centro, CASE WHEN op.la <> 0 AND op.lo <> 0 THEN f.n ELSE 0 END AS qc_cluster_size_exact,
          coalesce(da, FALSE) AS qc_cluster_diff_addr_exact, coalesce(dp, FALSE) AS qc_cluster_diff_admin_locality,
          coalesce(op.la <> 0 AND op.lo <> 0 AND f.n = 2 AND f.km < 5, FALSE) AS qc_n2_frontier_rescue,
          CASE WHEN op.la <> 0 AND op.lo <> 0 THEN f.n ELSE 0 END AS qc_cluster_size_50m
        FROM op LEFT JOIN f ON f.la = op.la AND f.lo = op.lo"""
    ),
)
def _shared(t: Tables):
    out = clusters.with_near_clusters(clusters.with_exact_clusters(order_points(t)))
    return out.select(
        "id_centro", "qc_cluster_size_exact", "qc_cluster_diff_addr_exact", "qc_cluster_diff_admin_locality",
        "qc_n2_frontier_rescue", "qc_cluster_size_50m",
    )


@query(
    "shared_point_report",
    with_views(
        "WITH " + ORDER_POINTS.strip() + """,
        f AS (SELECT la, lo, count(*) AS n, count(DISTINCT lower(street || '|' || a2raw || '|x')) > 1 AS da
          FROM op WHERE la IS NOT NULL AND lo IS NOT NULL GROUP BY 1, 2)
        SELECT id_centro, n AS n_schools, da AS diff_addr FROM op JOIN f USING (la, lo) WHERE n > 1"""
    ),
)
def _shared_report(t: Tables):
    return clusters.shared_point_report(order_points(t)).select("id_centro", "n_schools", "diff_addr")


@query(
    "shared_point_summary",
    with_views(
        "WITH " + ORDER_POINTS.strip() + """,
        f AS (SELECT la, lo, count(*) AS n, count(DISTINCT lower(street || '|' || a2raw || '|x')) > 1 AS da
          FROM op WHERE la IS NOT NULL AND lo IS NOT NULL GROUP BY 1, 2),
        s AS (SELECT cast(sum(n) AS bigint) AS n_with_coords, cast(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS bigint) AS dup_coord_schools,
          cast(sum(CASE WHEN n > 1 AND da THEN n ELSE 0 END) AS bigint) AS dup_diff_addr,
          cast(sum(CASE WHEN n >= 5 THEN n ELSE 0 END) AS bigint) AS dup_ge5_schools FROM f)
        SELECT 'TST' AS adm0_pcode, *, round(100e0 * dup_coord_schools / n_with_coords, 1) AS dup_coord_pct,
          round(100e0 * dup_diff_addr / n_with_coords, 1) AS dup_diff_addr_pct,
          round(100e0 * dup_ge5_schools / n_with_coords, 1) AS dup_ge5_pct FROM s"""
    ),
)
def _shared_summary(t: Tables):
    return clusters.shared_point_summary(order_points(t))


@query(
    "cluster_size_distribution",
    with_views(
        "WITH " + ORDER_POINTS.strip() + """,
        f AS (SELECT la, lo, count(*) AS n FROM op WHERE la <> 0 AND lo <> 0 GROUP BY 1, 2 HAVING count(*) >= 5)
        SELECT 'TST' AS adm0_pcode, CASE WHEN n < 10 THEN '5-9' WHEN n < 20 THEN '10-19' WHEN n < 50 THEN '20-49'
          WHEN n < 100 THEN '50-99' WHEN n < 500 THEN '100-499' WHEN n < 1000 THEN '500-999' ELSE '1000+' END AS size_band,
          count(*) AS n_clusters, cast(sum(n) AS bigint) AS n_schools, median(n) AS median_size, round(avg(n), 4) AS mean_size,
          max(n) AS max_size FROM f GROUP BY ALL"""
    ),
)
def _distribution(t: Tables):
    return clusters.cluster_size_distribution(order_points(t))


@query(
    "centroid_concentration",
    with_views(
        "WITH " + ORDER_POINTS.strip() + """,
        f AS (SELECT adm1_pcode, la, lo, count(*) AS n FROM op WHERE la <> 0 AND lo <> 0 GROUP BY ALL HAVING count(*) >= 5),
        u AS (SELECT adm1_pcode, cast(sum(n) AS bigint) AS n_schools, max(n) AS largest_point FROM f GROUP BY 1)
        SELECT 'TST' AS adm0_pcode, *, round(100e0 * n_schools / (SELECT sum(n_schools) FROM u), 1) AS pct_of_country FROM u"""
    ),
)
def _concentration(t: Tables):
    return clusters.centroid_concentration(order_points(t))


@query(
    "geocode_targets",
    with_views(
        "WITH " + FINAL.strip() + """,
        anyd AS (SELECT adm0_pcode, bool_or(diff_addr) AS a FROM labelled GROUP BY 1)
        SELECT id_centro, y IS NULL OR x IS NULL AS missing, coalesce(y = 0 OR x = 0, FALSE) AS zeros,
          NOT inb AND usable AS out_of_bounds, st1 = 'MISMATCH' OR st2 = 'MISMATCH' AS mismatches, diff_addr AS dup_addr,
          size5 >= 5 AND (NOT a OR diff_addr) AS centroids, a AS centroids_address_filtered
        FROM labelled JOIN anyd USING (adm0_pcode)"""
    ),
)
def _targets(t: Tables):
    return clusters.geocode_targets(finalized(t)).select(
        "id_centro", "missing", "zeros", "out_of_bounds", "mismatches", "dup_addr", "centroids", "centroids_address_filtered"
    )
