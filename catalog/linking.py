"""Queries on registry linkage, table maintenance and the school base."""

from __future__ import annotations

from pyspark.sql import functions as F

from access_spark import config
from access_spark.operators import keyed, linkage
from access_spark.sources import tables
from catalog.domain import Tables, with_views
from catalog.registry import query

DUPLICATED = """
    SELECT l_orderkey AS id, l_linenumber AS seq, l_returnflag, l_quantity, l_partkey FROM lineitem"""


@query(
    "first_and_last_rows",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS a,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS z FROM lineitem)
      SELECT 'first' AS which, l_orderkey, l_linenumber, l_partkey FROM r WHERE a = 1
      UNION ALL SELECT 'last', l_orderkey, l_linenumber, l_partkey FROM r WHERE z = 1""",
)
def _first_last(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    first = keyed.keep_first(rows, ["l_orderkey"], order).withColumn("which", F.lit("first"))
    last = keyed.keep_last(rows, ["l_orderkey"], order).withColumn("which", F.lit("last"))
    return first.unionByName(last).drop("l_suppkey")


@query(
    "row_numbers_by_group",
    "SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS n FROM part",
)
def _numbers(t: Tables):
    return keyed.number_rows(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size", "p_partkey", "n").drop("p_size")


@query(
    "cell_numbers",
    with_views("SELECT iso, row, col, row_number() OVER (PARTITION BY iso ORDER BY row, col) - 1 AS cell_number FROM {grid}"),
)
def _cell_numbers(t: Tables):
    return keyed.number_rows(t.grid.select("iso", "row", "col"), ["iso"], "row", "col", "cell_number", start=0)


@query(
    "ledger_latest",
    with_views(
        """SELECT iso, id_centro, run_seq, target_type, acceptance, score FROM (
          SELECT *, row_number() OVER (PARTITION BY iso, id_centro ORDER BY run_seq DESC) AS rn FROM {ledger}) WHERE rn = 1"""
    ),
)
def _ledger(t: Tables):
    old = t.ledger.filter("run_seq % 3 <> 0").drop("known_lat", "known_lon")
    run = t.ledger.filter("run_seq % 3 = 0")
    return tables.merge_ledger(old, run).select("iso", "id_centro", "run_seq", "target_type", "acceptance", "score")


@query(
    "ledger_repair",
    with_views(
        """WITH filled AS (SELECT adm0_pcode AS iso, id_centro, nombre_centro, latitud, coordinate_source FROM {school}),
        accepted AS (SELECT DISTINCT iso, id_centro FROM {ledger} WHERE target_type = 'fill' AND acceptance IN ('ACCEPT', 'ACCEPT_CENTROID', 'ACCEPT_WITH_FLAG')),
        lost AS (SELECT f.* FROM filled f ANTI JOIN accepted a ON a.iso = f.iso AND a.id_centro = f.id_centro WHERE coordinate_source = 'geocoded'),
        latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY iso, id_centro ORDER BY run_seq DESC) AS rn FROM {ledger}) WHERE rn = 1)
        SELECT iso, id_centro, 'fill' AS target_type, round(latitud, 6) AS geocoded_lat FROM lost
        UNION ALL SELECT l.iso, l.id_centro, l.target_type, round(l.geocoded_lat, 6) FROM latest l ANTI JOIN lost ON lost.iso = l.iso AND lost.id_centro = l.id_centro"""
    ),
)
def _repair(t: Tables):
    registry = t.school.withColumnRenamed("adm0_pcode", "iso").drop("latitud_geocoded", "longitud_geocoded")
    ledger = t.ledger.withColumnRenamed("score", "arcgis_score")
    fixed = tables.repair_ledger(registry, ledger, F.lit(1 << 60))
    return fixed.select("iso", "id_centro", "target_type", F.round("geocoded_lat", 6).alias("geocoded_lat"))


@query(
    "partition_upsert",
    with_views(
        """SELECT adm0_pcode AS iso, id_centro, CASE WHEN adm0_pcode IN ('ASIA', 'EUROPE') THEN 'new' ELSE 'old' END AS version,
          CASE WHEN adm0_pcode IN ('ASIA', 'EUROPE') THEN sector END AS sector FROM {school}"""
    ),
)
def _upsert(t: Tables):
    rows = t.school.withColumnRenamed("adm0_pcode", "iso")
    old = rows.select("iso", "id_centro", F.lit("old").alias("version"))
    new = rows.filter("iso IN ('ASIA', 'EUROPE')").select("iso", "id_centro", F.lit("new").alias("version"), "sector")
    return tables.upsert_partitions(old, new)


@query(
    "rebuilt_base",
    with_views(
        """SELECT s.id_centro, s.nombre_centro, s.sector, s.nivel_primaria, s.nivel_secbaja, s.nivel_secalta,
          round(s.latitud, 6) AS latitud, round(s.longitud, 6) AS longitud, s.adm0_pcode, e.acceptance, e.geocode_precision
        FROM {school} s LEFT JOIN (SELECT id_centro, acceptance, geocode_precision FROM {school} WHERE row_seq % 4 <> 0) e USING (id_centro)"""
    ),
)
def _rebuilt(t: Tables):
    raw = t.school.select(*config.BASE_COLUMNS)
    twice = t.school.filter("row_seq % 4 <> 0").select("id_centro", "row_seq", "acceptance", "geocode_precision")
    repeated = twice.unionByName(
        twice.withColumns({"row_seq": F.col("row_seq") + 10**12, "acceptance": F.lit("later"), "geocode_precision": F.lit("later")})
    )
    out = tables.rebuild_base(raw, repeated, F.col("row_seq"))
    return out.withColumns({c: F.round(c, 6) for c in ("latitud", "longitud")})


@query(
    "coordinate_cascade",
    with_views(
        """WITH b AS (SELECT id_centro, row_seq AS k, CASE WHEN row_seq % 4 = 0 THEN latitud END AS la, CASE WHEN row_seq % 4 = 0 THEN longitud END AS lo, latitud, longitud FROM {school})
        SELECT id_centro, round(CASE WHEN la IS NOT NULL THEN la WHEN k % 3 = 0 AND k % 9 <> 0 THEN k / 8e0 WHEN k % 5 = 0 THEN k / 16e0 END, 6) AS latitud,
          round(CASE WHEN la IS NOT NULL THEN lo WHEN k % 3 = 0 AND k % 9 <> 0 THEN k / 8e0 + 1 WHEN k % 5 = 0 THEN k / 16e0 + 1 END, 6) AS longitud,
          CASE WHEN la IS NOT NULL THEN 0 WHEN k % 3 = 0 AND k % 9 <> 0 THEN 1 WHEN k % 5 = 0 THEN 2 END AS coord_source_rank FROM b"""
    ),
)
def _cascade(t: Tables):
    k = F.col("row_seq")
    rows = t.school.select(
        "id_centro", *[F.when(k % 4 == 0, F.col(c)).alias(c) for c in ("latitud", "longitud")]
    )
    one = t.school.filter(k % 3 == 0).select(
        "id_centro", "row_seq", (k / 8.0).alias("latitud"), F.when(k % 9 != 0, k / 8.0 + 1).alias("longitud")
    )
    two = t.school.filter(k % 5 == 0).select("id_centro", "row_seq", (k / 16.0).alias("latitud"), (k / 16.0 + 1).alias("longitud"))
    out = linkage.coordinate_cascade(rows, [one, two])
    return out.withColumns({c: F.round(c, 6) for c in ("latitud", "longitud")})


@query(
    "prior_period_fallback",
    with_views(
        """WITH c AS (SELECT id_centro, row_seq AS k, latitud AS la, longitud AS lo, coalesce(latitud BETWEEN 0.5 AND 20 AND longitud BETWEEN 0.5 AND 20, FALSE) AS ok FROM {school})
        SELECT id_centro, NOT ok AND k % 2 = 0 AS used_prior, round(CASE WHEN NOT ok AND k % 2 = 0 THEN 1 + k % 9 ELSE la END, 6) AS latitud,
          round(CASE WHEN NOT ok AND k % 2 = 0 THEN 2 + k % 9 ELSE lo END, 6) AS longitud FROM c"""
    ),
)
def _prior(t: Tables):
    valid = F.col("latitud").between(0.5, 20) & F.col("longitud").between(0.5, 20)
    k = F.col("row_seq")
    prior = t.school.filter(k % 2 == 0).select(
        "id_centro", "row_seq", (1 + k % 9).cast("double").alias("latitud"), (2 + k % 9).cast("double").alias("longitud")
    )
    earlier = prior.withColumns({"row_seq": F.col("row_seq") - 10**12, "latitud": F.lit(99.0)})
    out = linkage.prior_period_fallback(t.school.select("id_centro", "latitud", "longitud"), prior.unionByName(earlier), valid)
    return out.withColumns({c: F.round(c, 6) for c in ("latitud", "longitud")})


BUILDINGS = """
    b AS (SELECT adm0_pcode AS iso, id_centro, row_seq AS k, round_even(latitud, 5) AS la, round_even(longitud, 5) AS lo,
      latitud IS NOT NULL AND longitud IS NOT NULL AS has FROM {school}),
    reg AS (SELECT iso, id_centro, la, lo, 'E' || (k % 40) AS e, k FROM b WHERE k % 5 = 0),
    pts AS (SELECT iso, la, lo, min(e) AS e FROM reg WHERE has GROUP BY ALL HAVING count(DISTINCT e) = 1),
    hit AS (
      SELECT b.*, CASE WHEN b.k % 3 = 0 AND b.iso <> 'ASIA' THEN 'T' || (b.k // 6) END AS a, r.e AS r, p.e AS c
      FROM b LEFT JOIN reg r ON r.iso = b.iso AND r.id_centro = b.id_centro
      LEFT JOIN pts p ON b.has AND p.iso = b.iso AND p.la = b.la AND p.lo = b.lo),
    matched AS (
      SELECT *, CASE WHEN a IS NOT NULL THEN 'A_total' WHEN r IS NOT NULL THEN 'B_lac_id' WHEN c IS NOT NULL THEN 'C_lac_coords' ELSE 'D_synthetic' END AS match_path,
        coalesce(a, r, c, iso || '_SYN_' || lpad(cast(row_number() OVER (PARTITION BY iso, coalesce(a, r, c) IS NULL ORDER BY k) AS varchar), 5, '0')) AS id_edificio,
        1 + k % 3 AS size, k % 7 = 0 AS diff
      FROM hit)""".replace("reg AS (SELECT iso, id_centro, la, lo,", "reg AS (SELECT iso, id_centro, la, lo, has,")


def buildings(t: Tables):
    k = F.col("row_seq")
    schools = t.school.select(
        "adm0_pcode", "id_centro", "row_seq", "latitud", "longitud",
        (1 + k % 3).alias("qc_cluster_size_exact"), (k % 7 == 0).alias("qc_cluster_diff_addr_exact"),
    )
    total = t.school.filter(k % 3 == 0).select(
        "adm0_pcode", "row_seq", F.concat(F.lit(" "), "id_centro", F.lit(".0")).alias("id_centro"),
        F.concat(F.lit("T"), F.floor(k / 6).cast("string")).alias("id_edificio"),
    )
    regional = t.school.filter(k % 5 == 0).select(
        "adm0_pcode", "row_seq", "id_centro", "latitud", "longitud", F.concat(F.lit("E"), (k % 40).cast("string")).alias("id_edificio")
    )
    return linkage.building_ids(schools, total, regional, skip=("ASIA",))


@query(
    "building_ids",
    with_views("WITH " + BUILDINGS.strip() + " SELECT iso AS adm0_pcode, id_centro, id_edificio, match_path FROM matched"),
)
def _buildings(t: Tables):
    return buildings(t).select("adm0_pcode", "id_centro", "id_edificio", "match_path")


@query(
    "building_audit",
    with_views(
        "WITH " + BUILDINGS.strip() + """,
        g AS (SELECT iso, id_edificio, count(*) AS n, min(size) AS least FROM matched WHERE match_path <> 'D_synthetic' GROUP BY ALL)
        SELECT m.id_centro, m.match_path <> 'D_synthetic' AS building_match, coalesce(n > 1 AND least <= 1, FALSE) AS building_match_suspect
        FROM matched m LEFT JOIN g USING (iso, id_edificio)"""
    ),
)
def _audit(t: Tables):
    return linkage.building_audit(buildings(t)).select("id_centro", "building_match", "building_match_suspect")


@query(
    "building_summary",
    with_views(
        "WITH " + BUILDINGS.strip() + """,
        g AS (SELECT iso, id_edificio, count(*) AS n, bool_and(size > 1) AS s_ok, bool_and(NOT diff) AS d_ok, min(size) AS least
          FROM matched WHERE match_path <> 'D_synthetic' GROUP BY ALL HAVING count(*) > 1),
        c AS (SELECT iso, count(*) AS real_buildings_multi, count(*) FILTER (s_ok AND d_ok) AS coherent_buildings, count(*) FILTER (NOT s_ok) AS incoherent_size,
          count(*) FILTER (s_ok AND NOT d_ok) AS incoherent_diff_addr, cast(coalesce(sum(n) FILTER (least <= 1), 0) AS bigint) AS building_match_suspect_rows FROM g GROUP BY 1),
        p AS (SELECT iso, count(*) AS rows, count(*) FILTER (match_path = 'A_total') AS "A_total", count(*) FILTER (match_path = 'B_lac_id') AS "B_lac_id",
          count(*) FILTER (match_path = 'C_lac_coords') AS "C_lac_coords", count(*) FILTER (match_path = 'D_synthetic') AS "D_synthetic" FROM matched GROUP BY 1)
        SELECT iso AS adm0_pcode, rows, "A_total", "B_lac_id", "C_lac_coords", "D_synthetic", coalesce(real_buildings_multi, 0) AS real_buildings_multi,
          coalesce(coherent_buildings, 0) AS coherent_buildings, coalesce(incoherent_size, 0) AS incoherent_size, coalesce(incoherent_diff_addr, 0) AS incoherent_diff_addr,
          coalesce(building_match_suspect_rows, 0) AS building_match_suspect_rows, round(CASE WHEN coalesce(real_buildings_multi, 0) = 0 THEN 1 ELSE coherent_buildings / real_buildings_multi END, 6) AS coherence,
          CASE WHEN coalesce(real_buildings_multi, 0) = 0 THEN TRUE ELSE coherent_buildings / real_buildings_multi >= 0.85 END AS meets_threshold
        FROM p LEFT JOIN c USING (iso)"""
    ),
)
def _summary(t: Tables):
    return linkage.building_summary(buildings(t))


VINTAGE = """
    o AS (SELECT id_centro, CASE WHEN abs(latitud) <= 90 THEN latitud END AS la, longitud AS lo, TRUE AS f FROM {school} WHERE row_seq % 7 <> 0),
    n AS (SELECT id_centro, CASE WHEN row_seq % 6 = 0 OR abs(latitud + CASE WHEN row_seq % 4 = 0 THEN (row_seq % 50) / 50e0 ELSE 0 END) > 90 THEN NULL WHEN row_seq % 4 = 0 THEN latitud + (row_seq % 50) / 50e0 ELSE latitud END AS la2, longitud AS lo2, TRUE AS f2 FROM {school} WHERE row_seq % 11 <> 0),
    j AS (SELECT coalesce(o.id_centro, n.id_centro) AS id_centro, la, lo, la2, lo2, f, f2,
      2 * 6371.0088 * asin(sqrt(pow(sin(radians(la2 - la) / 2), 2) + cos(radians(la)) * cos(radians(la2)) * pow(sin(radians(lo2 - lo) / 2), 2))) AS km
      FROM o FULL JOIN n ON o.id_centro = n.id_centro),
    v AS (SELECT *, CASE WHEN f IS NULL THEN 'alta' WHEN f2 IS NULL THEN 'baja' WHEN la IS NULL OR lo IS NULL THEN 'coord_nueva_sin_previa'
      WHEN la2 IS NULL OR lo2 IS NULL THEN 'sin_coord_nueva' WHEN km <= 0.1 THEN 'coord_confirmada' ELSE 'coord_actualizada' END AS estado FROM j)"""


def vintages(t: Tables):
    k = F.col("row_seq")
    rows = t.school
    old = rows.filter(k % 7 != 0)
    moved = F.when(k % 6 == 0, F.lit(None)).when(k % 4 == 0, F.col("latitud") + (k % 50) / 50.0).otherwise(F.col("latitud"))
    new = rows.filter(k % 11 != 0).withColumn("latitud", moved)
    return linkage.compare_vintages(old, new)


@query("vintage_states", with_views("WITH " + VINTAGE.strip() + " SELECT id_centro, estado, round(km, 4) AS delta_km FROM v"))
def _vintage(t: Tables):
    return vintages(t).select("id_centro", "estado", F.round("delta_km", 4).alias("delta_km"))


@query(
    "vintage_summary",
    with_views(
        "WITH " + VINTAGE.strip() + """, w AS (SELECT estado, CASE WHEN estado = 'coord_actualizada' THEN km END AS m FROM v)
        SELECT estado, count(*) AS n, round(quantile_cont(m, 0.5), 4) AS km_p50, round(quantile_cont(m, 0.9), 4) AS km_p90, round(quantile_cont(m, 0.99), 4) AS km_p99,
          count(*) FILTER (m > 1) AS n_gt_1km, count(*) FILTER (m > 10) AS n_gt_10km, count(*) FILTER (m > 50) AS n_gt_50km FROM w GROUP BY 1"""
    ),
)
def _vintage_summary(t: Tables):
    return linkage.vintage_summary(vintages(t))


@query(
    "collapsed_schools",
    """WITH r AS (SELECT l_orderkey AS id, l_linenumber AS s, CASE WHEN l_linenumber > 1 THEN l_shipdate::date::varchar END AS nm, l_returnflag AS f,
        CASE WHEN l_quantity > 10 THEN l_quantity END AS la, l_tax AS lo, l_linenumber * 1000000 + l_partkey * 1000 + l_suppkey AS seq, l_discount FROM lineitem)
      SELECT id AS id_centro, arg_min(nm, seq) FILTER (nm IS NOT NULL) AS nombre_centro, CASE WHEN bool_or(f = 'R') THEN 'Private' ELSE 'Public' END AS sector,
        max(CASE WHEN s = 1 THEN 1 ELSE 0 END) AS nivel_primaria, max(CASE WHEN s = 2 THEN 1 ELSE 0 END) AS nivel_secbaja, max(CASE WHEN f = 'A' THEN 1 ELSE 0 END) AS nivel_secalta,
        arg_min(la, seq) FILTER (la IS NOT NULL) AS latitud, arg_min(lo, seq) FILTER (lo IS NOT NULL) AS longitud FROM r GROUP BY 1""",
)
def _collapsed(t: Tables):
    n = F.col("l_linenumber")
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("id_centro"),
        F.when(n > 1, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("nombre_centro"),
        F.when(F.col("l_returnflag") == "R", "Private").otherwise("Public").alias("sector"),
        (n == 1).cast("int").alias("nivel_primaria"), (n == 2).cast("int").alias("nivel_secbaja"),
        (F.col("l_returnflag") == "A").cast("int").alias("nivel_secalta"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("latitud"), F.col("l_tax").alias("longitud"),
        (n.cast("bigint") * 1000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("row_seq"),
    )
    return linkage.collapse_schools(rows)


@query(
    "levels_from_services",
    """SELECT l_orderkey AS id, max(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS nivel_primaria, max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS nivel_secbaja,
        max(CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END) AS nivel_secalta FROM lineitem WHERE l_linenumber IN (2, 3, 4) GROUP BY 1""",
)
def _services(t: Tables):
    return linkage.levels_from_services(t.lineitem.select(F.col("l_orderkey").alias("id"), "l_linenumber"), "id", "l_linenumber")


@query(
    "extra_rows",
    with_views(
        """SELECT id_centro, sector FROM {school} WHERE row_seq % 3 = 0 UNION ALL SELECT id_centro, 'Private' FROM {school} WHERE row_seq % 2 = 0 AND row_seq % 3 <> 0"""
    ),
)
def _extra(t: Tables):
    base = t.school.filter("row_seq % 3 = 0").select("id_centro", "sector")
    extra = t.school.filter("row_seq % 2 = 0").select("id_centro", F.lit("Private").alias("sector"))
    return linkage.add_extra_rows(base, extra)


CONTEXT = """
    anchor AS (SELECT iso, arg_min(lat, cell_id) AS la0, arg_min(lon, cell_id) AS lo0 FROM {grid} GROUP BY 1),
    s AS (SELECT s.adm0_pcode AS iso, s.id_centro, s.row_seq, s.nivel_primaria AS p, s.nivel_secbaja AS b, s.nivel_secalta AS a, s.row_seq % 3 = 0 AS include,
      CASE WHEN row_seq % 17 <> 0 THEN 10 + ((row_seq * 7 % 400) + 0.25e0) * 8e-3 END AS lat, (row_seq * 13 % 50 + 0.75e0) * 8e-3 AS lon FROM {school} s),
    si AS (SELECT s.*, round_even((lat - la0) / 8e-3, 0) AS i, round_even((lon - lo0) / 8e-3, 0) AS j FROM s JOIN anchor USING (iso)),
    gi AS (SELECT g.iso, g.cell_id, g.area_class, round_even((lat - la0) / 8e-3, 0) AS i, round_even((lon - lo0) / 8e-3, 0) AS j FROM {grid} g JOIN anchor USING (iso)),
    c AS (SELECT si.*, gi.cell_id, gi.area_class FROM si LEFT JOIN gi ON gi.iso = si.iso AND gi.i = si.i AND gi.j = si.j)"""


def context(t: Tables):
    k = F.col("row_seq")
    schools = t.school.select(
        F.col("adm0_pcode").alias("iso"), "id_centro", "nivel_primaria", "nivel_secbaja", "nivel_secalta",
        F.when(k % 17 != 0, 10.0 + ((k * 7 % 400) + F.lit(0.25)) * 8e-3).alias("lat"), ((k * 13 % 50) + F.lit(0.75)).alias("lon"),
    ).withColumn("lon", F.col("lon") * 8e-3)
    flags = t.school.select(F.col("adm0_pcode").alias("iso"), "id_centro", (k % 3 == 0).alias("include_in_spatial_indicators"))
    return linkage.school_context(schools, flags, t.grid, ["cell_id", "area_class"], 8e-3)


@query("school_context", with_views("WITH " + CONTEXT.strip() + " SELECT id_centro, cell_id, area_class, include AS include_in_spatial_indicators FROM c"))
def _context(t: Tables):
    return context(t).select("id_centro", "cell_id", "area_class", "include_in_spatial_indicators")


@query(
    "school_context_metrics",
    with_views(
        "WITH " + CONTEXT.strip() + """
        SELECT iso, count(*) AS n_total, count(lat) AS n_georef, count(cell_id) AS n_cell_matched, count(*) FILTER (lat IS NOT NULL AND cell_id IS NULL) AS n_cell_unmatched_georef,
          count(*) FILTER (include) AS n_spatial_in, count(*) FILTER (include AND cell_id IS NOT NULL) AS n_spatial_in_matched,
          round(100e0 * count(cell_id) / greatest(count(lat), 1), 1) AS pct_matched_of_georef FROM c GROUP BY 1"""
    ),
)
def _context_metrics(t: Tables):
    return linkage.context_metrics(context(t))


@query(
    "k12_summary",
    with_views(
        "WITH " + CONTEXT.strip() + " SELECT iso, count(*) AS n_k12, count(lat) AS n_georef, count(cell_id) AS n_cell_matched FROM c WHERE p + b + a > 0 GROUP BY 1"
    ),
)
def _k12(t: Tables):
    return linkage.k12_summary(context(t))


@query(
    "run_manifest",
    with_views(
        """SELECT r_name AS iso, s.n AS n_schools, s.geo AS n_georef, CASE WHEN s.n IS NULL THEN 'skipped' ELSE 'ok' END AS status
        FROM region LEFT JOIN (SELECT adm0_pcode, count(*) AS n, count(latitud) AS geo FROM {school} WHERE adm0_pcode <> 'ASIA' GROUP BY 1) s ON s.adm0_pcode = r_name"""
    ),
)
def _manifest(t: Tables):
    rows = t.school.withColumnRenamed("adm0_pcode", "iso").filter("iso <> 'ASIA'")
    return tables.run_manifest(
        t.region.withColumnRenamed("r_name", "iso"), rows,
        {"n_schools": F.count(F.lit(1)), "n_georef": F.count("latitud")},
    )


@query(
    "stable_sort_top",
    "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders QUALIFY place <= 30",
)
def _top(t: Tables):
    """The thirty largest orders: a top-k report."""
    top = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(30).select("o_orderkey", "o_totalprice")
    from pyspark.sql import Window

    # at most thirty rows reach this window
    place = F.row_number().over(Window.orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return top.withColumn("place", place)


@query(
    "id_set_algebra",
    with_views(
        """WITH m AS (SELECT id_centro FROM {school} WHERE latitud IS NULL), z AS (SELECT id_centro FROM {school} WHERE latitud = 0 OR longitud = 0), p AS (SELECT id_centro FROM {school} WHERE sector = 'Public')
        SELECT 'union' AS op, id_centro FROM (SELECT * FROM m UNION SELECT * FROM z) UNION ALL SELECT 'intersect', id_centro FROM (SELECT * FROM m INTERSECT SELECT * FROM p)
        UNION ALL SELECT 'except', id_centro FROM (SELECT * FROM p EXCEPT SELECT * FROM z)"""
    ),
)
def _sets(t: Tables):
    ids = lambda cond: t.school.filter(cond).select("id_centro")
    missing, zeros, public = ids("latitud IS NULL"), ids("latitud = 0 OR longitud = 0"), ids("sector = 'Public'")
    label = lambda df, op: df.select(F.lit(op).alias("op"), "id_centro")
    return (
        label(missing.union(zeros).distinct(), "union")
        .union(label(missing.intersect(public), "intersect"))
        .union(label(public.subtract(zeros), "except"))
    )
