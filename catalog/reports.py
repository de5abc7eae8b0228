"""Queries on gap filling and report marts over the finalised registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.geo import haversine_km
from access_spark.operators import clusters, fill, marts
from access_spark.session import cut_lineage
from access_spark.sources import tables
from catalog.domain import Tables, with_views
from catalog.linking import BUILDINGS, buildings
from catalog.registry import ORACLES, query
from catalog.registry_quality import FINAL, finalized


def registry_table(t: Tables):
    """The finalised registry under its published column names, the shared one if there is one."""
    shared = getattr(t, "_registry", None)
    return finalized(t).withColumnRenamed("adm0_pcode", "iso") if shared is None else shared


def share_registry(t: Tables, *columns: str) -> None:
    """Write the registry, or some of its columns, once for a query that reads it more than once."""
    t._registry = cut_lineage(registry_table(t).select(*(columns or "*")))


REGISTRY = FINAL + """,
    reg AS (
      SELECT l.adm0_pcode AS iso, l.id_centro, l.row_seq, l.nombre_centro, l.sector, l.nivel_primaria, l.nivel_secbaja, l.nivel_secalta, l.y AS latitud, l.x AS longitud,
        l.src AS coordinate_source, l.label AS q, l.include AS inc, l.scope, l.st1, l.st2, l.diff_addr, l.size5, l.inb, l.usable, l.c1, l.policy,
        l.src IN ('', 'original') AS raw FROM labelled l)"""


def _reg(body: str) -> str:
    return with_views("WITH " + REGISTRY.strip() + body)


@query(
    "qc_baseline",
    _reg(
        """, sec AS (SELECT *, unnest(CASE sector WHEN 'Public' THEN ['total', 'public'] WHEN 'Private' THEN ['total', 'private'] ELSE ['total'] END) AS s FROM reg),
        c AS (SELECT iso, s AS sector, any_value(policy) AS policy, count(*) AS n_total, count(*) FILTER (raw AND q <> 'missing') AS n_georef, count(*) FILTER (raw AND q = 'out_of_bounds') AS t3,
          count(*) FILTER (raw AND st1 IN ('MATCH', 'MISMATCH')) AS e1, count(*) FILTER (raw AND st1 = 'MISMATCH') AS m1, count(*) FILTER (raw AND st2 IN ('MATCH', 'MISMATCH')) AS e2,
          count(*) FILTER (raw AND st2 = 'MISMATCH') AS m2, count(*) FILTER (raw AND diff_addr) AS t7 FROM sec GROUP BY ALL),
        m AS (SELECT unnest(['pre', 'post']) AS mode)
        SELECT iso, mode, sector, n_total, n_georef, CASE WHEN mode = 'post' THEN 0 WHEN sector = 'total' THEN CASE iso WHEN 'ASIA' THEN 7 ELSE 0 END END AS test1_wgs84_n,
          CASE WHEN mode = 'post' THEN 0 WHEN sector = 'total' THEN CASE iso WHEN 'ASIA' THEN 13 ELSE 0 END END AS test2_zero_zero_n, t3 AS test3_oob_n,
          CASE WHEN mode = 'post' THEN 0 WHEN sector = 'total' THEN 0 END AS test4_swapped_n, round_even(100e0 * n_georef / n_total, 1) AS test5_georef_pct,
          CASE WHEN policy IN ('adm1', 'adm2') AND e1 > 0 THEN round_even((1 - m1 / e1) * 100, 1) END AS test6_adm1_match_pct, CASE WHEN policy IN ('adm1', 'adm2') THEN e1 ELSE 0 END AS test6_adm1_n_evaluated,
          CASE WHEN policy IN ('adm1', 'adm2') AND e2 > 0 THEN round_even((1 - m2 / e2) * 100, 1) END AS test6_adm2_match_pct, CASE WHEN policy IN ('adm1', 'adm2') THEN e2 ELSE 0 END AS test6_adm2_n_evaluated,
          CASE WHEN n_georef > 0 THEN round_even(100e0 * t7 / n_georef, 1) END AS test7_dup_pct, t7 AS test7_dup_n FROM c, m"""
    ),
)
def _baseline(t: Tables):
    policies = t.country.select("iso", "final_match_level")
    events = t.country.filter("iso = 'ASIA'").select("iso", F.lit(7).alias("n_reprojected"), F.lit(13).alias("n_zero_pairs"), F.lit(0).alias("n_swapped"))
    return marts.qc_baseline(registry_table(t), policies, events)


TARGETS = REGISTRY + """,
    anyd AS (SELECT iso, bool_or(diff_addr) AS a FROM reg GROUP BY 1),
    tg AS (SELECT reg.*, latitud IS NULL OR longitud IS NULL AS missing, coalesce(latitud = 0 OR longitud = 0, FALSE) AS zeros, NOT inb AND usable AS oob,
      st1 = 'MISMATCH' OR st2 = 'MISMATCH' AS mism, size5 >= 5 AND (NOT a OR diff_addr) AS cent FROM reg JOIN anyd USING (iso)),
    funnel AS (SELECT iso, id_centro, sector, CASE WHEN coordinate_source = 'geocoded' THEN 'already_geocoded' WHEN coordinate_source = 'centroid_cascade' THEN 'already_cascade'
      WHEN missing OR zeros THEN 'pending_missing' WHEN oob THEN 'pending_out_of_bounds' WHEN mism THEN 'pending_mismatches' WHEN cent THEN 'pending_centroids' END AS funnel_status FROM tg)"""


def _tg(body: str) -> str:
    return with_views("WITH " + TARGETS.strip() + body)


def targets_of(t: Tables):
    rows = registry_table(t).withColumnRenamed("iso", "adm0_pcode")
    return clusters.geocode_targets(rows).withColumnRenamed("adm0_pcode", "iso")


@query(
    "geocode_target_summary",
    _tg(
        """, sec AS (SELECT *, unnest(CASE sector WHEN 'Public' THEN ['total', 'public'] WHEN 'Private' THEN ['total', 'private'] ELSE ['total'] END) AS s FROM tg)
        SELECT iso, s AS sector, count(*) FILTER (raw AND (missing OR zeros)) AS n_pending_missing, count(*) FILTER (raw AND zeros) AS n_pending_zeros, count(*) FILTER (raw AND oob) AS n_pending_out_of_bounds,
          count(*) FILTER (raw AND mism) AS n_pending_mismatches, count(*) FILTER (raw AND cent) AS n_pending_centroids, count(*) FILTER (raw AND diff_addr) AS n_pending_dup_addr,
          count(*) FILTER (coordinate_source = 'geocoded') AS n_already_geocoded, count(*) FILTER (coordinate_source = 'centroid_cascade') AS n_already_cascade FROM sec GROUP BY ALL"""
    ),
)
def _target_summary(t: Tables):
    return marts.target_summary(targets_of(t))


@query("funnel_status", _tg(" SELECT * FROM funnel WHERE funnel_status IS NOT NULL"))
def _funnel(t: Tables):
    return marts.funnel_status(targets_of(t))


@query(
    "funnel_counts",
    _tg(
        """, tried AS (SELECT DISTINCT iso, id_centro FROM {ledger}),
        r AS (SELECT f.iso, CASE f.sector WHEN 'Public' THEN 'public' WHEN 'Private' THEN 'private' ELSE 'unknown' END AS sector,
          CASE WHEN funnel_status LIKE 'already%' THEN 'fill_recovered' WHEN funnel_status = 'pending_missing' THEN 'fill_pending' ELSE 'compare' END AS route_bucket, t.id_centro IS NOT NULL AS attempted
          FROM funnel f LEFT JOIN tried t USING (iso, id_centro) WHERE funnel_status IS NOT NULL)
        SELECT iso, sector, route_bucket, attempted, count(*) AS n_schools FROM r GROUP BY ALL
        UNION ALL SELECT iso, 'total', route_bucket, attempted, count(*) FROM r GROUP BY ALL"""
    ),
)
def _funnel_counts(t: Tables):
    return marts.funnel_counts(marts.funnel_status(targets_of(t)), t.ledger)


@query(
    "funnel_headline",
    _tg(
        """, tried AS (SELECT DISTINCT iso, id_centro FROM {ledger}),
        r AS (SELECT f.*, t.id_centro IS NOT NULL AS att, funnel_status LIKE 'already%' AS rec, funnel_status IN ('pending_mismatches', 'pending_centroids', 'pending_out_of_bounds') AS cmp
          FROM funnel f LEFT JOIN tried t USING (iso, id_centro) WHERE funnel_status IS NOT NULL)
        SELECT count(*) AS funnel_total, count(*) FILTER (rec) AS funnel_recovered, count(*) FILTER (NOT rec AND att) AS funnel_validated, count(*) FILTER (NOT rec AND NOT att) AS funnel_unprocessed,
          count(*) FILTER (cmp) AS funnel_compare_candidates, count(*) FILTER (cmp AND att) AS funnel_compare_processed, count(*) FILTER (NOT cmp) AS funnel_fill_candidates,
          count(*) FILTER (NOT cmp AND att AND NOT rec) AS funnel_fill_attempted_failed FROM r"""
    ),
)
def _headline(t: Tables):
    return marts.funnel_headline(marts.funnel_status(targets_of(t)), t.ledger)


@query(
    "prepass_summary",
    with_views(
        "WITH " + FINAL.strip() + """,
        q AS (SELECT adm0_pcode AS iso, x, y, CASE WHEN x IS NULL OR y IS NULL THEN NULL WHEN swapped THEN 'LIKELY_SWAPPED' WHEN NOT inb THEN 'OUT_OF_BOUNDS' WHEN a.code IS NULL THEN 'NO_POLYGON'
          WHEN raw_adm1_code <> '' THEN CASE WHEN raw_adm1_code = a.code THEN 'MATCH' ELSE 'MISMATCH' END WHEN policy = 'spatial_only' THEN 'MATCH' WHEN raw_adm1 = '' THEN 'NO_RAW_ADM'
          WHEN contains(lower(a.name), lower(raw_adm1)) OR contains(lower(raw_adm1), lower(a.name)) THEN 'MATCH' ELSE 'MISMATCH' END AS st
          FROM s4 LEFT JOIN at1 a USING (id_centro)),
        c AS (SELECT iso, count(*) AS total, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS with_coords, count(st) AS qc_checked, count(*) FILTER (st = 'MATCH') AS match,
          count(*) FILTER (st = 'MISMATCH') AS mismatch, count(*) FILTER (st = 'OUT_OF_BOUNDS') AS out_of_bounds, count(*) FILTER (st = 'LIKELY_SWAPPED') AS likely_swapped,
          count(*) FILTER (st = 'NO_POLYGON') AS no_polygon, count(*) FILTER (st = 'NO_RAW_ADM') AS no_raw_adm FROM q GROUP BY 1)
        SELECT *, total - with_coords AS missing_coords, round_even(100e0 * match / greatest(qc_checked - no_raw_adm, 1), 1) AS match_rate_pct FROM c"""
    ),
)
def _prepass(t: Tables):
    from access_spark.plans.prepass import check_registry

    checked = check_registry(registry_table(t), t.address, t.boundary, t.edge, t.country)
    return marts.prepass_summary(checked)


@query(
    "coverage",
    _reg(
        """, c AS (SELECT iso, count(*) AS n, count(latitud) AS g, count(*) FILTER (sector = 'Public') AS pu, count(latitud) FILTER (sector = 'Public') AS pug, count(*) FILTER (sector = 'Private') AS pr,
          count(latitud) FILTER (sector = 'Private') AS prg, count(*) FILTER (q IN ('gps_validated', 'geocoded_street')) AS hp, count(*) FILTER (q IN ('geocoded_centroid', 'cluster_centroid')) AS cp,
          count(*) FILTER (q IN ('gps_unverified', 'adm_mismatch', 'geocoder_disagrees', 'out_of_bounds', 'swapped')) AS un FROM reg GROUP BY 1),
        u AS (SELECT iso, 200 + 50 * rk AS public_universe, 300 + 40 * rk AS total_universe_est, CASE WHEN rk < 3 THEN 'public' ELSE 'public+private' END AS sector_scope FROM {country})
        SELECT iso, public_universe, total_universe_est, sector_scope, n AS n_schools_in_file, g AS n_georef, hp AS n_high_precision, cp AS n_centroid_precision, un AS n_unverified, n - g AS n_missing_coords,
          round_even(100e0 * g / n, 1) AS pct_georef, CASE WHEN pu > 0 THEN pug END AS n_georef_public, round_even(100e0 * pug / nullif(pu, 0), 1) AS pct_georef_public,
          CASE WHEN pr > 0 THEN prg END AS n_georef_private, round_even(100e0 * prg / nullif(pr, 0), 1) AS pct_georef_private, round_even(100e0 * hp / n, 1) AS pct_high_precision,
          round_even(100e0 * cp / n, 1) AS pct_centroid_precision, round_even(100e0 * un / n, 1) AS pct_unverified, total_universe_est - public_universe AS private_universe,
          round_even(100e0 * n / public_universe, 1) AS pct_coverage_vs_public, round_even(100e0 * n / total_universe_est, 1) AS pct_coverage_vs_total,
          sector_scope = 'public' AND total_universe_est > public_universe * 1.05 AS private_gap_flag FROM u LEFT JOIN c USING (iso)"""
    ),
)
def _coverage(t: Tables, registry=None):
    universe = t.country.select(
        "iso", (200 + 50 * F.col("rk")).alias("public_universe"), (300 + 40 * F.col("rk")).alias("total_universe_est"),
        F.when(F.col("rk") < 3, "public").otherwise("public+private").alias("sector_scope"),
    )
    return marts.coverage(registry_table(t) if registry is None else registry, universe)


def _countries(t: Tables):
    return t.country.select("iso", "pipeline_enabled", "analysis_included", "final_match_level", "validation_tier", "data_status")


def summary(t: Tables):
    return marts.country_summary(registry_table(t), _countries(t))


_Q = ", ".join(f"count(*) FILTER (q = '{q}') AS q_{q}" for q in config.QUALITY_LABELS)
_G = ", ".join(
    f"count(*) FILTER (q IN ({', '.join(repr(m) for m in members)})) AS qg_{g}" for g, members in marts.QUALITY_GROUPS.items()
)
COUNTRY = REGISTRY + f""",
    cs AS (SELECT iso, count(*) AS current_total, count(*) FILTER (sector = 'Public') AS current_public, count(*) FILTER (sector = 'Private') AS current_private,
      count(*) FILTER (latitud IS NOT NULL AND longitud IS NOT NULL) AS n_georef_current, count(*) FILTER (raw AND latitud IS NOT NULL AND longitud IS NOT NULL) AS n_georef_raw,
      count(*) FILTER (q IN ('gps_validated', 'geocoded_street', 'geocoded_centroid')) AS n_verified_like, count(*) FILTER (q IN ('gps_validated', 'geocoded_street')) AS n_high_precision,
      count(*) FILTER (q IN ('geocoded_centroid', 'cluster_centroid')) AS n_centroid_precision,
      count(*) FILTER (q IN ('gps_unverified', 'adm_mismatch', 'geocoder_disagrees', 'out_of_bounds', 'swapped')) AS n_unverified,
      count(*) FILTER (inc) AS n_include_spatial, count(*) FILTER (NOT inc) AS n_exclude_spatial, count(*) FILTER (inc IS NULL) AS n_review_spatial, {_Q}, {_G} FROM reg GROUP BY 1)"""
_PCT = ", ".join(
    f"round_even(100e0 * n_{c} / current_total, 1) AS pct_{c}"
    for c in ("verified_like", "high_precision", "centroid_precision", "unverified", "include_spatial", "exclude_spatial", "review_spatial", "georef_current", "georef_raw")
)


@query(
    "country_summary",
    with_views(
        "WITH " + COUNTRY.strip() + f""" SELECT iso, pipeline_enabled, analysis_included, final_match_level, validation_tier, data_status, cs.* EXCLUDE (iso), TRUE AS file_exists,
          current_total - current_public - current_private AS current_unknown, n_georef_current - n_georef_raw AS n_gap_filled, {_PCT}, round_even(100e0 * q_gps_validated / current_total, 1) AS pct_gps_validated
        FROM {{country}} JOIN cs USING (iso)"""
    ),
)
def _summary(t: Tables):
    return summary(t)


_SCOPED = COUNTRY + """, sc AS (SELECT cs.*, unnest(CASE WHEN analysis_included THEN ['pipeline', 'analysis'] ELSE ['pipeline'] END) AS scope FROM cs JOIN {country} USING (iso))"""
_SUMS = {
    "n_georef_current": "n_georef_current", "n_georef_raw": "n_georef_raw", "n_verified_like": "n_verified_like", "n_gps_validated": "q_gps_validated",
    "n_high_precision": "n_high_precision", "n_centroid_precision": "n_centroid_precision", "n_unverified": "n_unverified", "n_include_spatial": "n_include_spatial",
    "n_exclude_spatial": "n_exclude_spatial", "n_review_spatial": "n_review_spatial",
}


@query(
    "scope_totals",
    with_views(
        "WITH " + _SCOPED.strip() + " SELECT scope, count(*) AS countries, cast(sum(current_total) AS bigint) AS total_schools, cast(sum(current_public) AS bigint) AS public_schools, cast(sum(current_private) AS bigint) AS private_schools, "
        + ", ".join(f"cast(sum({c}) AS bigint) AS {n}, round_even(100e0 * sum({c}) / sum(current_total), 1) AS pct_{n[2:]}" for n, c in _SUMS.items()) + " FROM sc GROUP BY 1"
    ),
)
def _scope(t: Tables):
    return marts.scope_totals(summary(t))


@query(
    "quality_totals",
    with_views(
        "WITH " + _SCOPED.strip() + ", u AS (UNPIVOT (SELECT scope, current_total, COLUMNS('^q_') FROM sc) ON COLUMNS('^q_') INTO NAME quality VALUE n), tot AS (SELECT scope, sum(current_total) AS s FROM sc GROUP BY 1)"
        " SELECT scope, quality[3:] AS quality, cast(sum(n) AS bigint) AS count, round_even(100e0 * sum(n) / any_value(s), 1) AS pct_of_total FROM u JOIN tot USING (scope) GROUP BY 1, 2"
    ),
)
def _quality_totals(t: Tables):
    return marts.quality_totals(summary(t))


@query(
    "quality_rollup",
    with_views(
        "WITH " + _SCOPED.strip() + ", u AS (UNPIVOT (SELECT scope, current_total, COLUMNS('^qg_') FROM sc) ON COLUMNS('^qg_') INTO NAME bucket VALUE n), tot AS (SELECT scope, sum(current_total) AS s FROM sc GROUP BY 1)"
        " SELECT scope, bucket[4:] AS bucket, cast(sum(n) AS bigint) AS count, round_even(100e0 * sum(n) / any_value(s), 1) AS pct_of_total FROM u JOIN tot USING (scope) GROUP BY 1, 2"
    ),
)
def _rollup(t: Tables):
    return marts.rollup_totals(summary(t))


@query(
    "build_summary",
    _reg(" SELECT iso, count(*) AS total_k12, count(*) FILTER (sector = 'Public') AS public, count(*) FILTER (sector = 'Private') AS private, count(*) FILTER (latitud IS NOT NULL AND longitud IS NOT NULL) AS georef FROM reg GROUP BY 1"),
)
def _build(t: Tables):
    return marts.build_summary(registry_table(t))


@query(
    "registry_profile",
    with_views(
        """SELECT 'rows' AS part, '' AS value, count(*) AS n FROM {school} UNION ALL SELECT 'null', 'latitud', count(*) FILTER (latitud IS NULL) FROM {school} UNION ALL SELECT 'null', 'longitud', count(*) FILTER (longitud IS NULL) FROM {school}
        UNION ALL SELECT 'sector', sector, count(*) FROM {school} GROUP BY sector UNION ALL SELECT 'acceptance', acceptance, count(*) FROM {school} GROUP BY acceptance
        UNION ALL SELECT 'duplicates', 'nombre_centro+sector', count(*) - count(DISTINCT (nombre_centro, sector)) FROM {school}"""
    ),
)
def _profile(t: Tables):
    return marts.registry_profile(t.school, ["sector", "acceptance"], ["nombre_centro", "sector"], ["latitud", "longitud"])


LEVELS = ("nivel_primaria", "nivel_secbaja", "nivel_secalta")


def _k12(t: Tables):
    return registry_table(t).filter("nivel_primaria + nivel_secbaja + nivel_secalta > 0")


@query(
    "label_crosstab",
    _reg(
        """, k AS (SELECT * FROM reg WHERE nivel_primaria + nivel_secbaja + nivel_secalta > 0)
        SELECT 'quality' AS label, q AS value, count(*) FILTER (inc) AS include_true, count(*) FILTER (NOT inc) AS include_false, count(*) FILTER (inc IS NULL) AS include_null FROM k GROUP BY q
        UNION ALL SELECT 'scope', scope, count(*) FILTER (inc), count(*) FILTER (NOT inc), count(*) FILTER (inc IS NULL) FROM k GROUP BY scope"""
    ),
)
def _crosstab(t: Tables):
    share_registry(t, "iso", "id_centro", *LEVELS, "coordinate_quality", "qc_scope_class", "include_in_spatial_indicators")
    parts = []
    for name, column in (("quality", "coordinate_quality"), ("scope", "qc_scope_class")):
        tab = marts.label_crosstab(registry_table(t), _k12(t), column)
        parts.append(tab.select(F.lit(name).alias("label"), F.col(column).alias("value"), "include_true", "include_false", "include_null"))
    return parts[0].unionByName(parts[1])


@query(
    "inclusion_share",
    _reg(" SELECT iso, count(*) AS n, round_even(100e0 * count(*) FILTER (inc) / count(*), 1) AS pct_include FROM reg WHERE nivel_primaria + nivel_secbaja + nivel_secalta > 0 GROUP BY 1"),
)
def _inclusion(t: Tables):
    share_registry(t, "iso", "id_centro", *LEVELS, "include_in_spatial_indicators")
    return marts.inclusion_share(registry_table(t), _k12(t))


@query(
    "admin_concentration",
    _reg(
        """, u AS (SELECT iso, c1 AS adm1_pcode, count(*) AS n_total, count(*) FILTER (inc) AS n_include, count(*) FILTER (NOT inc) AS n_exclude, count(*) FILTER (inc IS NULL) AS n_review FROM reg GROUP BY ALL),
        r AS (SELECT *, n_exclude + n_review AS n_problems, row_number() OVER (PARTITION BY iso ORDER BY n_exclude + n_review DESC, adm1_pcode) AS rn FROM u WHERE n_exclude + n_review > 0)
        SELECT iso, r.adm1_pcode, n_total, n_include, n_exclude, n_review, n_problems, b.name AS adm1_name, round_even(100e0 * n_problems / n_total, 1) AS pct_problems
        FROM r LEFT JOIN (SELECT pcode, name FROM {boundary} WHERE level = 1) b ON b.pcode = r.adm1_pcode WHERE rn <= 5"""
    ),
)
def _concentration(t: Tables):
    names = t.boundary.filter("level = 1").select(F.col("pcode").alias("adm1_pcode"), F.col("name").alias("adm1_name"))
    return marts.admin_concentration(registry_table(t), names).select(
        "iso", "adm1_pcode", "n_total", "n_include", "n_exclude", "n_review", "n_problems", "adm1_name", "pct_problems"
    )


_LEDGER_COUNTS = """count(*) FILTER (target_type = 'compare' AND acceptance = 'KEEP_ORIGINAL') AS compare_keep_original, count(*) FILTER (target_type = 'compare' AND acceptance = 'FLAG') AS compare_flag,
    count(*) FILTER (target_type = 'compare' AND acceptance = 'REJECT') AS compare_reject, count(*) FILTER (target_type = 'compare' AND acceptance = '') AS compare_pending,
    count(*) FILTER (target_type = 'fill' AND acceptance IN ('ACCEPT', 'ACCEPT_CENTROID', 'ACCEPT_WITH_FLAG')) AS fill_accept, count(*) FILTER (target_type = 'fill' AND acceptance = 'ACCEPT') AS fill_accept_street,
    count(*) FILTER (target_type = 'fill' AND acceptance = 'ACCEPT_CENTROID') AS fill_accept_centroid, count(*) FILTER (target_type = 'fill' AND acceptance = 'ACCEPT_WITH_FLAG') AS fill_accept_with_flag,
    count(*) FILTER (target_type = 'fill' AND acceptance = 'REJECT') AS fill_reject, count(*) FILTER (target_type = 'fill' AND acceptance = '') AS fill_pending"""


@query(
    "geocoding_overview",
    with_views(
        f"""SELECT count(*) AS geocoder_universe_total, count(*) FILTER (target_type = 'compare') AS compare_universe, count(*) FILTER (target_type = 'fill') AS fill_universe,
          string_agg(DISTINCT iso, ',' ORDER BY iso) AS processed_country_isos, count(DISTINCT iso) AS processed_countries, count(DISTINCT iso) FILTER (target_type = 'compare') AS compare_countries,
          count(DISTINCT iso) FILTER (target_type = 'fill') AS fill_countries, {_LEDGER_COUNTS}, (SELECT count(*) FROM {{school}}) AS total_schools, greatest((SELECT count(*) FROM {{school}}) - count(*), 0) AS outside_geocoder_universe,
          round_even(100e0 * greatest((SELECT count(*) FROM {{school}}) - count(*), 0) / (SELECT count(*) FROM {{school}}), 1) AS outside_geocoder_universe_pct, round_even(100e0 * count(*) FILTER (target_type = 'compare') / (SELECT count(*) FROM {{school}}), 1) AS compare_universe_pct,
          round_even(100e0 * count(*) FILTER (target_type = 'fill') / (SELECT count(*) FROM {{school}}), 1) AS fill_universe_pct FROM {{ledger}}"""
    ),
)
def _overview(t: Tables):
    return marts.geocoding_overview(t.ledger, t.school.count())


SAMPLES = """
    smp AS (SELECT iso, score, 2 * 6371.0 * asin(sqrt(pow(sin(radians(geocoded_lat - known_lat) / 2), 2) + cos(radians(known_lat)) * cos(radians(geocoded_lat)) * pow(sin(radians(geocoded_lon - known_lon) / 2), 2))) AS km FROM {ledger})"""
_GT = """count(*) AS sample_size, round(median(score), 4) AS score_median, round(median(km), 4) AS dist_median_km, round(avg(km), 4) AS dist_mean_km, round(quantile_cont(km, 0.9), 4) AS dist_p90_km, round(max(km), 4) AS dist_max_km,
    round_even(100e0 * count(*) FILTER (km < 1) / count(*), 1) AS pct_lt_1km, round_even(100e0 * count(*) FILTER (km < 5) / count(*), 1) AS pct_lt_5km, round_even(100e0 * count(*) FILTER (km < 15) / count(*), 1) AS pct_lt_15km,
    round_even(100e0 * count(*) FILTER (km > 30) / count(*), 1) AS pct_gt_30km"""


def samples(t: Tables):
    km = haversine_km(F.col("known_lat"), F.col("known_lon"), F.col("geocoded_lat"), F.col("geocoded_lon"))
    return t.ledger.select("iso", "score", km.alias("km"))


@query(
    "ground_truth",
    with_views(
        "WITH " + SAMPLES.strip() + f" SELECT 'country' AS kind, iso AS slice, {_GT} FROM smp GROUP BY iso UNION ALL SELECT 'score', CASE WHEN score >= 95 THEN '>=95' WHEN score >= 90 THEN '90-95' ELSE '<90' END AS b, {_GT} FROM smp GROUP BY b"
    ),
)
def _ground_truth(t: Tables):
    rows = samples(t).withColumn("bucket", marts.score_range(F.col("score")))
    one = marts.ground_truth(rows, ["iso"]).withColumnRenamed("iso", "slice").withColumn("kind", F.lit("country"))
    two = marts.ground_truth(rows, ["bucket"]).withColumnRenamed("bucket", "slice").withColumn("kind", F.lit("score"))
    return one.unionByName(two)


@query(
    "geocoding_by_country",
    with_views(
        "WITH " + SAMPLES.strip() + f""", g AS (SELECT iso, {_GT} FROM smp GROUP BY 1), l AS (SELECT iso, count(*) AS processed_total, count(*) FILTER (target_type = 'compare') AS compare_total, count(*) FILTER (target_type = 'fill') AS fill_total,
          count(*) FILTER (geocode_precision = 'street') AS precision_street, count(*) FILTER (geocode_precision = 'centroid') AS precision_centroid, count(*) FILTER (geocode_precision = 'uncertain') AS precision_uncertain, {_LEDGER_COUNTS} FROM {{ledger}} GROUP BY 1)
        SELECT l.*, sample_size AS gt_sample_size, score_median AS gt_score_median, dist_median_km AS gt_dist_median, pct_lt_5km AS gt_pct_lt_5km FROM l JOIN g USING (iso)"""
    ),
)
def _by_country(t: Tables):
    return marts.geocoding_by_country(t.ledger, marts.ground_truth(samples(t), ["iso"]))


@query(
    "building_kinds",
    with_views(
        "WITH " + BUILDINGS.strip() + """ SELECT iso, count(*) AS n_total, count(*) FILTER (match_path <> 'D_synthetic') AS n_real, count(*) FILTER (match_path = 'D_synthetic') AS n_synthetic,
          round_even(100e0 * count(*) FILTER (match_path <> 'D_synthetic') / count(*), 1) AS pct_real, round_even(100e0 * count(*) FILTER (match_path = 'D_synthetic') / count(*), 1) AS pct_synthetic FROM matched GROUP BY 1"""
    ),
)
def _kinds(t: Tables):
    return marts.building_kinds(buildings(t).withColumnRenamed("adm0_pcode", "iso"))


@query(
    "building_outliers",
    """WITH r AS (SELECT 'B' || (o_custkey % 211) || CASE WHEN o_custkey % 2 = 0 THEN '_SYN_' ELSE '' END AS b, o_orderstatus AS q, o_orderkey AS seq, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS la FROM orders),
      l AS (SELECT b, q, count(*) AS n, min(seq) AS s FROM r GROUP BY ALL), g AS (SELECT b, count(*) AS n, arg_min(la, seq) FILTER (la IS NOT NULL) AS lat, arg_min(q, seq) AS iso FROM r GROUP BY 1),
      d AS (SELECT b, q, n AS top, row_number() OVER (PARTITION BY b ORDER BY n DESC, s) AS rn FROM l)
      SELECT b AS id_edificio, g.n AS n_schools, iso, lat, lat AS lon, q AS dominant_coordinate_quality, round_even(100e0 * top / g.n, 1) AS dominant_quality_pct, contains(b, '_SYN_') AS is_synthetic
      FROM g JOIN d USING (b) WHERE rn = 1 AND g.n >= 20 ORDER BY g.n DESC, b LIMIT 30""",
)
def _outliers(t: Tables):
    k = F.col("o_custkey")
    lat = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice"))
    rows = t.orders.select(
        F.concat(F.lit("B"), (k % 211).cast("string"), F.when(k % 2 == 0, "_SYN_").otherwise("")).alias("id_edificio"),
        F.col("o_orderstatus").alias("coordinate_quality"), F.col("o_orderkey").alias("row_seq"), lat.alias("latitud"), lat.alias("longitud"), F.col("o_orderstatus").alias("iso"),
    )
    return marts.building_outliers(rows)


@query(
    "source_checks",
    _reg(
        """, c AS (SELECT iso, count(*) AS t, count(*) FILTER (latitud IS NOT NULL AND longitud IS NOT NULL) AS g FROM reg GROUP BY 1)
        SELECT iso, 'coverage' AS dataset, iso IN ('ASIA', 'EUROPE') AS any_mismatch, CASE iso WHEN 'ASIA' THEN 'n_schools_in_file, n_georef' WHEN 'EUROPE' THEN 'n_georef' ELSE '' END AS mismatch_fields FROM c"""
    ),
)
def _checks(t: Tables):
    now = marts.build_summary(registry_table(t))
    stored = now.select(
        "iso", F.when(F.col("iso") == "ASIA", F.lit(None)).otherwise(F.col("total_k12")).alias("n_schools_in_file"),
        F.when(F.col("iso").isin("ASIA", "EUROPE"), F.col("georef") + 1).otherwise(F.col("georef")).alias("n_georef"),
    )
    return marts.source_check(now, stored, "coverage", {"n_schools_in_file": "total_k12", "n_georef": "georef"})


@query(
    "trace_status",
    """SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'private_addition' WHEN 1 THEN 'year_mismatch' WHEN 2 THEN 'aligned_to_legacy' ELSE 'something' END AS trace_bucket,
      CASE WHEN c_custkey % 5 = 0 THEN 'source_review_needed' ELSE CASE c_custkey % 4 WHEN 0 THEN 'methodological_difference' WHEN 1 THEN 'source_difference' WHEN 2 THEN 'match' ELSE 'needs_review' END END AS step01_reconciliation_status,
      CASE c_custkey % 4 WHEN 0 THEN 'private_inclusion' WHEN 1 THEN 'source_year_mismatch' WHEN 2 THEN 'aligned_to_legacy' ELSE 'unmapped' END AS step01_root_cause FROM customer""",
)
def _trace(t: Tables):
    k = F.col("c_custkey")
    rows = t.customer.select(
        k.alias("k"), F.when(k % 4 == 0, "private_addition").when(k % 4 == 1, "year_mismatch").when(k % 4 == 2, "aligned_to_legacy").otherwise("something").alias("trace_bucket"),
        F.when(k % 5 == 0, "True").otherwise("").alias("needs_source_owner_followup"),
    )
    out = marts.trace_status(rows)
    return marts.reconciliation_view(out, ["k", "trace_bucket", "step01_reconciliation_status", "step01_root_cause", "absent"])


@query(
    "scope_flags_and_funnel_ledger",
    _tg(
        """ SELECT l.iso, l.run_seq, c.pipeline_enabled, c.analysis_included FROM {ledger} l JOIN {country} c USING (iso)
        SEMI JOIN (SELECT * FROM funnel WHERE funnel_status IS NOT NULL) f ON f.iso = l.iso AND f.id_centro = l.id_centro"""
    ),
)
def _flags(t: Tables):
    kept = marts.in_funnel(t.ledger, marts.funnel_status(targets_of(t)))
    stale = kept.withColumns({"pipeline_enabled_x": F.lit(False), "analysis_included": F.lit(False)})
    return marts.attach_scope_flags(stale, t.country).select("iso", "run_seq", "pipeline_enabled", "analysis_included")


@query(
    "box_subset",
    with_views("SELECT tile_seq, iso FROM {tile} WHERE lon BETWEEN 4.2 AND 9.1 AND lat BETWEEN 19 AND 19.75"),
)
def _subset(t: Tables):
    return marts.box_subset(t.tile, (4.2, 19.0, 9.1, 19.75)).select("tile_seq", "iso")


#: Marts of the bundle, each a query of its own with its own check.
BUNDLED = (
    "country_summary", "scope_totals", "quality_totals", "quality_rollup", "build_summary", "coverage", "inclusion_share",
    "funnel_counts", "geocoding_by_country", "building_kinds", "ground_truth",
)


def _bundle_sql() -> str:
    """Every field of every record of the marts, by the checks of their own queries."""
    parts = [
        f"SELECT '{name}' AS mart, j.key AS field, try_cast(json_extract_string(j.value, '$') AS double) AS number, json_extract_string(j.value, '$') AS shown FROM ({ORACLES[name]}) m, json_each(to_json(m)) j"
        for name in BUNDLED
    ]
    return f"SELECT mart, field, round(number, 6) AS number, CASE WHEN number IS NULL THEN shown END AS word FROM ({' UNION ALL '.join(parts)}) WHERE shown IS NOT NULL"


@query("mart_bundle", _bundle_sql())
def _bundle(t: Tables):
    """The marts of a report as one table of JSON records, here field by field. The finalised
    registry is computed once, and the country summary once for the marts that add it up."""
    share_registry(t)
    registry = registry_table(t)
    country = cut_lineage(marts.country_summary(registry, _countries(t)))
    k12 = registry.filter("nivel_primaria + nivel_secbaja + nivel_secalta > 0")
    parts = {
        "country_summary": country, "scope_totals": marts.scope_totals(country), "quality_totals": marts.quality_totals(country),
        "quality_rollup": marts.rollup_totals(country), "build_summary": marts.build_summary(registry), "coverage": _coverage(t, registry),
        "inclusion_share": marts.inclusion_share(registry, k12), "funnel_counts": _funnel_counts(t), "geocoding_by_country": _by_country(t),
        "building_kinds": _kinds(t), "ground_truth": _ground_truth(t),
    }
    records = tables.bundle({name: parts[name] for name in BUNDLED})
    fields = records.select("mart", F.explode(F.from_json("record", "map<string, string>")).alias("field", "shown")).filter("shown IS NOT NULL")
    number = F.expr("try_cast(shown AS double)")
    return fields.select("mart", "field", F.round(number, 6).alias("number"), F.when(number.isNull(), F.col("shown")).alias("word"))


@query(
    "country_info",
    _tg(
        """, p AS (SELECT iso, count(*) FILTER (raw AND (missing OR zeros)) AS n_pending_missing FROM tg GROUP BY 1)
        SELECT iso, CASE rk % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS type, CASE rk % 3 WHEN 2 THEN '—' ELSE 'provincia' || CASE WHEN rk = 3 THEN ', distrito' ELSE '' END END AS raw_admin_levels_es,
          CASE rk % 3 WHEN 0 THEN 'Sí' ELSE 'No' END AS has_addresses_label_es,
          CASE final_match_level WHEN 'adm2' THEN 'ADM2 (la unidad más fina disponible)' WHEN 'adm1' THEN 'ADM1 (provincia / departamento / región)' WHEN 'spatial_only' THEN 'verificación espacial (la coordenada debe caer dentro de algún polígono del país)'
            ELSE 'solo bounding box del país' END AS validation_level_es, n_pending_missing FROM {country} JOIN p USING (iso)"""
    ),
)
def _info(t: Tables):
    share_registry(t)
    rk = F.col("rk")
    info = t.country.select(
        "iso", (rk % 3 == 0).alias("has_addresses"), F.when(rk % 3 != 2, "provincia").alias("raw_adm1_label"), F.when(rk == 3, "distrito").alias("raw_adm2_label"), F.lit(None).cast("string").alias("raw_locality_label")
    )
    totals = marts.build_summary(registry_table(t)).select("iso", F.col("total_k12").alias("n_schools"))
    out = marts.country_info(info, t.country.select("iso", "final_match_level"), marts.target_summary(targets_of(t)), totals)
    return out.select("iso", "type", "raw_admin_levels_es", "has_addresses_label_es", "validation_level_es", "n_pending_missing")


# ---- gap filling ---------------------------------------------------------------------------------

GAPS = TARGETS + """,
    gt AS (SELECT iso, id_centro, CASE WHEN missing OR zeros THEN 'fill' ELSE 'compare' END AS target_type, latitud AS olat, longitud AS olon FROM tg WHERE raw AND (missing OR zeros OR oob OR mism OR diff_addr OR cent)),
    ad AS (SELECT id_centro, adm0_pcode AS iso, CASE WHEN raw_street = 's/n' THEN '' ELSE raw_street END AS street, raw_locality AS loc, CASE WHEN raw_adm2 = 'nan' THEN '' ELSE raw_adm2 END AS a2, raw_adm1 AS a1, raw_adm1_code AS dc, raw_adm2 AS d2 FROM {address}),
    qs AS (
      SELECT g.iso, g.id_centro, 0 AS ord, 'street' AS prec, street || ', ' || a2 || ', ' || a1 || ', ' || g.iso AS query FROM gt g JOIN ad USING (iso, id_centro) WHERE street <> '' AND a1 <> '' AND a2 <> ''
      UNION ALL SELECT g.iso, g.id_centro, 2, 'locality', loc || ', ' || a2 || ', ' || a1 || ', ' || g.iso FROM gt g JOIN ad USING (iso, id_centro) WHERE a1 <> '' AND a2 <> ''
      UNION ALL SELECT g.iso, g.id_centro, 3, 'admin', a2 || ', ' || a1 || ', ' || g.iso FROM gt g JOIN ad USING (iso, id_centro) WHERE a1 <> '' AND a2 <> ''),
    allq AS (SELECT DISTINCT street || ', ' || a2 || ', ' || a1 || ', ' || iso AS query FROM ad UNION SELECT DISTINCT loc || ', ' || a2 || ', ' || a1 || ', ' || iso FROM ad UNION SELECT DISTINCT a2 || ', ' || a1 || ', ' || iso FROM ad),
    cache AS (SELECT query, length(query) % 3 <> 0 AS hit, b.y0 + 0.5e0 + (length(query) % 7) / 2e0 AS lat, b.x0 + 0.25e0 + (length(query) * 7 % 11) / 3.1e0 AS lon, CASE WHEN length(query) % 5 = 0 THEN NULL ELSE 85e0 + length(query) % 16 END AS score
      FROM allq JOIN {box} b ON contains(query, lower(b.n_name) || ', ' || b.iso)),
    ans AS (SELECT qs.iso, qs.id_centro, arg_min(c.lat, ord) AS lat, arg_min(c.lon, ord) AS lon, arg_min(prec, ord) AS qp, min(ord) AS o FROM qs JOIN cache c ON c.query = qs.query AND c.hit GROUP BY 1, 2),
    sc1 AS (SELECT a.*, c.score FROM ans a JOIN qs ON qs.iso = a.iso AND qs.id_centro = a.id_centro AND qs.ord = a.o JOIN cache c ON c.query = qs.query),
    rs0 AS (SELECT g.*, s.lat, s.lon, CASE WHEN g.id_centro NOT IN (SELECT id_centro FROM qs) THEN 'no_address' WHEN s.lat IS NULL THEN 'failed' WHEN score >= 95 THEN 'street' WHEN score >= 90 THEN 'centroid' WHEN score IS NOT NULL THEN 'uncertain'
      WHEN qp = 'admin' THEN 'centroid' ELSE 'uncertain' END AS p0 FROM gt g LEFT JOIN sc1 s USING (iso, id_centro)),
    rs AS (SELECT *, CASE WHEN p0 = 'street' AND count(*) OVER (PARTITION BY iso, round_even(lat, 3), round_even(lon, 3)) >= 5 THEN 'centroid' ELSE p0 END AS prec FROM rs0),
    loc2 AS (
      SELECT iso, id_centro, side, arg_min('N' || k.nk, k.nk) AS c1, arg_min(b.n_name, k.nk) AS n1, arg_min(CASE WHEN y - k.y0 < x - k.x0 THEN b.n_name || ' East' WHEN y - k.y0 > x - k.x0 THEN b.n_name || ' West' END, k.nk) AS n2
      FROM (SELECT iso, id_centro, 'g' AS side, lat AS y, lon AS x FROM rs WHERE lat IS NOT NULL UNION ALL SELECT iso, id_centro, 'o', olat, olon FROM rs WHERE olat IS NOT NULL AND olat <> 0) p
      JOIN {corner} k USING (iso) JOIN {box} b ON b.nk = k.nk WHERE x > k.x0 AND x < k.x1 AND y > k.y0 AND y < k.y1 GROUP BY 1, 2, 3),
    ck AS (
      SELECT r.*, policy, coalesce(g.n1, '') AS gn1, coalesce(g.n2, '') AS gn2, coalesce(o.n1, '') AS on1, coalesce(o.n2, '') AS on2, g.c1 AS gc, o.c1 AS oc, ad.a1, ad.d2, ad.dc, r.olat IS NOT NULL AND r.olat <> 0 AS has_o
      FROM rs r LEFT JOIN (SELECT * FROM loc2 WHERE side = 'g') g USING (iso, id_centro) LEFT JOIN (SELECT * FROM loc2 WHERE side = 'o') o USING (iso, id_centro) LEFT JOIN ad USING (iso, id_centro)
      JOIN (SELECT iso, final_match_level AS policy FROM {country}) USING (iso)),
    v1 AS (SELECT *,
      CASE WHEN dc <> '' AND gc IS NOT NULL THEN CASE WHEN dc = gc THEN 'MATCH' ELSE 'MISMATCH' END ELSE @GA1@ END AS ga1, @GA2@ AS ga2,
      CASE WHEN NOT has_o THEN 'NO_DATA' WHEN dc <> '' AND oc IS NOT NULL THEN CASE WHEN dc = oc THEN 'MATCH' ELSE 'MISMATCH' END ELSE @OA1@ END AS oa1, CASE WHEN NOT has_o THEN 'NO_DATA' ELSE @OA2@ END AS oa2 FROM ck),
    v2 AS (SELECT *, CASE WHEN policy = 'adm2' THEN ga2 IN ('MATCH', 'PARTIAL') ELSE ga1 IN ('MATCH', 'PARTIAL') END AS best, ga1 IN ('MATCH', 'PARTIAL') AS dept FROM v1),
    verdicts AS (SELECT *, CASE WHEN lat IS NULL THEN '' WHEN policy IN ('adm1', 'adm2') AND ga1 = 'MISMATCH' THEN 'REJECT' WHEN prec = 'uncertain' THEN CASE WHEN target_type = 'fill' THEN 'REJECT' ELSE 'FLAG' END
      WHEN target_type = 'fill' THEN CASE WHEN prec = 'street' AND best THEN 'ACCEPT' WHEN policy = 'adm2' AND prec = 'street' AND dept THEN 'ACCEPT_WITH_FLAG' WHEN prec = 'centroid' AND (best OR dept) THEN 'ACCEPT_CENTROID' ELSE 'REJECT' END
      WHEN CASE WHEN policy = 'adm2' THEN oa2 IN ('MATCH', 'PARTIAL') ELSE oa1 IN ('MATCH', 'PARTIAL') END THEN 'KEEP_ORIGINAL' ELSE 'FLAG' END AS acceptance FROM v2)"""


def _strict(a: str, b: str) -> str:
    a, b = f"lower({a})", f"lower({b})"
    return (
        f"CASE WHEN {a} = '' OR {b} = '' THEN 'NO_DATA' WHEN {a} = {b} THEN 'MATCH' WHEN (contains({a}, {b}) OR contains({b}, {a})) "
        f"AND least(length({a}), length({b})) / greatest(length({a}), length({b})) > 0.8 THEN 'PARTIAL' ELSE 'MISMATCH' END"
    )


_GAPS_SQL = GAPS
for _mark, _sql in (
    ("@GA1@", _strict("a1", "gn1")), ("@GA2@", _strict("d2", "gn2")), ("@OA1@", _strict("a1", "on1")), ("@OA2@", _strict("d2", "on2")),
):
    _GAPS_SQL = _GAPS_SQL.replace(_mark, _sql)


def gap_results(t: Tables):
    share_registry(t)
    targets = targets_of(t).filter("coordinate_source IN ('', 'original')")
    is_fill = F.col("missing") | F.col("zeros")
    wanted = targets.filter(is_fill | F.col("out_of_bounds") | F.col("mismatches") | F.col("dup_addr") | F.col("centroids")).select(
        "iso", "id_centro", F.when(is_fill, "fill").otherwise("compare").alias("target_type")
    )
    everyone = t.address.withColumnRenamed("adm0_pcode", "iso").withColumn("nombre_centro", F.lit(""))
    asked = fill.query_cascade(everyone, F.col("iso")).select("query").distinct()
    n = F.length("query")
    # a query ends with the first level unit and the country
    place = F.substring_index("query", ", ", -2)
    boxes = t.box.withColumn("_place", F.concat(F.lower("n_name"), F.lit(", "), F.col("iso")))
    cache = asked.withColumn("_place", place).join(boxes, "_place").select(
        "query", (n % 3 != 0).alias("hit"), (F.col("y0") + 0.5 + (n % 7) / F.lit(2.0)).alias("lat"),
        (F.col("x0") + 0.25 + (n * 7 % 11) / F.lit(3.1)).alias("lon"), F.lit("arcgis").alias("source"), F.when(n % 5 != 0, 85.0 + n % 16).alias("score"),
    )
    policies = t.country.select("iso", "final_match_level")
    return fill.gap_fill_results(registry_table(t), wanted, t.address, cache, t.boundary, t.edge, policies, F.col("iso"))


@query(
    "gap_fill_results",
    with_views(
        "WITH " + _GAPS_SQL.strip() + """ SELECT iso, id_centro, target_type, prec AS geocode_precision, round(lat, 6) AS geocoded_lat, CASE WHEN lat IS NULL THEN '' ELSE ga1 END AS geo_adm1_check,
          CASE WHEN lat IS NULL THEN '' ELSE ga2 END AS geo_adm2_check, CASE WHEN lat IS NULL THEN '' ELSE oa2 END AS orig_adm2_check, acceptance FROM verdicts"""
    ),
)
def _gap(t: Tables):
    return gap_results(t).select(
        "iso", "id_centro", "target_type", "geocode_precision", F.round("geocoded_lat", 6).alias("geocoded_lat"), "geo_adm1_check", "geo_adm2_check", "orig_adm2_check", "acceptance"
    )


@query(
    "gap_fill_applied",
    with_views(
        "WITH " + _GAPS_SQL.strip() + """ SELECT r.id_centro, round(CASE WHEN v.acceptance LIKE 'ACCEPT%' AND v.target_type = 'fill' THEN v.lat ELSE r.latitud END, 6) AS latitud,
          CASE WHEN v.acceptance LIKE 'ACCEPT%' AND v.target_type = 'fill' THEN 'geocoded' WHEN v.target_type = 'compare' AND v.lat IS NOT NULL THEN 'original' ELSE
            CASE WHEN r.coordinate_source = '' AND r.latitud <> 0 AND r.longitud <> 0 THEN 'original' ELSE r.coordinate_source END END AS coordinate_source,
          CASE WHEN (v.acceptance LIKE 'ACCEPT%' AND v.target_type = 'fill') OR (v.target_type = 'compare' AND v.lat IS NOT NULL) THEN '' ELSE r.q END AS coordinate_quality
        FROM reg r LEFT JOIN verdicts v USING (iso, id_centro)"""
    ),
)
def _applied(t: Tables):
    results = gap_results(t)
    out = fill.apply_decisions(registry_table(t), results)
    return out.select("id_centro", F.round("latitud", 6).alias("latitud"), "coordinate_source", "coordinate_quality")


@query(
    "centroid_fill",
    with_views(
        """WITH m AS (SELECT adm0_pcode AS iso, id_centro FROM {school} WHERE latitud IS NULL), a AS (SELECT adm0_pcode AS iso, id_centro, lower(raw_adm1) AS a1, lower(raw_locality) AS l FROM {address}),
        c AS (SELECT iso, lower(n_name) AS a1, 'loc ' || i AS l, y0 + i / 9e0 AS lat, x0 + i / 9e0 AS lon, i * 50e0 AS area FROM {box}, (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS i))
        SELECT m.iso, m.id_centro, a1 || '||' || l AS centroid_key, round(lat, 6) AS centroid_lat, round(lon, 6) AS centroid_lon, CASE WHEN lat IS NOT NULL THEN CASE WHEN area > 314 THEN 'high' ELSE 'normal' END END AS qc_centroid_bias,
          CASE WHEN lat IS NULL THEN 'centroid_not_found' END AS motivo FROM m JOIN a USING (iso, id_centro) LEFT JOIN c USING (iso, a1, l)"""
    ),
)
def _centroids(t: Tables):
    i = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i")
    lookup = t.box.select("iso", "n_name", "x0", "y0", i).select(
        "iso", F.col("n_name").alias("unit"), F.concat(F.lit("Loc "), F.col("i").cast("string")).alias("place"),
        (F.col("y0") + F.col("i") / F.lit(9.0)).alias("centroid_lat"), (F.col("x0") + F.col("i") / F.lit(9.0)).alias("centroid_lon"), (F.col("i") * 50.0).alias("area_km2"),
    )
    out = fill.centroid_fill(t.school.withColumnRenamed("adm0_pcode", "iso"), t.address, lookup, ["raw_adm1", "raw_locality"], ["unit", "place"])
    return out.withColumns({c: F.round(c, 6) for c in ("centroid_lat", "centroid_lon")})


@query(
    "centroids_applied",
    with_views(
        """WITH a AS (SELECT adm0_pcode AS iso, id_centro, lower(raw_adm1) AS a1, lower(raw_locality) AS l FROM {address}),
        c AS (SELECT iso, lower(n_name) AS a1, 'loc ' || i AS l, y0 + i / 9e0 AS lat, x0 + i / 9e0 AS lon FROM {box}, (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS i))
        SELECT s.adm0_pcode AS iso, s.id_centro, round(CASE WHEN s.latitud IS NULL THEN lat ELSE s.latitud END, 6) AS latitud,
          round(CASE WHEN s.latitud IS NULL AND lat IS NOT NULL THEN lon ELSE s.longitud END, 6) AS longitud,
          CASE WHEN s.latitud IS NULL AND lat IS NOT NULL THEN 'centroid_cascade' ELSE s.coordinate_source END AS coordinate_source,
          CASE WHEN s.latitud IS NULL AND lat IS NOT NULL THEN 'ACCEPT_CENTROID' ELSE s.acceptance END AS acceptance
        FROM {school} s LEFT JOIN a ON a.iso = s.adm0_pcode AND a.id_centro = s.id_centro LEFT JOIN c ON c.iso = a.iso AND c.a1 = a.a1 AND c.l = a.l"""
    ),
)
def _centroids_applied(t: Tables):
    """The whole registry with the matched centroids written in."""
    registry = t.school.withColumnRenamed("adm0_pcode", "iso")
    out = fill.apply_centroids(registry, _centroids(t))
    return out.select("iso", "id_centro", *[F.round(c, 6).alias(c) for c in ("latitud", "longitud")], "coordinate_source", "acceptance")


@query(
    "answers_within_margin",
    with_views(
        """SELECT adm0_pcode AS iso, id_centro FROM {school} JOIN {country} ON iso = adm0_pcode
        WHERE latitud BETWEEN lat_min - 1 AND lat_max + 1 AND longitud BETWEEN lon_min - 1 AND lon_max + 1"""
    ),
)
def _within(t: Tables):
    answers = t.school.select(F.col("adm0_pcode").alias("iso"), "id_centro", F.col("latitud").alias("lat"), F.col("longitud").alias("lon"))
    boxes = t.country.select("iso", "lat_min", "lat_max", "lon_min", "lon_max")
    return fill.within_margin(answers, boxes).select("iso", "id_centro")


@query(
    "refreshed_compare",
    with_views(
        """WITH r AS (SELECT s.adm0_pcode AS iso, id_centro, row_seq AS k, latitud_geocoded AS la, longitud_geocoded AS lo FROM {school} s WHERE latitud_geocoded IS NOT NULL AND coordinate_source IN ('', 'original'))
        SELECT iso, id_centro, CASE WHEN b.n_name IS NULL THEN '' ELSE b.n_name END AS geocoded_in_adm1 FROM r LEFT JOIN {corner} k ON k.iso = r.iso AND lo > x0 AND lo < x1 AND la > y0 AND la < y1 LEFT JOIN {box} b ON b.nk = k.nk AND b.iso = r.iso""".replace(
            "SELECT iso, id_centro, CASE", "SELECT r.iso, r.id_centro, CASE"
        )
    ),
)
def _refreshed(t: Tables):
    rows = t.school.withColumnRenamed("adm0_pcode", "iso").withColumns(
        {"geocode_source": F.lit(""), "arcgis_score": F.lit(None).cast("double")}
    )
    out = fill.refresh_compare(rows, t.address, t.boundary, t.edge, t.country.select("iso", "final_match_level"))
    return out.select("iso", "id_centro", "geocoded_in_adm1")
