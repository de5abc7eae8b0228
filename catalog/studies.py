"""Queries of the wealth-against-poverty study."""

from __future__ import annotations

from pyspark.sql import functions as F

from access_spark.operators import bootstrap, spatial, study
from access_spark.plans import study as plan
from catalog.domain import Tables, with_views
from catalog.registry import query

UNITS = """
    w AS (SELECT iso, k AS tile_seq, box_lat + off_lat AS lat, box_lon + off_lon AS lon, c_acctbal / 1047.1975e0 AS rwi, (k % 10) / 10.471975e0 AS rwi_error, k * 7 % 50 AS row, k * 13 % 60 AS col FROM {school_base}),
    p AS (SELECT w.iso, w.tile_seq, any_value(w.lat) AS lat, any_value(w.lon) AS lon, any_value(rwi) AS rwi, any_value(rwi_error) AS er, coalesce(sum(greatest(coalesce(f.value, 0), 0)), 0) AS pop
      FROM w LEFT JOIN {fine} f ON f.iso = w.iso AND f.row BETWEEN w.row - 2 AND w.row + 2 AND f.col BETWEEN w.col - 2 AND w.col + 2 GROUP BY 1, 2),
    i AS (SELECT p.*, 'N' || nk || CASE WHEN lat - y0 < lon - x0 THEN 'E' ELSE 'W' END AS unit FROM p JOIN {corner} k ON k.iso = p.iso AND lon > x0 AND lon < x1 AND lat > y0 AND lat < y1 AND (lat - y0) <> (lon - x0)),
    m AS (SELECT iso, unit, count(*) AS n, sum(pop) AS sw, CASE WHEN sum(pop) > 0 THEN sum(pop * rwi) / sum(pop) END AS mean, avg(rwi) AS um, avg(er) AS em FROM i GROUP BY 1, 2),
    v AS (SELECT iso, unit, CASE WHEN sum(pop) > 0 THEN sum(pop * (rwi - mean) * (rwi - mean)) / sum(pop) END AS var FROM i JOIN m USING (iso, unit) GROUP BY 1, 2)"""


# a divisor that puts no mean on the border of two roundings
def tiles_of(t: Tables):
    k = F.col("k")
    return t.school_base.select(
        "iso", k.alias("tile_seq"), (F.col("box_lat") + F.col("off_lat")).alias("lat"), (F.col("box_lon") + F.col("off_lon")).alias("lon"),
        (F.col("c_acctbal") / 1047.1975).alias("rwi"), ((k % 10) / F.lit(10.471975)).alias("rwi_error"), (k * 7 % 50).alias("row"), (k * 13 % 60).alias("col"),
    )


def units_of(t: Tables):
    return plan.wealth_by_unit(tiles_of(t), t.fine, t.boundary, t.edge, 2, 2)


@query(
    "wealth_by_unit",
    with_views(
        "WITH " + UNITS.strip() + """ SELECT b.pcode AS adm2_pcode, coalesce(n, 0) AS n_cells, round(coalesce(sw, 0), 4) AS pop_total, round(mean, 6) AS weighted_mean, round(var, 6) AS weighted_var,
          round(um, 6) AS unweighted_mean, round(em, 6) AS error_mean FROM (SELECT * FROM {boundary} WHERE level = 2) b LEFT JOIN m ON m.unit = b.pcode LEFT JOIN v ON v.unit = b.pcode"""
    ),
)
def _units(t: Tables):
    return units_of(t).select(
        "adm2_pcode", "n_cells", F.round("pop_total", 4).alias("pop_total"),
        *[F.round(c, 6).alias(c) for c in ("weighted_mean", "weighted_var", "unweighted_mean", "error_mean")],
    )


@query(
    "weighted_stats",
    """WITH m AS (SELECT p_brand, count(*) AS n_cells, sum(p_retailprice) AS pop_total, sum(p_retailprice * p_size) / sum(p_retailprice) AS wm, avg(p_size) AS um, avg(p_partkey) AS em FROM (SELECT * REPLACE (p_size / 10.471975e0 AS p_size, p_partkey / 10.471975e0 AS p_partkey) FROM part) GROUP BY 1)
      SELECT p_brand, any_value(n_cells) AS n_cells, round(any_value(pop_total), 4) AS pop_total, round(any_value(wm), 6) AS weighted_mean, round(any_value(um), 6) AS unweighted_mean, round(any_value(em), 6) AS error_mean,
        round(sum(p_retailprice * (p_size - wm) * (p_size - wm)) / sum(p_retailprice), 6) AS weighted_var FROM (SELECT * REPLACE (p_size / 10.471975e0 AS p_size) FROM part) JOIN m USING (p_brand) GROUP BY 1""",
)
def _weighted(t: Tables):
    out = study.weighted_stats(t.part.withColumns({c: F.col(c) / 10.471975 for c in ("p_size", "p_partkey")}), ["p_brand"], "p_size", "p_partkey", "p_retailprice")
    return out.select("p_brand", "n_cells", F.round("pop_total", 4).alias("pop_total"), *[F.round(c, 6).alias(c) for c in ("weighted_mean", "unweighted_mean", "error_mean", "weighted_var")])


def pairs(t: Tables):
    k = F.col("p_partkey")
    return t.part.select(
        F.col("p_brand").alias("iso"), k.alias("unit_id"), F.col("p_size").cast("double").alias("wealth"),
        F.when(k % 7 != 0, (k * 31 % 83) - F.col("p_size") * 1.5).alias("poverty"),
    )


PAIRS = "pr AS (SELECT p_brand AS iso, p_partkey AS k, p_size::double AS w, (p_partkey * 31 % 83) - p_size * 1.5e0 AS p FROM part WHERE p_partkey % 7 <> 0)"


@query(
    "correlations",
    f"""WITH {PAIRS}, r AS (SELECT *, (rank() OVER (PARTITION BY iso ORDER BY w) + count(*) OVER (PARTITION BY iso, w) / 2.0 - 0.5) AS rw, (rank() OVER (PARTITION BY iso ORDER BY p) + count(*) OVER (PARTITION BY iso, p) / 2.0 - 0.5) AS rp FROM pr)
      SELECT iso, count(*) AS n, round(corr(rw, rp), 6) AS spearman_rho, round(corr(w, p), 6) AS pearson_r FROM r GROUP BY 1""",
)
def _correlations(t: Tables):
    out = study.correlations(pairs(t), ["iso"], "wealth", "poverty")
    return out.select("iso", "n", F.round("spearman_rho", 6).alias("spearman_rho"), F.round("pearson_r", 6).alias("pearson_r"))


DECILES = PAIRS + """,
    e AS (SELECT iso, list_distinct(quantile_cont(-w, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS ew, list_distinct(quantile_cont(p, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS ep FROM pr GROUP BY 1),
    d AS (SELECT iso, greatest(len(list_filter(ew, lambda x: x < -w)), 1) AS dw, greatest(len(list_filter(ep, lambda x: x < p)), 1) AS dp FROM pr JOIN e USING (iso))"""


@query("decile_crosstab", f"WITH {DECILES} SELECT iso, dw AS rwi_decile, dp AS pov_decile, count(*) AS n FROM d GROUP BY ALL")
def _crosstab(t: Tables):
    return study.decile_crosstab(pairs(t), ["iso"], "wealth", "poverty")


DRAWS = """
    bits AS (SELECT iso, w AS x, p AS y, draw, ('0x' || substr(md5(concat_ws('|', cast(k AS varchar), cast(draw AS varchar), '42')), 1, 10))::BIGINT AS b FROM pr, (SELECT unnest(range(1, 1001)) AS draw)),
    ws AS (SELECT iso, x, y, draw, len(list_filter(@BORDERS@, lambda e: e <= b)) AS w FROM bits),
    rk AS (SELECT iso, draw, w, sum(w) OVER (PARTITION BY iso, draw ORDER BY x) - (sum(w) OVER (PARTITION BY iso, draw, x) - 1) / 2e0 AS a,
      sum(w) OVER (PARTITION BY iso, draw ORDER BY y) - (sum(w) OVER (PARTITION BY iso, draw, y) - 1) / 2e0 AS c FROM ws WHERE w > 0),
    sm AS (SELECT iso, draw, sum(w) AS sw, sum(w * a) AS sa, sum(w * c) AS sc, sum(w * a * c) AS sac, sum(w * a * a) AS saa, sum(w * c * c) AS scc FROM rk GROUP BY ALL),
    rh AS (SELECT iso, CASE WHEN saa - sa * sa / sw > 0 AND scc - sc * sc / sw > 0 THEN (sac - sa * sc / sw) / sqrt((saa - sa * sa / sw) * (scc - sc * sc / sw)) END AS rho FROM sm)""".replace(
    "@BORDERS@", str(bootstrap.poisson_borders())
)


@query(
    "bootstrap_interval",
    f"WITH {PAIRS}, {DRAWS.strip()} SELECT iso, round(quantile_cont(rho, 0.025), 6) AS spearman_ci_lo, round(quantile_cont(rho, 0.975), 6) AS spearman_ci_hi FROM rh GROUP BY 1",
)
def _bootstrap(t: Tables):
    """Percentile interval of 1,000 resampled correlations."""
    out = bootstrap.bootstrap_interval(pairs(t), ["iso"], "wealth", "poverty")
    return out.select("iso", F.round("spearman_ci_lo", 6).alias("spearman_ci_lo"), F.round("spearman_ci_hi", 6).alias("spearman_ci_hi"))


# over pr (iso with target, k, w, p): the tail of Student's t by its finite sums, from logarithms of factorials
TESTED = f"""
    {DRAWS.strip()},
    ci AS (SELECT iso, quantile_cont(rho, 0.025) AS lo, quantile_cont(rho, 0.975) AS hi FROM rh GROUP BY 1),
    rr AS (SELECT *, (rank() OVER (PARTITION BY iso ORDER BY w) + count(*) OVER (PARTITION BY iso, w) / 2.0 - 0.5) AS rw, (rank() OVER (PARTITION BY iso ORDER BY p) + count(*) OVER (PARTITION BY iso, p) / 2.0 - 0.5) AS rp FROM pr),
    co AS (SELECT iso, count(*) AS n, CASE WHEN min(w) < max(w) AND min(p) < max(p) THEN corr(rw, rp) END AS a, CASE WHEN min(w) < max(w) AND min(p) < max(p) THEN corr(w, p) END AS b FROM rr GROUP BY 1 HAVING count(*) >= 2),
    qe AS (SELECT iso, list_distinct(quantile_cont(w, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS ew, list_distinct(quantile_cont(p, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS ep FROM pr GROUP BY 1),
    qd AS (SELECT iso, abs(11 - greatest(len(list_filter(ew, lambda z: z < w)), 1) - greatest(len(list_filter(ep, lambda z: z < p)), 1)) AS gap FROM pr JOIN qe USING (iso)),
    ag AS (SELECT iso, avg(cast(gap = 0 AS int)) AS same, avg(cast(gap <= 1 AS int)) AS near FROM qd GROUP BY 1),
    tl AS (SELECT iso, side, n - 2 AS df, abs(CASE side WHEN 'a' THEN a ELSE b END) AS r FROM co, (SELECT unnest(['a', 'b']) AS side)),
    pv AS (SELECT iso, side, CASE WHEN df >= 1 AND r IS NOT NULL THEN greatest(0, 1 - CASE WHEN df % 2 = 0
        THEN r * coalesce(list_sum(list_transform(range(0, df // 2), lambda j: exp(lgamma(2 * j + 1) - 2 * lgamma(j + 1) - j * ln(4)) * pow(greatest(1 - r * r, 0), j))), 0)
        ELSE 2 / pi() * (asin(least(r, 1)) + r * sqrt(greatest(1 - r * r, 0)) * coalesce(list_sum(list_transform(range(0, (df - 1) // 2), lambda j: exp(j * ln(4) + 2 * lgamma(j + 1) - lgamma(2 * j + 2)) * pow(greatest(1 - r * r, 0), j))), 0)) END) END AS tail FROM tl)
    SELECT split_part(co.iso, '|', 1) AS iso, split_part(co.iso, '|', 2) AS target, n, round(a, 6) AS spearman_rho, round(b, 6) AS pearson_r, round(x.tail, 6) AS spearman_p, round(y.tail, 6) AS pearson_p,
      round(lo, 6) AS spearman_ci_lo, round(hi, 6) AS spearman_ci_hi, round(same, 6) AS decile_exact_match, round(near, 6) AS decile_within_one
    FROM co JOIN pv x ON x.iso = co.iso AND x.side = 'a' JOIN pv y ON y.iso = co.iso AND y.side = 'b' LEFT JOIN ci ON ci.iso = co.iso LEFT JOIN ag ON ag.iso = co.iso"""

TARGETS = """pr AS (SELECT iso || '|POVERTY_RATE' AS iso, k, w, poverty_rate::double AS p FROM tested WHERE poverty_rate IS NOT NULL
      UNION ALL SELECT iso || '|NBI_RATE', k, w, nbi_rate::double FROM tested WHERE nbi_rate IS NOT NULL)"""


def _rounded_tests(tests):
    return tests.select("iso", "target", "n", *[F.round(c, 6).alias(c) for c in tests.columns if c not in ("iso", "target", "n")])


@query(
    "correlation_tests",
    with_views(
        "WITH " + UNITS.strip() + f""",
    tested AS (SELECT m.iso, unit AS k, mean AS w, poverty_rate, nbi_rate FROM m JOIN {{poverty}} ON {{poverty}}.iso = m.iso AND adm2_pcode = unit WHERE n >= 5 AND sw > 0),
    {TARGETS}, {TESTED.strip()}"""
    ),
)
def _tests(t: Tables):
    """The study's test table on the units of every country, interval included."""
    return _rounded_tests(plan.correlation_tests(units_of(t), t.poverty))


@query(
    "correlation_tests_many_units",
    f"""WITH tested AS (SELECT p_brand AS iso, 'U' || p_partkey AS k, p_size::double AS w, CASE WHEN p_partkey % 7 <> 0 THEN (p_partkey * 31 % 83) - p_size * 1.5e0 END AS poverty_rate,
      CASE WHEN p_partkey % 3 = 0 THEN p_partkey * 17 % 61 END AS nbi_rate FROM part WHERE p_partkey % 12 >= 5 AND p_partkey % 17 <> 0),
    {TARGETS}, {TESTED.strip()}""",
)
def _many_units(t: Tables):
    """The same table where a country has many units: some too small or without people."""
    k = F.col("p_partkey")
    unit = F.concat(F.lit("U"), k.cast("string")).alias("adm2_pcode")
    units = t.part.select(
        F.col("p_brand").alias("iso"), unit, (k % 12).alias("n_cells"), F.when(k % 17 != 0, F.col("p_retailprice")).otherwise(0.0).alias("pop_total"),
        F.col("p_size").cast("double").alias("weighted_mean"),
    )
    poverty = t.part.select(
        F.col("p_brand").alias("iso"), unit, F.when(k % 7 != 0, (k * 31 % 83) - F.col("p_size") * 1.5).alias("poverty_rate"),
        F.when(k % 3 == 0, k * 17 % 61).alias("nbi_rate"),
    )
    return _rounded_tests(plan.correlation_tests(units, poverty))


@query(
    "strongest_target",
    """WITH a AS (SELECT n_name AS iso, n_nationkey AS k, count(*) AS n, sum(c_custkey % 97) % 100 AS h FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2),
      t AS (SELECT iso, k, n, -(h % 90) / 100e0 AS p, (h * 7 % 90) / 100e0 AS b FROM a),
      s AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'no_rwi_data' WHEN k % 7 = 0 THEN 'no_adm2_polygons' WHEN k % 11 = 0 THEN 'no_poverty_data' WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'blocked' ELSE 'pending' END ELSE 'completed' END AS st, abs(p) >= b AS first FROM t)
      SELECT iso, st AS status, CASE WHEN st = 'completed' THEN CASE WHEN first THEN 'POVERTY_RATE' ELSE 'NBI_RATE' END END AS target_used, CASE WHEN st = 'completed' THEN n END AS n,
        CASE WHEN st = 'completed' THEN CASE WHEN first THEN p ELSE b END END AS spearman_rho, CASE WHEN st = 'completed' THEN 50e0 END AS decile_within_one, CASE WHEN st = 'completed' THEN round(CASE WHEN first THEN p * p ELSE b * b END, 3) END AS r2,
        CASE WHEN st = 'completed' THEN CASE WHEN first THEN 'NBI_RATE' ELSE 'POVERTY_RATE' END END AS secondary_target, CASE WHEN st = 'completed' THEN CASE WHEN first THEN b ELSE p END END AS secondary_rho FROM s""",
)
def _strongest(t: Tables):
    k = F.col("n_nationkey")
    base = t.nation.join(t.customer, k == F.col("c_nationkey")).groupBy(F.col("n_name").alias("iso"), "n_nationkey").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.col("c_custkey") % 97) % 100).alias("h")
    )
    rho = F.array(
        F.struct(F.lit("POVERTY_RATE").alias("target"), (-(F.col("h") % 90) / 100.0).alias("spearman_rho")),
        F.struct(F.lit("NBI_RATE").alias("target"), ((F.col("h") * 7 % 90) / 100.0).alias("spearman_rho")),
    )
    tests = base.filter(k % 3 != 0).select("iso", "n", F.explode(rho).alias("r")).select("iso", "n", "r.*", F.lit(0.5).alias("decile_within_one"))
    countries = base.select(
        "iso", (k % 5 != 0).alias("has_wealth"), (k % 7 != 0).alias("has_adm2"), (k % 11 != 0).alias("has_poverty"), ((k % 3 == 0) & (k % 2 == 0)).alias("blocked")
    )
    return study.strongest_target(tests, countries)


@query(
    "quintile_composition",
    with_views(
        """WITH s AS (SELECT s.adm0_pcode AS iso, s.row_seq, s.sector, s.nivel_secalta AS a, b.k, 20e0 - (b.k * 31 % 500) / 4e2 AS y, 4e0 * (b.nk % 5) + (b.k * 17 % 300) / 2e2 AS x FROM {school} s JOIN {school_base} b ON b.k = s.row_seq),
        d AS (SELECT s.*, t.rwi, row_number() OVER (PARTITION BY s.row_seq ORDER BY (s.y - t.lat) * (s.y - t.lat) + (s.x - t.lon) * (s.x - t.lon), t.tile_seq) AS rn, sqrt((s.y - t.lat) * (s.y - t.lat) + (s.x - t.lon) * (s.x - t.lon)) * 111 AS km FROM s JOIN {tile} t USING (iso)),
        n AS (SELECT * FROM d WHERE rn = 1 AND km <= 5), q AS (SELECT *, 1 + ((row_number() OVER (PARTITION BY iso ORDER BY rwi, row_seq) - 1) * 5) // count(*) OVER (PARTITION BY iso) AS quintile FROM n)
        SELECT iso, cast(quintile AS int) AS quintile, count(*) AS n, round_even(100e0 * count(*) FILTER (sector = 'Public') / count(*), 1) AS pct_public, round_even(100e0 * count(*) FILTER (sector = 'Private') / count(*), 1) AS pct_private,
          round_even(100e0 * count(*) FILTER (sector = 'Public' AND a = 1) / nullif(count(*) FILTER (sector = 'Public'), 0), 1) AS pct_public_secalta FROM q GROUP BY 1, 2"""
    ),
)
def _composition(t: Tables):
    k = F.col("k")
    places = t.school_base.select(
        k.alias("cell_id"), (20.0 - (k * 31 % 500) / F.lit(400.0)).alias("lat"), (4.0 * (F.col("nk") % 5) + (k * 17 % 300) / F.lit(200.0)).alias("lon")
    )
    schools = t.school.select(F.col("adm0_pcode").alias("iso"), F.col("row_seq").alias("cell_id"), "sector", "nivel_secalta").join(places, "cell_id")
    near = spatial.nearest_value(schools, t.tile, ["rwi"], 5.0, "km")
    ranked = study.equal_quintile(near.select("iso", "cell_id", "sector", "nivel_secalta", "rwi"), ["iso"], "rwi", "cell_id", "quintile")
    return study.quintile_composition(ranked, "quintile")
