"""Queries on quintiles, travel-time reduction and the indicator cube."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from access_spark.operators import cube, travel
from access_spark.session import cut_lineage, shared_dir
from access_spark.sources import readers, tables
from catalog.domain import Tables, with_views
from catalog.registry import query

METHOD, SOURCE = "OSRM", "network durations"
FIRST = "AFRICA"

NEAREST = """
    best AS (
      SELECT cell_id, mode, level, sector, seconds, school_id,
        row_number() OVER (PARTITION BY cell_id, mode, level, sector
          ORDER BY seconds NULLS LAST, school_seq) AS rn,
        count(seconds) OVER (PARTITION BY cell_id, mode, level, sector) AS n
      FROM {pair_cost}),
    nearest AS (
      SELECT cell_id, mode, level, sector, n AS n_schools_in_range,
        CASE WHEN n > 0 THEN school_id ELSE '' END AS nearest_school_id,
        cast(seconds / 60e0 AS float) AS time_to_nearest_min
      FROM best WHERE rn = 1)"""

QUINTILES = """
    weights AS (SELECT *, pop_5_9 + pop_10_14 + pop_15_19 AS w FROM {grid}),
    pov AS (
      SELECT iso, cell_id,
        sum(w) OVER (PARTITION BY iso ORDER BY poverty_rate DESC, cell_id ROWS UNBOUNDED PRECEDING) AS cum,
        sum(w) OVER (PARTITION BY iso) AS total, w
      FROM weights WHERE poverty_rate IS NOT NULL AND w > 0),
    wealth AS (
      SELECT iso, cell_id,
        sum(w) OVER (PARTITION BY iso ORDER BY rwi, cell_id ROWS UNBOUNDED PRECEDING) AS cum,
        sum(w) OVER (PARTITION BY iso) AS total, w
      FROM weights WHERE rwi IS NOT NULL AND w > 0),
    prepared AS (
      SELECT g.*,
        CASE WHEN p.cum IS NOT NULL THEN 'quintile_' || cast(1 + least(greatest(trunc(5 * (p.cum - 0.5 * p.w) / p.total), 0), 4) AS int) END AS q_pov,
        CASE WHEN v.cum IS NOT NULL THEN 'rwi_q' || cast(1 + least(greatest(trunc(5 * (v.cum - 0.5 * v.w) / v.total), 0), 4) AS int) END AS q_rwi,
        CASE area_class WHEN 'urbana' THEN 'urban' WHEN 'no_urbana' THEN 'semiurban' ELSE 'rural' END AS area
      FROM {grid} g LEFT JOIN pov p USING (iso, cell_id) LEFT JOIN wealth v USING (iso, cell_id))"""


def _cube_sql(extra: str = "") -> str:
    slices = []
    for idgeo, geo, by in cube.SLICES:
        keys = [*geo, *([by] if by else [])]
        a1 = "adm1_pcode" if idgeo == "admin1" else ("a1" if idgeo == "admin2" else "''")
        a2 = "adm2_pcode" if idgeo == "admin2" else "''"
        area = "area" if by == "area" else "'Total'"
        quintile = by if by in ("q_pov", "q_rwi") else "'Total'"
        where = " AND ".join(f"{k} IS NOT NULL" for k in keys) or "TRUE"
        slices.append(
            f"SELECT iso, mode, level, sector, '{idgeo}' AS idgeo, {a1} AS admin1_pcode, {a2} AS admin2_pcode, "
            f"{area} AS area, {quintile} AS quintile, pop, m FROM long WHERE {where}"
        )
    return with_views(
        "WITH " + NEAREST.strip() + ", " + QUINTILES.strip() + """,
        matrix AS (SELECT g.iso, n.* FROM nearest n JOIN {grid} g USING (cell_id)),
        both_sectors AS (
          SELECT iso, cell_id, mode, level, sector, time_to_nearest_min AS m FROM matrix
          UNION ALL SELECT iso, cell_id, mode, level, 'total', min(time_to_nearest_min) FROM matrix GROUP BY ALL),
        present AS (SELECT DISTINCT iso, mode, level, sector FROM both_sectors),
        parent AS (SELECT iso, adm2_pcode, min_by(adm1_pcode, cell_id) AS a1 FROM {grid}
          WHERE adm1_pcode IS NOT NULL GROUP BY ALL),
        long AS (
          SELECT p.iso, c.mode, c.level, c.sector, p.adm1_pcode, p.adm2_pcode, p.area, p.q_pov, p.q_rwi, pa.a1,
            CASE c.level WHEN 'primaria' THEN pop_5_9 WHEN 'secbaja' THEN pop_10_14 ELSE pop_15_19 END AS pop, b.m
          FROM prepared p JOIN present c ON c.iso = p.iso
          LEFT JOIN both_sectors b ON b.iso = p.iso AND b.cell_id = p.cell_id AND b.mode = c.mode
            AND b.level = c.level AND b.sector = c.sector
          LEFT JOIN parent pa ON pa.iso = p.iso AND pa.adm2_pcode = p.adm2_pcode),
        slices AS (""" + " UNION ALL ".join(slices) + """),
        bands AS (SELECT unnest([15, 30, 60]) AS band),
        sums AS (
          SELECT iso, mode, level, sector, idgeo, admin1_pcode, admin2_pcode, area, quintile, band,
            sum(pop) AS pop, sum(CASE WHEN m <= band THEN pop ELSE 0 END) AS num
          FROM slices, bands GROUP BY ALL)
        SELECT iso AS isoalpha3, idgeo, admin1_pcode, coalesce(n1.adm1_name, '') AS admin1_name,
          admin2_pcode, coalesce(n2.adm2_name, '') AS admin2_name, 'acceso_geografico' AS indicator,
          mode, level AS education_level,
          CASE level WHEN 'primaria' THEN '05_09' WHEN 'secbaja' THEN '10_14' ELSE '15_19' END AS age,
          upper(sector[1]) || sector[2:] AS sector, area, quintile, 'le' || band AS time_band,
          round(100 * num / pop, 4) AS value, round(pop, 2) AS population_base, 2023 AS year,
          'OSRM' AS method, 'network durations' AS source
        FROM sums LEFT JOIN (SELECT DISTINCT adm1_pcode, adm1_name FROM {admin_name}) n1 ON n1.adm1_pcode = admin1_pcode
        LEFT JOIN (SELECT DISTINCT adm2_pcode, adm2_name FROM {admin_name}) n2 ON n2.adm2_pcode = admin2_pcode
        WHERE round(pop, 2) > 0""" + extra
    )


def matrix_of(t: Tables):
    nearest = travel.nearest_school(t.pair_cost, ["cell_id", "mode", "level", "sector"])
    return travel.as_matrix(nearest).join(t.grid.select("iso", "cell_id"), "cell_id")


def cube_of(t: Tables, method: str = METHOD):
    return cube.indicator_cube(cube.prepare_grid(t.grid), matrix_of(t), t.admin_name, method, SOURCE)


@query("indicator_cube", _cube_sql())
def _indicator_cube(t: Tables):
    return cube_of(t)


@query("published_cube", _cube_sql())
def _published_cube(t: Tables):
    """Stored matrices, cube and publication in one go: all countries are published from
    matrices of which one country's were twice too slow, then that country alone again."""
    folder = f"{shared_dir(t.spark)}/cube-{uuid.uuid4().hex}"
    stored = matrix_of(t).withColumnRenamed("minutes", "time_to_nearest_min").withColumn(
        "time_to_nearest_min", F.when(F.col("iso") == FIRST, 2 * F.col("time_to_nearest_min")).otherwise(F.col("time_to_nearest_min")).cast("float")
    )
    layout = ("iso", "mode", "level", "sector")
    stored.select("cell_id", "time_to_nearest_min", *layout).write.partitionBy(*layout).parquet(f"{folder}/matrices")
    matrix = travel.as_matrix(readers.read_matrix(t.spark, f"{folder}/matrices"))
    grid = cut_lineage(cube.prepare_grid(t.grid))  # each cube reads it twice

    def cube_from(cells, rows):
        return cube.indicator_cube(cells, rows, t.admin_name, METHOD, SOURCE)

    tables.write_cube(cube_from(grid, matrix), f"{folder}/cube")
    mended = matrix.filter(F.col("iso") == FIRST).withColumn("minutes", (F.col("minutes") / 2).cast("float"))
    tables.write_cube(cube_from(grid.filter(F.col("iso") == FIRST), mended), f"{folder}/cube")
    return tables.read_cube(t.spark, f"{folder}/cube")


@query("nearest_school_times", with_views("WITH " + NEAREST.strip() + " SELECT * FROM nearest"))
def _nearest(t: Tables):
    return travel.nearest_school(t.pair_cost, ["cell_id", "mode", "level", "sector"])


@query(
    "weighted_quintiles",
    with_views("WITH " + QUINTILES.strip() + " SELECT iso, cell_id, q_pov, q_rwi, area FROM prepared"),
)
def _quintiles(t: Tables):
    return cube.prepare_grid(t.grid).select("iso", "cell_id", "q_pov", "q_rwi", "area")


@query(
    "quintile_coverage",
    with_views(
        "WITH " + QUINTILES.strip() + """
        SELECT iso,
          round(100 * sum(CASE WHEN q_pov IS NOT NULL THEN pop_5_9 + pop_10_14 + pop_15_19 ELSE 0 END)
            / sum(pop_5_9 + pop_10_14 + pop_15_19), 1) AS pct_with_q_pov,
          round(100 * sum(CASE WHEN q_rwi IS NOT NULL THEN pop_5_9 + pop_10_14 + pop_15_19 ELSE 0 END)
            / sum(pop_5_9 + pop_10_14 + pop_15_19), 1) AS pct_with_q_rwi
        FROM prepared GROUP BY iso"""
    ),
)
def _coverage(t: Tables):
    return cube.quintile_coverage(cube.prepare_grid(t.grid))


@query(
    "weighted_mean_minutes",
    with_views(
        "WITH " + NEAREST.strip() + """
        SELECT iso, mode, level, sector,
          round(sum(CASE WHEN time_to_nearest_min IS NOT NULL THEN pop_total * time_to_nearest_min::double END)
            / sum(CASE WHEN time_to_nearest_min IS NOT NULL THEN pop_total END), 4) AS mean_minutes
        FROM nearest JOIN {grid} USING (cell_id) GROUP BY ALL"""
    ),
)
def _mean_minutes(t: Tables):
    return cube.weighted_mean_minutes(t.grid, matrix_of(t))


@query(
    "method_publication_rule",
    with_views(
        "WITH " + NEAREST.strip() + """,
        matrix AS (SELECT g.iso, g.pop_5_9, g.pop_10_14, g.pop_15_19, n.* FROM nearest n JOIN {grid} g USING (cell_id)),
        totals AS (
          SELECT iso, cell_id, level, any_value(CASE level WHEN 'primaria' THEN pop_5_9 WHEN 'secbaja' THEN pop_10_14
              ELSE pop_15_19 END) AS pop,
            min(CASE WHEN mode = 'walking' THEN time_to_nearest_min END) AS mw,
            min(CASE WHEN mode = 'motorized' THEN time_to_nearest_min END) AS mm
          FROM matrix GROUP BY ALL),
        pops AS (SELECT iso, sum(pop_5_9) AS p1, sum(pop_10_14) AS p2, sum(pop_15_19) AS p3 FROM {grid} GROUP BY iso),
        bands AS (SELECT unnest([15, 30, 60]) AS band),
        vals AS (
          SELECT iso, level, band,
            sum(CASE WHEN mw <= band THEN pop ELSE 0 END) AS nw, sum(CASE WHEN mm <= band THEN pop ELSE 0 END) AS nm
          FROM totals, bands GROUP BY ALL)
        SELECT iso AS isoalpha3, level AS education_level, 'le' || band AS time_band,
          round(100 * nw / p, 4) AS value_a, round(100 * nm / p, 4) AS value_b,
          abs(round(round(100 * nw / p, 4) - round(100 * nm / p, 4), 4)) AS gap,
          CASE WHEN abs(round(round(100 * nw / p, 4) - round(100 * nm / p, 4), 4)) < 5 THEN 'point'
               WHEN abs(round(round(100 * nw / p, 4) - round(100 * nm / p, 4), 4)) <= 20 THEN 'range'
               ELSE 'pending' END AS publication
        FROM (SELECT v.*, CASE level WHEN 'primaria' THEN p1 WHEN 'secbaja' THEN p2 ELSE p3 END AS p
              FROM vals v JOIN pops USING (iso))"""
    ),
)
def _publication(t: Tables):
    """Two cubes compared slice by slice; here the two modes stand for two methods."""
    full = cube_of(t).filter(
        (F.col("idgeo") == "country") & (F.col("sector") == "Total")
        & (F.col("area") == "Total") & (F.col("quintile") == "Total")
    )
    one = full.filter("mode = 'walking'").withColumn("mode", F.lit("any"))
    two = full.filter("mode = 'motorized'").withColumn("mode", F.lit("any"))
    rule = cube.publication_rule(one, two)
    return rule.select("isoalpha3", "education_level", "time_band", "value_a", "value_b", "gap", "publication")
