"""Domain tables derived from the given tables.

Each view is one SELECT in the SQL subset Spark and DuckDB share, with integer
arithmetic (or a single double division), so both engines see identical inputs.
`{name}` stands for another table or view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from access_spark.session import tune

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    # ---- country settings: one row per region ---------------------------------------
    "country": """
        SELECT r_name AS iso, r_regionkey AS rk,
          CASE WHEN r_regionkey IN (0, 2) THEN 'adm2' WHEN r_regionkey = 1 THEN 'adm1'
               WHEN r_regionkey = 3 THEN 'spatial_only' ELSE 'bbox_only' END AS final_match_level,
          CASE WHEN r_regionkey = 1 THEN 18e0 ELSE 20e0 END AS lat_max, 0e0 AS lat_min,
          r_regionkey * 4e0 AS lon_min, r_regionkey * 4e0 + 4e0 AS lon_max,
          TRUE AS pipeline_enabled, r_regionkey <> 4 AS analysis_included,
          CASE WHEN r_regionkey < 3 THEN 'standard' ELSE 'limited' END AS validation_tier,
          'ready' AS data_status
        FROM {region}""",
    # ---- registry: schools with the usual defects ------------------------------------
    "school_base": """
        SELECT c_custkey AS k, r_name AS iso, n_nationkey AS nk, n_name,
          4e0 * cast(floor(n_nationkey / 5e0) AS int) AS box_lat,
          4e0 * (n_nationkey % 5) AS box_lon,
          ((c_custkey * 7919) % 1000) / 250e0 + 2e-3 AS off_lat,
          ((c_custkey * 104729) % 1000) / 250e0 + 3e-3 AS off_lon,
          c_name, c_mktsegment, c_acctbal
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey""",
    "school": """
        SELECT cast(k AS string) AS id_centro, k AS row_seq, iso AS adm0_pcode,
          c_name AS nombre_centro,
          CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 'Public'
               WHEN c_mktsegment = 'FURNITURE' THEN 'Private' ELSE 'Unknown' END AS sector,
          CASE WHEN k % 3 <> 1 THEN 1 ELSE 0 END AS nivel_primaria,
          CASE WHEN k % 4 < 2 THEN 1 ELSE 0 END AS nivel_secbaja,
          CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS nivel_secalta,
          CASE WHEN k % 17 = 0 THEN NULL WHEN k % 23 = 0 THEN 0e0 WHEN k % 29 = 0 THEN 95e0
               WHEN k % 31 = 0 THEN box_lon + off_lon WHEN k % 7 = 0 THEN box_lat - 2e-2
               ELSE box_lat + off_lat END AS latitud,
          CASE WHEN k % 17 = 0 THEN NULL WHEN k % 46 = 0 THEN 0e0
               WHEN k % 31 = 0 THEN box_lat + off_lat ELSE box_lon + off_lon END AS longitud,
          CASE WHEN k % 10 = 0 THEN '' WHEN k % 11 = 0 THEN 'geocoded'
               WHEN k % 13 = 0 THEN 'centroid_cascade' WHEN k % 37 = 0 THEN 'adm3_centroid_large'
               WHEN k % 41 = 0 THEN 'survey' ELSE 'original' END AS coordinate_source,
          CASE WHEN k % 17 = 0 AND k % 2 = 0 THEN box_lat + off_lat END AS latitud_geocoded,
          CASE WHEN k % 17 = 0 AND k % 2 = 0 THEN box_lon + off_lon END AS longitud_geocoded,
          CASE WHEN k % 6 = 0 THEN 'FLAG' WHEN k % 6 = 1 THEN 'ACCEPT' WHEN k % 6 = 2 THEN 'KEEP_ORIGINAL'
               ELSE '' END AS acceptance,
          CASE WHEN k % 8 = 0 THEN 'street' WHEN k % 8 = 1 THEN 'centroid' WHEN k % 8 = 2 THEN 'uncertain'
               ELSE '' END AS geocode_precision,
          CASE WHEN k % 9 < 6 THEN (k % 97) / 8e0 END AS geocode_distance_km,
          CASE WHEN k % 5 < 2 THEN 'MATCH' ELSE '' END AS geo_adm2_check,
          CASE WHEN k % 7 < 3 THEN 'MISMATCH' ELSE '' END AS orig_adm2_check
        FROM {school_base}""",
    "address": """
        SELECT cast(k AS string) AS id_centro, iso AS adm0_pcode,
          CASE WHEN k % 19 = 0 THEN '' WHEN k % 43 = 0 THEN 'NATION_99'
               ELSE lower(n_name) END AS raw_adm1,
          CASE WHEN k % 19 = 1 THEN 'nan' WHEN off_lat < off_lon
               THEN concat(n_name, ' East') ELSE concat(n_name, ' West') END AS raw_adm2,
          CASE WHEN k % 3 = 0 THEN concat('N', cast(nk AS string)) ELSE '' END AS raw_adm1_code,
          CASE WHEN k % 15 = 0 THEN concat('N', cast(nk AS string), 'E') ELSE '' END AS raw_adm2_code,
          concat('Loc ', cast(k % 9 AS string)) AS raw_locality,
          CASE WHEN k % 12 = 0 THEN 's/n' ELSE concat('Calle ', cast(k % 50 AS string)) END AS raw_street
        FROM {school_base}""",
    # ---- boundaries: boxes of 4 degrees, each cut into two triangles at level 2 -------
    "box": """
        SELECT n_nationkey AS nk, n_name, r_name AS iso,
          4e0 * cast(floor(n_nationkey / 5e0) AS int) AS y0, 4e0 * (n_nationkey % 5) AS x0
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "boundary": """
        SELECT level, iso AS adm0_pcode, concat(prefix, cast(nk AS string), suffix) AS pcode,
          CASE WHEN level = 0 THEN iso ELSE concat(n_name, words) END AS name,
          CASE WHEN level = 0 THEN '' ELSE concat('N', cast(nk AS string)) END AS adm1_pcode,
          factor * nk + step AS poly_seq
        FROM {box} CROSS JOIN (VALUES
          (0, 'P', '', '', 1, 0), (1, 'N', '', '', 1, 0), (2, 'N', 'E', ' East', 2, 0), (2, 'N', 'W', ' West', 2, 1)
        ) AS unit(level, prefix, suffix, words, factor, step)""",
    "corner": """
        SELECT nk, iso, x0, y0, x0 + 4e0 AS x1, y0 + 4e0 AS y1 FROM {box}""",
    "edge": """
        SELECT level, iso AS adm0_pcode, concat(prefix, cast(nk AS string), suffix) AS pcode,
          x0 + u1 * 4e0 AS sx, y0 + v1 * 4e0 AS sy, x0 + u2 * 4e0 AS ex, y0 + v2 * 4e0 AS ey
        FROM {corner} CROSS JOIN (VALUES
          (0, 'P', '', 0, 0, 1, 0), (0, 'P', '', 1, 0, 1, 1), (0, 'P', '', 1, 1, 0, 1), (0, 'P', '', 0, 1, 0, 0),
          (1, 'N', '', 0, 0, 1, 0), (1, 'N', '', 1, 0, 1, 1), (1, 'N', '', 1, 1, 0, 1), (1, 'N', '', 0, 1, 0, 0),
          (2, 'N', 'E', 0, 0, 1, 0), (2, 'N', 'E', 1, 0, 1, 1), (2, 'N', 'E', 1, 1, 0, 0),
          (2, 'N', 'W', 0, 0, 1, 1), (2, 'N', 'W', 1, 1, 0, 1), (2, 'N', 'W', 0, 1, 0, 0)
        ) AS side(level, prefix, suffix, u1, v1, u2, v2)""",
    # ---- population grid ---------------------------------------------------------------
    "grid": """
        SELECT r_name AS iso, p_partkey AS cell_id,
          cast(floor(p_partkey / 50e0) AS bigint) AS row, p_partkey % 50 AS col,
          10e0 + (cast(floor(p_partkey / 50e0) AS bigint) + 0.5e0) * 8e-3 AS lat,
          (p_partkey % 50 + 0.5e0) * 8e-3 AS lon,
          p_retailprice AS pop_total, round(p_retailprice * 0.25e0, 2) AS pop_5_9,
          round(p_retailprice * 0.125e0, 2) AS pop_10_14,
          CASE WHEN p_partkey % 50 = 7 THEN 0e0 ELSE round(p_retailprice * 0.0625e0, 2) END AS pop_15_19,
          CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'urbana'
               WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'no_urbana' ELSE 'dispersa' END AS area_class,
          CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE concat('A', cast(p_partkey % 20 AS string)) END AS adm1_pcode,
          CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE concat('A', cast(p_partkey % 20 AS string), '-', p_brand) END AS adm2_pcode,
          CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE p_size / 10e0 END AS rwi,
          CASE WHEN p_partkey % 67 = 0 THEN NULL ELSE (p_partkey * 31 % 83) / 100e0 END AS poverty_rate
        FROM {part} JOIN {region} ON p_partkey % 5 = r_regionkey""",
    "admin_name": """
        SELECT DISTINCT concat('A', cast(p_partkey % 20 AS string)) AS adm1_pcode,
          concat('Province ', cast(p_partkey % 20 AS string)) AS adm1_name,
          concat('A', cast(p_partkey % 20 AS string), '-', p_brand) AS adm2_pcode,
          concat('District ', p_brand) AS adm2_name
        FROM {part}""",
    # ---- rasters: fine population, ages on the coarse lattice, wealth tiles, poverty -----
    "fine": """
        SELECT r_name AS iso, cast(floor(cast(floor(o_orderkey / 5e0) AS bigint) / 60e0) AS bigint) AS row,
          cast(floor(o_orderkey / 5e0) AS bigint) % 60 AS col,
          CASE WHEN (cast(floor(o_orderkey / 5e0) AS bigint) * 7919) % 100 < 55 THEN o_totalprice / 1e2 ELSE NULL END AS value
        FROM {orders} JOIN {region} ON o_orderkey % 5 = r_regionkey""",
    "transform": """SELECT r_name AS iso, 20e0 AS lat0, r_regionkey * 4e0 AS lon0 FROM {region}""",
    "ages": """
        SELECT r_name AS iso, cast(floor(cast(floor(p_partkey / 5e0) AS bigint) / 30e0) AS bigint) AS row,
          cast(floor(p_partkey / 5e0) AS bigint) % 30 AS col,
          CASE WHEN p_partkey % 13 = 0 THEN -9999e0 ELSE p_size * 1e0 END AS value, p_retailprice AS value2
        FROM {part} JOIN {region} ON p_partkey % 5 = r_regionkey""",
    "tile": """
        SELECT iso, k AS tile_seq, 20e0 - ((k * 7919) % 1000) / 8e2 AS lat,
          4e0 * (nk % 5) + ((k * 104729) % 1000) / 6e2 AS lon, c_acctbal / 1e3 AS rwi, (k % 10) / 1e1 AS rwi_error
        FROM {school_base}""",
    "poverty": """
        SELECT iso, concat('N', cast(nk AS string), side) AS adm2_pcode, nk / 25e0 AS poverty_rate,
          CASE WHEN nk % 2 = 0 THEN nk / 50e0 END AS nbi_rate
        FROM {box} CROSS JOIN (VALUES ('E'), ('W')) AS s(side)""",
    # ---- travel costs: one row per supplied (cell, school) duration ---------------------
    "pair_cost": """
        SELECT l_partkey AS cell_id, l_suppkey AS school_seq, concat('S', cast(l_suppkey AS string)) AS school_id,
          CASE WHEN l_linenumber % 2 = 0 THEN 'walking' ELSE 'motorized' END AS mode,
          CASE WHEN l_linenumber % 3 = 0 THEN 'primaria' WHEN l_linenumber % 3 = 1 THEN 'secbaja'
               ELSE 'secalta' END AS level,
          CASE WHEN l_suppkey % 3 = 0 THEN 'private' ELSE 'public' END AS sector,
          CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity * 90e0 END AS seconds
        FROM {lineitem}""",
    # ---- geocode ledger ------------------------------------------------------------------
    "ledger": """
        SELECT event_id AS run_seq, r_name AS iso, cast(user_id AS string) AS id_centro,
          CASE WHEN event_type IN ('signup', 'error', 'click') THEN 'compare' ELSE 'fill' END AS target_type,
          CASE WHEN event_type = 'signup' THEN 'KEEP_ORIGINAL' WHEN event_type = 'error' THEN 'FLAG'
               WHEN event_type = 'click' AND user_id % 4 = 0 THEN 'REJECT' WHEN event_type = 'click' THEN ''
               WHEN event_type = 'view' AND user_id % 3 = 0 THEN 'ACCEPT_CENTROID'
               WHEN event_type = 'view' AND user_id % 3 = 1 THEN 'ACCEPT_WITH_FLAG'
               WHEN event_type = 'view' THEN 'ACCEPT' WHEN user_id % 2 = 0 THEN 'REJECT' ELSE '' END AS acceptance,
          CASE WHEN value >= 15 THEN 'street' WHEN value >= 5 THEN 'centroid' ELSE 'uncertain' END AS geocode_precision,
          80e0 + (event_id * 37 % 2000) / 100e0 AS score,
          1e1 + (event_id * 7919 % 1000) / 500e0 AS geocoded_lat,
          1e1 + (event_id * 104729 % 1000) / 500e0 AS geocoded_lon,
          1e1 + (user_id * 613 % 1000) / 500e0 AS known_lat,
          1e1 + (user_id * 331 % 1000) / 500e0 AS known_lon
        FROM {events} JOIN {region} ON user_id % 5 = r_regionkey""",
}


def _needs(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name])))


def with_views(body: str) -> str:
    """Complete DuckDB query: WITH clauses for every view the body names as {view}."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in BASE or name in ordered:
            return
        for need in _needs(name):
            visit(need)
        ordered.append(name)

    names = list(dict.fromkeys(re.findall(r"\{(\w+)\}", body)))
    for name in names:
        visit(name)

    def plain(text: str) -> str:
        return re.sub(r"\{(\w+)\}", r"\1", text)

    body = plain(body).strip()
    if not ordered:
        return body
    ctes = ", ".join(f"{n} AS ({plain(VIEWS[n]).strip()})" for n in ordered)
    if re.match(r"(?i)with\s+recursive\s", body):
        return f"WITH RECURSIVE {ctes}, {body[len('with recursive'):].strip()}"
    if re.match(r"(?i)with\s", body):
        return f"WITH {ctes}, {body[len('with'):].strip()}"
    return f"WITH {ctes} {body}"


class Tables:
    """Access to the given tables and the views on them for one session and folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or not (name in BASE or name in VIEWS):
            raise AttributeError(name)
        if name not in self._cache:
            if name in BASE:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                needs = {need: getattr(self, need) for need in _needs(name)}
                self._cache[name] = self.spark.sql(VIEWS[name], **needs)
        return self._cache[name]
