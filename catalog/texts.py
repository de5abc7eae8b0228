"""Queries on text, identifier and coordinate columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions import geo, numeric, text
from access_spark.operators import quality
from access_spark.plans import finalize
from catalog.domain import Tables, with_views
from catalog.registry import query

NORM = (
    "trim(regexp_replace(lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')), '\\s+', ' ', 'g'))"
)


@query("normalize_name", f"SELECT doc_id, {NORM.format(c='text')} AS name_norm, length({NORM.format(c='text')}) AS n FROM documents")
def _normalize(t: Tables):
    named = t.documents.select("doc_id", text.normalize_name(F.col("text")).alias("name_norm"))
    return named.withColumn("n", F.length("name_norm").cast("bigint"))


@query(
    "fold_names",
    """SELECT doc_id,
      regexp_replace(strip_accents(lower(trim(text))), '[\\x00-\\x1F\\x7F]', '', 'g') AS folded,
      strip_accents(lower(trim(text))) AS folded_admin FROM documents""",
)
def _fold(t: Tables):
    """Both variants that keep letters outside ASCII."""
    return t.documents.select(
        "doc_id", text.fold_name(F.trim("text")).alias("folded"), text.fold_admin(F.trim("text")).alias("folded_admin")
    )


@query(
    "standardized_text",
    """WITH raw AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN '  ' WHEN c_custkey % 7 = 0 THEN 'nan'
        WHEN c_custkey % 11 = 0 THEN 'S/N' ELSE '  ' || c_mktsegment || ' ' END AS word,
        c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '.0' WHEN c_custkey % 9 = 1 THEN 'x' ELSE '' END AS id FROM customer)
      SELECT k, regexp_replace(trim(id), '\\.0$', '') AS id_text,
        CASE WHEN k % 2 = 0 OR k % 9 <> 1 THEN cast(k AS varchar) ELSE id END AS id_number,
        trim(word) AS cleaned, trim(word) = '' AS blank,
        CASE WHEN trim(word) = 'nan' THEN '' ELSE trim(word) END AS no_null_word,
        CASE WHEN lower(trim(word)) IN ('', 'nan', 's/n') THEN '' ELSE trim(word) END AS no_junk,
        regexp_extract(c_name, '#(\\d+)', 1) AS number, c_name || '-' || k AS composite,
        'BHS-' || lpad(cast(k AS varchar), cast(greatest(3, length(cast(k AS varchar))) AS int), '0') AS numbered,
        CASE WHEN k % 2 = 1 AND k % 9 = 1 THEN '' ELSE 'AR' || lpad(cast(k AS varchar), cast(greatest(3, length(cast(k AS varchar))) AS int), '0') END AS code,
        CASE WHEN lower(trim(word)) IN ('', 's/n', 'nan') THEN c_name ELSE c_name || ' ' || trim(word) END AS street,
        CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 1 ELSE 0 END AS level_flag
      FROM raw JOIN customer ON c_custkey = k""",
)
def _standardized(t: Tables):
    k = F.col("c_custkey")
    word = (
        F.when(k % 5 == 0, "  ").when(k % 7 == 0, "nan").when(k % 11 == 0, "S/N")
        .otherwise(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")))
    )
    raw_id = F.concat(k.cast("string"), F.when(k % 2 == 0, ".0").when(k % 9 == 1, "x").otherwise(""))
    rows = t.customer.select("c_name", "c_mktsegment", k.alias("k"), word.alias("word"), raw_id.alias("id"))
    w = F.col("word")
    return rows.select(
        "k",
        text.normalize_id(F.col("id")).alias("id_text"),
        text.integer_id(F.col("id")).alias("id_number"),
        text.clean_text(w).alias("cleaned"),
        text.is_blank(w).alias("blank"),
        text.blank_null_words(w).alias("no_null_word"),
        text.blank_junk(w).alias("no_junk"),
        text.extract(F.col("c_name"), r"#(\d+)").alias("number"),
        text.composite_id(F.col("c_name"), F.col("k")).alias("composite"),
        text.numbered_id("BHS-", F.col("k"), 3).alias("numbered"),
        text.admin_code(F.col("id"), "AR", 3).alias("code"),
        text.compose_street(F.col("c_name"), w).alias("street"),
        numeric.flag(text.any_of(F.col("c_mktsegment"), "build|furni")).alias("level_flag"),
    )


@query(
    "repaired_encoding",
    "SELECT doc_id, text AS repaired, n_bad FROM (SELECT doc_id, text, length(text) - length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS n_bad FROM documents)",
)
def _mojibake(t: Tables):
    """Documents spoilt by reading UTF-8 as Latin-1, then repaired."""
    spoilt = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    # only text the repair recognises; other letters do not occur with the marker alone
    back = F.when(spoilt.contains("Ã"), text.fix_mojibake(spoilt)).otherwise(F.col("text"))
    return t.documents.select(
        "doc_id", back.alias("repaired"),
        F.length(F.regexp_replace("text", r"[\x00-\x7F]", "")).cast("bigint").alias("n_bad"),
    )


@query(
    "specific_names",
    """WITH n AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'Colegio ' || word WHEN 1 THEN 'Escuela Rural ' || word
        WHEN 2 THEN 'Institución Educativa ' || word || ' ' || word WHEN 3 THEN 'Liceo ' || right(word, 3)
        WHEN 4 THEN 'Institucion Educativa' ELSE word END AS name
      FROM (SELECT doc_id, text AS word FROM documents))
      SELECT doc_id, name, CASE WHEN length(name) < 8 THEN FALSE
        WHEN (starts_with(lower(trim(name)), 'colegio ') AND length(lower(trim(name))) > 11) OR (starts_with(lower(trim(name)), 'liceo ') AND length(lower(trim(name))) > 9) THEN TRUE
        WHEN starts_with(lower(trim(name)), 'escuela') THEN FALSE
        ELSE (contains(lower(trim(name)), 'institucion educativa') OR contains(lower(trim(name)), 'institución educativa')) AND length(lower(trim(name))) > 30 END AS specific FROM n""",
)
def _specific(t: Tables):
    word = F.col("text")
    which = F.col("doc_id") % 6
    name = (
        F.when(which == 0, F.concat(F.lit("Colegio "), word))
        .when(which == 1, F.concat(F.lit("Escuela Rural "), word))
        .when(which == 2, F.concat(F.lit("Institución Educativa "), word, F.lit(" "), word))
        .when(which == 3, F.concat(F.lit("Liceo "), F.right(word, F.lit(3))))
        .when(which == 4, F.lit("Institucion Educativa"))
        .otherwise(word)
    )
    return t.documents.select("doc_id", name.alias("name")).withColumn("specific", text.is_specific_name(F.col("name")))


@query(
    "standardized_coordinates",
    """WITH raw AS (SELECT c_custkey AS k, c_custkey % 90 AS d, c_custkey % 60 AS m, (c_custkey * 7 % 600) / 10e0 AS s,
        CASE WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'N' END AS h, c_acctbal AS v FROM customer),
      vals AS (SELECT *, CASE WHEN h = 'S' THEN -1 ELSE 1 END * (d + m / 60e0 + s / 3600e0) AS dd FROM raw)
      SELECT k, round(dd, 6) AS from_dms, round(dd, 6) AS from_spaced, round(v, 6) AS from_comma,
        round(-abs(v), 6) AS from_messy, round(v, 6) AS pair_lat, round(dd, 2) AS pair_lon,
        CASE WHEN v BETWEEN 0 AND 5000 THEN v END AS limited FROM vals""",
)
def _coordinates(t: Tables):
    """Every spelling of a coordinate the registries use, parsed over the whole table."""
    k = F.col("c_custkey")
    d, m, s = k % 90, k % 60, (k * 7 % 600) / F.lit(10.0)
    hemi = F.when(k % 2 == 0, "S").otherwise("N")
    seconds = F.format_string("%.1f", s)
    value = F.col("c_acctbal").cast("string")
    signed = F.when(k % 2 == 0, -1.0).otherwise(1.0) * (d + m / F.lit(60.0) + s / F.lit(3600.0))
    rows = t.customer.select(
        k.alias("k"),
        F.concat(d.cast("string"), F.lit("°"), m.cast("string"), F.lit("'"), seconds, F.lit('"'), hemi).alias("dms"),
        F.concat_ws(" ", d.cast("string"), m.cast("string"), seconds, hemi).alias("spaced"),
        F.replace(value, F.lit("."), F.lit(",")).alias("comma"),
        F.concat(F.lit("lon: 12; "), F.replace(value, F.lit("."), F.lit(","))).alias("messy"),
        F.concat(value, F.lit(", "), F.format_string("%.2f", F.round(signed, 2))).alias("pair"),
        F.col("c_acctbal"),
    )
    lat, lon = geo.split_pair(F.col("pair"))
    return rows.select(
        "k",
        F.round(geo.dms_to_degrees(F.col("dms")), 6).alias("from_dms"),
        F.round(geo.dms_to_degrees(F.col("spaced")), 6).alias("from_spaced"),
        F.round(numeric.comma_number(F.col("comma")), 6).alias("from_comma"),
        F.round(geo.last_number(F.col("messy"), force_west=True), 6).alias("from_messy"),
        F.round(lat, 6).alias("pair_lat"),
        F.round(lon, 2).alias("pair_lon"),
        geo.within(F.col("c_acctbal"), 0, 5000).alias("limited"),
    )


@query(
    "dms_only_when_no_number",
    """WITH raw AS (SELECT c_custkey AS k, n_regionkey AS r, c_custkey % 80 AS d, c_custkey % 60 AS m FROM customer JOIN nation ON c_nationkey = n_nationkey)
      SELECT k, CASE WHEN r = 0 THEN round(d + m / 60e0, 6) WHEN k % 2 = 0 THEN round(d::double, 6) END AS latitud FROM raw""",
)
def _dms_switch(t: Tables):
    """Degree text is parsed only in countries without a single plain number."""
    k = F.col("c_custkey")
    d, m = (k % 80).cast("string"), (k % 60).cast("string")
    dms = F.concat(d, F.lit("°"), m, F.lit("'"))
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.alias("k"), F.col("n_regionkey").cast("string").alias("adm0_pcode"),
        F.when((F.col("n_regionkey") != 0) & (k % 2 == 0), d).otherwise(dms).alias("latitud"), F.lit("1").alias("longitud"),
    )
    return finalize.normalize_coordinates(rows).select("k", F.round("latitud", 6).alias("latitud"))


@query(
    "box_and_swap",
    with_views(
        """SELECT id_centro, coalesce(latitud BETWEEN lat_min AND lat_max AND longitud BETWEEN lon_min AND lon_max, FALSE) AS in_box,
          NOT coalesce(latitud BETWEEN lat_min AND lat_max AND longitud BETWEEN lon_min AND lon_max, FALSE)
            AND coalesce(latitud BETWEEN lon_min AND lon_max AND longitud BETWEEN lat_min AND lat_max, FALSE) AS swapped
        FROM {school} JOIN {country} ON iso = adm0_pcode"""
    ),
)
def _box(t: Tables):
    box = {c: F.col(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")}
    lat, lon = F.col("latitud"), F.col("longitud")
    return t.school.join(t.country, F.col("iso") == F.col("adm0_pcode")).select(
        "id_centro", geo.in_box(lat, lon, box).alias("in_box"), geo.looks_swapped(lat, lon, box).alias("swapped")
    )


@query(
    "cell_geometry",
    with_views(
        """SELECT cell_id, round(8e-3 * 111 * 8e-3 * 111 * cos(radians(lat)), 6) AS area_km2,
          round(8e-3 * 111320e0 * cos(radians(lat)), 6) AS width_m, round(8e-3 * 110574e0, 6) AS height_m,
          cast(round_even((lat - 10e0) / 8e-3, 0) AS bigint) AS lattice_row, cast(floor((lat - 10.1e0) / 3e-2) AS bigint) AS floor_row,
          cast(trunc((lat - 10.1e0) / 3e-2) AS bigint) AS cut_row,
          round(2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - 10) / 2), 2) + cos(radians(lat)) * cos(radians(10)) * pow(sin(radians(lon) / 2), 2))), 6) AS km,
          round(sqrt((lat - 10) * (lat - 10) + lon * lon) * 111, 6) AS degree_km,
          CASE WHEN pop_total > 314 THEN 'high' ELSE 'normal' END AS bias FROM {grid}"""
    ),
)
def _geometry(t: Tables):
    lat, lon = F.col("lat"), F.col("lon")
    ten, zero = F.lit(10.0), F.lit(0.0)
    return t.grid.select(
        "cell_id",
        F.round(geo.cell_area_km2(lat, 8e-3), 6).alias("area_km2"),
        F.round(geo.cell_width_m(8e-3, lat), 6).alias("width_m"),
        F.lit(round(geo.cell_height_m(8e-3), 6)).alias("height_m"),
        geo.lattice_index(lat, ten, 8e-3).alias("lattice_row"),
        geo.floor_cell(lat, 10.1, 3e-2).alias("floor_row"),
        geo.truncated_cell(lat, 10.1, 3e-2).alias("cut_row"),
        F.round(geo.haversine_km(ten, zero, lat, lon), 6).alias("km"),
        F.round(geo.degrees_to_km(geo.degree_distance(lat, lon, ten, zero)), 6).alias("degree_km"),
        geo.centroid_bias(F.col("pop_total")).alias("bias"),
    )


@query(
    "projected_coordinates",
    """SELECT c_custkey AS k, round(degrees(2 * atan(exp(y / 6378137e0)) - pi() / 2), 6) AS mercator_lat, round(degrees(x / 6378137e0), 6) AS mercator_lon,
        TRUE AS utm_ok FROM (SELECT c_custkey, (c_custkey % 1000 - 500) * 1e4 AS x, (c_custkey * 7 % 1000 - 500) * 1e4 AS y FROM customer)""",
)
def _projected(t: Tables):
    """Inverse Web Mercator against its formula; inverse UTM must give back points whose
    easting is the central meridian's: there the longitude is exact and the latitude grows
    with the northing."""
    k = F.col("c_custkey")
    lat, lon = geo.mercator_to_degrees((k % 1000 - 500) * F.lit(1e4), (k * 7 % 1000 - 500) * F.lit(1e4))
    north = F.lit(1e7) - (k % 1000) * F.lit(1e3)
    ulat, ulon = geo.utm_to_degrees(F.lit(5e5), north, 17, True)
    # meridian arc length per degree stays between 110.5 and 111.7 km times the scale
    arc = (F.lit(1e7) - north) / F.lit(0.9996)
    ok = (F.abs(ulon + 81.0) < 1e-9) & (F.abs(ulat) * 110500.0 <= arc + 1) & (F.abs(ulat) * 111700.0 >= arc - 1)
    return t.customer.select(
        k.alias("k"), F.round(lat, 6).alias("mercator_lat"), F.round(lon, 6).alias("mercator_lon"), ok.alias("utm_ok")
    )


@query(
    "address_query_cascade",
    with_views(
        """WITH a AS (SELECT s.adm0_pcode AS iso, id_centro, CASE WHEN raw_street = 's/n' THEN '' ELSE raw_street END AS street,
          raw_locality AS loc, CASE WHEN raw_adm2 = 'nan' THEN '' ELSE raw_adm2 END AS a2, raw_adm1 AS a1
          FROM {school} s JOIN {address} USING (id_centro)),
        q AS (
          SELECT iso, id_centro, 0 AS ord, 'street' AS precision, street || ', ' || a2 || ', ' || a1 || ', ' || iso AS query FROM a WHERE street <> '' AND a1 <> '' AND a2 <> ''
          UNION ALL SELECT iso, id_centro, 2, 'locality', loc || ', ' || a2 || ', ' || a1 || ', ' || iso FROM a WHERE a1 <> '' AND a2 <> ''
          UNION ALL SELECT iso, id_centro, 3, 'admin', a2 || ', ' || a1 || ', ' || iso FROM a WHERE a1 <> '' AND a2 <> '')
        SELECT * FROM q"""
    ),
)
def _cascade(t: Tables):
    from access_spark.operators import fill

    rows = t.school.select("id_centro", "nombre_centro").join(t.address, "id_centro").withColumnRenamed("adm0_pcode", "iso")
    return fill.query_cascade(rows, F.col("iso"))


@query(
    "admin_match",
    with_views(
        """WITH m AS (SELECT id_centro, lower(raw_adm1) AS r, lower(n_name) AS p
          FROM {address} a JOIN {school_base} b ON cast(b.k AS string) = a.id_centro)
        SELECT id_centro, CASE WHEN r = '' THEN 'NO_RAW_ADM' WHEN contains(p, r) OR contains(r, p) THEN 'MATCH' ELSE 'MISMATCH' END AS loose,
          CASE WHEN r = '' THEN 'NO_DATA' WHEN r = p THEN 'MATCH'
            WHEN (contains(r, p) OR contains(p, r)) AND least(length(r), length(p)) / greatest(length(r), length(p)) > 0.8 THEN 'PARTIAL' ELSE 'MISMATCH' END AS strict
        FROM m"""
    ),
)
def _admin_match(t: Tables):
    rows = t.address.join(t.school_base.select(F.col("k").cast("string").alias("id_centro"), "n_name", "iso"), "id_centro")
    return rows.select(
        "id_centro",
        quality.admin_match(F.col("raw_adm1"), F.col("n_name"), F.col("iso")).alias("loose"),
        quality.admin_match_strict(F.col("raw_adm1"), F.col("n_name"), F.col("iso")).alias("strict"),
    )


@query(
    "admin_aliases_and_groups",
    """WITH v AS (SELECT unnest([{'iso': 'GTM', 'r': 'Ciudad Capital', 'p': 'Guatemala', 'want': 'MATCH'},
        {'iso': 'MEX', 'r': 'Ciudad Capital', 'p': 'Guatemala', 'want': 'MISMATCH'}, {'iso': 'BHS', 'r': 'ABACOS', 'p': 'Hope Town', 'want': 'MATCH'},
        {'iso': 'BHS', 'r': 'ANDROS', 'p': 'Hope Town', 'want': 'MISMATCH'}, {'iso': 'BHS', 'r': '', 'p': 'Hope Town', 'want': 'NO_RAW_ADM'},
        {'iso': 'BHS', 'r': 'ANDROS', 'p': '', 'want': 'NO_POLYGON'}]) AS x)
      SELECT c_custkey AS k, x.iso AS iso, x.r AS raw, x.p AS polygon, x.want AS status FROM customer JOIN v ON x.r IS NOT NULL""",
)
def _aliases(t: Tables):
    """Published aliases and one-to-many groups applied to every customer row."""
    cases = F.array(
        *[
            F.struct(F.lit(i).alias("iso"), F.lit(r).alias("raw"), F.lit(p).alias("polygon"))
            for i, r, p in (
                ("GTM", "Ciudad Capital", "Guatemala"), ("MEX", "Ciudad Capital", "Guatemala"), ("BHS", "ABACOS", "Hope Town"),
                ("BHS", "ANDROS", "Hope Town"), ("BHS", "", "Hope Town"), ("BHS", "ANDROS", ""),
            )
        ]
    )
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.explode(cases).alias("c")).select("k", "c.*")
    return rows.withColumn("status", quality.admin_match(F.col("raw"), F.col("polygon"), F.col("iso")))


@query(
    "country_codes",
    with_views(
        """SELECT id_centro, adm0_pcode, CASE adm0_pcode WHEN 'AFRICA' THEN 'AF' WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS'
          WHEN 'EUROPE' THEN 'EU' ELSE 'ME' END AS boundary_code FROM {school}"""
    ),
)
def _crosswalk(t: Tables):
    from access_spark.sources.tables import country_crosswalk

    codes = t.region.select(
        F.col("r_name").alias("adm0_pcode"),
        F.when(F.col("r_name") == "MIDDLE EAST", "ME").otherwise(F.substring("r_name", 1, 2)).alias("boundary_code"),
    )
    return country_crosswalk(t.school.select("id_centro", "adm0_pcode"), codes, "adm0_pcode", "boundary_code")


@query(
    "canonical_sources",
    with_views(
        """WITH s AS (SELECT *, latitud IS NOT NULL AND longitud IS NOT NULL AND NOT (latitud = 0 AND longitud = 0) AS has FROM {school})
        SELECT id_centro, CASE WHEN coordinate_source = '' OR coordinate_source = 'survey' THEN CASE WHEN has THEN 'original' ELSE '' END
            WHEN coordinate_source = 'adm3_centroid_large' THEN 'centroid_cascade' ELSE coordinate_source END AS coordinate_source,
          CASE WHEN coordinate_source = 'adm3_centroid_large' THEN 'high' WHEN coordinate_source IN ('original', 'geocoded') THEN 'unknown'
            ELSE CASE WHEN row_seq % 4 = 0 THEN 'high' ELSE 'unknown' END END AS qc_centroid_bias,
          CASE WHEN coordinate_source = 'survey' THEN 'unknown coordinate_source=survey' END AS migration_warning FROM s"""
    ),
)
def _sources(t: Tables):
    bias = F.when(F.col("row_seq") % 4 == 0, "high").otherwise("other")
    out = quality.canonical_source(F.col("coordinate_source"), bias, F.col("latitud"), F.col("longitud"))
    return t.school.select("id_centro", out.alias("c")).select("id_centro", "c.*")


@query(
    "geocode_precision_and_acceptance",
    with_views(
        """WITH e AS (SELECT run_seq, iso, target_type, score, CASE run_seq % 4 WHEN 0 THEN NULL ELSE score END AS sc,
          CASE WHEN run_seq % 3 = 0 THEN 'admin' ELSE 'street' END AS q,
          CASE run_seq % 5 WHEN 0 THEN 'MATCH' WHEN 1 THEN 'PARTIAL' WHEN 2 THEN 'MISMATCH' ELSE 'NO_DATA' END AS g1,
          CASE run_seq % 7 WHEN 0 THEN 'MATCH' WHEN 1 THEN 'MISMATCH' ELSE 'NO_DATA' END AS g2,
          CASE run_seq % 2 WHEN 0 THEN 'MATCH' ELSE 'NO_DATA' END AS o1, CASE run_seq % 11 WHEN 0 THEN 'PARTIAL' ELSE 'MISMATCH' END AS o2,
          final_match_level AS policy FROM {ledger} JOIN {country} USING (iso)),
        p AS (SELECT *, CASE WHEN sc >= 95 THEN 'street' WHEN sc >= 90 THEN 'centroid' WHEN sc IS NOT NULL THEN 'uncertain'
          WHEN q = 'admin' THEN 'centroid' ELSE 'uncertain' END AS prec,
          CASE WHEN policy = 'adm2' THEN g2 IN ('MATCH', 'PARTIAL') ELSE g1 IN ('MATCH', 'PARTIAL') END AS best, g1 IN ('MATCH', 'PARTIAL') AS dept FROM e)
        SELECT run_seq, prec AS precision, CASE WHEN policy IN ('adm1', 'adm2') AND g1 = 'MISMATCH' THEN 'REJECT'
          WHEN prec = 'uncertain' THEN CASE WHEN target_type = 'fill' THEN 'REJECT' ELSE 'FLAG' END
          WHEN target_type = 'fill' THEN CASE WHEN prec = 'street' AND best THEN 'ACCEPT' WHEN policy = 'adm2' AND prec = 'street' AND dept THEN 'ACCEPT_WITH_FLAG'
            WHEN prec = 'centroid' AND (best OR dept) THEN 'ACCEPT_CENTROID' ELSE 'REJECT' END
          WHEN CASE WHEN policy = 'adm2' THEN o2 IN ('MATCH', 'PARTIAL') ELSE o1 IN ('MATCH', 'PARTIAL') END THEN 'KEEP_ORIGINAL' ELSE 'FLAG' END AS acceptance FROM p"""
    ),
)
def _acceptance(t: Tables):
    r = F.col("run_seq")
    score = F.when(r % 4 != 0, F.col("score"))
    precision = quality.geocode_precision(score, F.when(r % 3 == 0, "admin").otherwise("street"))
    g1 = F.when(r % 5 == 0, "MATCH").when(r % 5 == 1, "PARTIAL").when(r % 5 == 2, "MISMATCH").otherwise("NO_DATA")
    g2 = F.when(r % 7 == 0, "MATCH").when(r % 7 == 1, "MISMATCH").otherwise("NO_DATA")
    o1 = F.when(r % 2 == 0, "MATCH").otherwise("NO_DATA")
    o2 = F.when(r % 11 == 0, "PARTIAL").otherwise("MISMATCH")
    rows = t.ledger.join(t.country.select("iso", "final_match_level"), "iso").withColumn("precision", precision)
    verdict = quality.acceptance(F.col("target_type"), F.col("precision"), F.col("final_match_level"), g1, g2, o1, o2)
    return rows.select("run_seq", "precision", verdict.alias("acceptance"))


@query(
    "reach_flags",
    with_views(
        "SELECT cell_id, school_id, mode, level, CASE WHEN seconds / 60 <= 15 THEN 1 ELSE 0 END AS le15, CASE WHEN seconds / 60 <= 30 THEN 1 ELSE 0 END AS le30, CASE WHEN seconds / 60 <= 60 THEN 1 ELSE 0 END AS le60 FROM {pair_cost}"
    ),
)
def _reach(t: Tables):
    minutes = F.col("seconds") / 60.0
    return t.pair_cost.select(
        "cell_id", "school_id", "mode", "level", *[numeric.reach_flag(minutes, b).alias(f"le{b}") for b in config.TIME_BANDS]
    )
