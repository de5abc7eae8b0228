"""Scalar column functions on hand-made values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from access_spark.functions import geo, numeric, text
from access_spark.operators import quality


def one(spark, make, *args):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"a{i} {kind(v)}" for i, v in enumerate(args)))
    return df.select(make(*[F.col(f"a{i}") for i in range(len(args))]).alias("r")).first()["r"]


def kind(value):
    return {str: "string", float: "double", int: "bigint", bool: "boolean"}.get(type(value), "string")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Ñuble", "nuble"), ("  Cundinamarca  ", "cundinamarca"), (None, ""), ("   ", ""), ("SAN  José\tdel\xa0Sur", "san jose del sur"),
        ("Rumiðahui", "rumiahui"), ("ﬁn ½", "fin 12"), ("Straße", "strae"),
    ],
)
def test_normalize_name(spark, raw, expected):
    assert one(spark, text.normalize_name, raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("25°17'13.5\"S", -25.287083), ("25º17'13.5\"S", -25.287083), ("25°17’13.5″S", -25.287083), ("5 51 0 N", 5.85), ("25,287083", 25.287083),
        ("-25.5", -25.5), ("junk", None), ("", None), (None, None), ("-5 30 0", -5.5), ("12d", None),
    ],
)
def test_dms(spark, raw, expected):
    got = one(spark, geo.dms_to_degrees, raw)
    assert got is None if expected is None else abs(got - expected) < 1e-5


@pytest.mark.parametrize("raw, expected", [("19.8321,", 19.8321), (",1-71.01", -71.01), ("18033415,-", 18033415.0), (None, None)])
def test_last_number(spark, raw, expected):
    got = one(spark, geo.last_number, raw)
    assert got is None if expected is None else abs(got - expected) < 1e-9


@pytest.mark.parametrize(
    "lat, lon, inside, swapped",
    [(8.5, -80.0, True, False), (0.0, 0.0, False, False), (8.5, -90.0, False, False), (None, -80.0, False, False), (-80.0, 8.5, False, True), (100.0, 200.0, False, False)],
)
def test_box(spark, lat, lon, inside, swapped):
    box = {"lat_min": F.lit(7.1), "lat_max": F.lit(9.7), "lon_min": F.lit(-83.1), "lon_max": F.lit(-77.1)}
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    row = df.select(
        geo.in_box(F.col("lat"), F.col("lon"), box).alias("a"), geo.looks_swapped(F.col("lat"), F.col("lon"), box).alias("b")
    ).first()
    assert (row["a"], row["b"]) == (inside, swapped)


@pytest.mark.parametrize(
    "raw, polygon, iso, level, expected",
    [
        ("Bogotá", "BOGOTA", "COL", 1, "MATCH"), ("Ciudad de México", "Distrito Federal", "MEX", 1, "MATCH"), ("Ciudad de México", "Distrito Federal", "COL", 1, "MISMATCH"),
        ("Azua", "Provincia Azua", "DOM", 2, "MATCH"), ("Cusco", "Lima", "PER", 1, "MISMATCH"), ("", "Lima", "PER", 1, "NO_RAW_ADM"), ("Lima", None, "PER", 1, "NO_POLYGON"),
        ("Bronsweg", "Brownsweg", "SUR", 2, "MATCH"), ("Bronsweg", "Brownsweg", "SUR", 1, "MISMATCH"), ("ABACOS", "Grand Cay", "BHS", 1, "MATCH"),
    ],
)
def test_admin_match(spark, raw, polygon, iso, level, expected):
    assert one(spark, lambda a, b, c: quality.admin_match(a, b, c, level), raw, polygon, iso) == expected


@pytest.mark.parametrize(
    "a, b, expected",
    [("Santander", "Norte de Santander", "MISMATCH"), ("San Martín", "san martin", "MATCH"), ("San Martin 1", "San Martin", "PARTIAL"), ("", "x", "NO_DATA")],
)
def test_strict_match(spark, a, b, expected):
    assert one(spark, lambda x, y: quality.admin_match_strict(x, y, F.lit("PER")), a, b) == expected


@pytest.mark.parametrize("raw, expected", [("6", "AR006"), ("6.0", "AR006"), ("x", ""), (None, ""), ("  ", "")])
def test_admin_code(spark, raw, expected):
    assert one(spark, lambda c: text.admin_code(c, "AR", 3), raw) == expected


@pytest.mark.parametrize("raw, expected", [("SAN JOSÃ\x89", "SAN JOSÉ"), ("Clean", "Clean"), ("Ã alone €", "Ã alone €"), (None, None)])
def test_mojibake(spark, raw, expected):
    assert one(spark, text.fix_mojibake, raw) == expected


@pytest.mark.parametrize(
    "name, expected",
    [("Colegio La Salle", True), ("Escuela Rural Mixta La Pradera", False), ("Liceo A", False), ("Institución Educativa Nuestra Señora", True), ("corto", False), ("Wayuu Jayariyu", False)],
)
def test_specific_name(spark, name, expected):
    assert one(spark, text.is_specific_name, name) is expected


def test_haversine_keeps_missing(spark):
    assert one(spark, geo.haversine_km, None, 1.0, 2.0, 3.0) is None
    assert abs(one(spark, geo.haversine_km, 0.0, 0.0, 0.0, 1.0) - 111.19492664455873) < 1e-9


def test_percent_and_finite(spark):
    assert one(spark, lambda a, b: numeric.percent(a, b), 1, 8) == 12.5
    assert one(spark, lambda a, b: numeric.percent(a, b), 1, 0) is None
    assert one(spark, numeric.finite, float("nan")) is None
    assert one(spark, numeric.finite, float("inf")) is None


def test_utm_round_numbers(spark):
    # Quito: zone 17 south, against published coordinates of the point
    df = spark.range(1)
    lat, lon = geo.utm_to_degrees(F.lit(777_000.0), F.lit(9_976_000.0), 17, True)
    row = df.select(lat.alias("lat"), lon.alias("lon")).first()
    assert abs(row["lat"] + 0.217) < 2e-3 and abs(row["lon"] + 78.511) < 2e-3


@pytest.mark.parametrize(
    "quality_label, scope, adm1, expected",
    [
        ("adm_mismatch", "near_border_review", "MATCH", None), ("geocoder_disagrees", "near_border_review", "MATCH", None), ("cluster_centroid", "near_border_review", "MATCH", None),
        ("gps_validated", "near_border_review", "MATCH", True), ("gps_unverified", "near_border_review", "MATCH", True), ("gps_unverified", "near_border_review", "", None),
        ("boundary_zone", "inside_mainland_bbox", "MISMATCH", True), ("geocoded_street", "near_border_review", "", True), ("geocoded_centroid", "inside_mainland_bbox", "", None),
        ("geocoded_centroid", "near_border_review", "", None), ("geocoded_centroid", "outside_country", "", False), ("gps_validated", "outside_country", "MATCH", False),
        ("gps_validated", "inside_mainland_bbox", "MATCH", True), ("out_of_bounds", "remote_territory_or_island", "", True), ("missing", "inside_mainland_bbox", "", False),
        ("adm_mismatch", "inside_mainland_bbox", "", None), ("cluster_centroid", "inside_mainland_bbox", "", None),
    ],
)
def test_inclusion_policy(spark, quality_label, scope, adm1, expected):
    assert one(spark, lambda s, q, a: quality.inclusion_policy(s, q, a), scope, quality_label, adm1) is expected


GOOD = {
    "latitud": 7.0, "longitud": 7.0, "qc_in_bounds": True, "qc_swapped": False, "qc_adm1_status": "MATCH", "qc_adm2_status": "MATCH", "qc_cluster_size_exact": 1,
    "qc_cluster_diff_admin_locality": False, "qc_n2_frontier_rescue": False, "coordinate_source": "original", "geocode_precision": "", "acceptance": "", "geo_adm2_check": "",
    "orig_adm2_check": "", "geocode_distance_km": None, "qc_distance_to_raw_polygon_km": None,
}
SCHEMA = (
    "latitud double, longitud double, qc_in_bounds boolean, qc_swapped boolean, qc_adm1_status string, qc_adm2_status string, qc_cluster_size_exact bigint, qc_cluster_diff_admin_locality boolean, "
    "qc_n2_frontier_rescue boolean, coordinate_source string, geocode_precision string, acceptance string, geo_adm2_check string, orig_adm2_check string, geocode_distance_km double, qc_distance_to_raw_polygon_km double"
)
ZONE = {"qc_adm2_status": "MISMATCH", "qc_distance_to_raw_polygon_km": 3.0, "geocode_distance_km": 2.0}


@pytest.mark.parametrize(
    "change, policy, expected",
    [
        ({}, "adm2", ("gps_validated", "validated")), ({"latitud": None}, "adm2", ("missing", "missing")), ({"longitud": 0.0}, "adm2", ("missing", "missing")),
        ({"qc_swapped": True, "qc_in_bounds": False}, "adm2", ("swapped", "swapped")), ({"qc_in_bounds": False}, "adm2", ("out_of_bounds", "bbox")),
        ({"qc_adm2_status": "MISMATCH"}, "adm2", ("adm_mismatch", "adm2_mismatch")), ({"qc_adm1_status": "MISMATCH", "qc_adm2_status": "NOT_RUN"}, "adm2", ("adm_mismatch", "adm1_mismatch")),
        ({"qc_adm2_status": "MISMATCH"}, "adm1", ("gps_validated", "validated")), (ZONE, "adm2", ("boundary_zone", "boundary_zone_<5km")),
        ({**ZONE, "qc_adm1_status": "MISMATCH"}, "adm1", ("adm_mismatch", "adm1_mismatch")), ({**ZONE, "geocode_distance_km": None}, "adm2", ("adm_mismatch", "adm2_mismatch")),
        ({"qc_cluster_size_exact": 10}, "adm2", ("cluster_centroid", "cluster_ge5")),
        ({"qc_cluster_size_exact": 10, "coordinate_source": "geocoded", "geocode_precision": "centroid"}, "adm2", ("geocoded_centroid", "fill_centroid")),
        ({"qc_cluster_size_exact": 3, "qc_cluster_diff_admin_locality": True}, "adm2", ("cluster_centroid", "cluster_3_4_diff_admin_locality")),
        ({"qc_cluster_size_exact": 3}, "adm2", ("gps_validated", "validated")),
        ({"qc_cluster_size_exact": 2, "qc_cluster_diff_admin_locality": True}, "adm2", ("cluster_centroid", "cluster_2_diff_admin_locality")),
        ({"qc_cluster_size_exact": 2, "qc_cluster_diff_admin_locality": True, "qc_n2_frontier_rescue": True}, "adm2", ("gps_validated", "validated")),
        ({"acceptance": "FLAG", "geocode_precision": "street"}, "adm2", ("geocoder_disagrees", "geocoder_compare")),
        ({"acceptance": "FLAG", "geocode_precision": "uncertain", "geocode_distance_km": 12.0}, "adm2", ("geocoder_disagrees", "geocoder_compare")),
        ({"acceptance": "FLAG", "geocode_precision": "uncertain", "qc_adm2_status": "NO_RAW_ADM"}, "adm2", ("gps_unverified", "geocoder_low_confidence")),
        ({"coordinate_source": "geocoded", "geocode_precision": "street"}, "adm2", ("geocoded_street", "fill_street")),
        ({"coordinate_source": "centroid_cascade"}, "adm2", ("geocoded_centroid", "fill_centroid")), ({}, "spatial_only", ("gps_unverified", "default_unverified")),
        ({}, "bbox_only", ("gps_unverified", "default_unverified")),
    ],
)
def test_resolver(spark, change, policy, expected):
    row = {**GOOD, **change}
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    ev = quality.evidence(set(df.columns))
    got = df.select(quality.coordinate_quality(ev, F.lit(policy)).alias("q")).first()["q"]
    assert (got["label"], got["reason"]) == expected


def test_folding_is_that_of_unicode(spark):
    """Every code point with a decomposition or a combining class, and a part of the others."""
    import unicodedata

    points = [
        chr(c) for c in range(0x20, 0x110000)
        if not 0xD800 <= c <= 0xDFFF and (unicodedata.normalize("NFKD", chr(c)) != chr(c) or unicodedata.combining(chr(c)) or c % 97 == 0)
    ]
    df = spark.createDataFrame([(p,) for p in points], "t string")
    for form, ascii_only in (("NFKD", True), ("NFKD", False), ("NFD", False)):
        got = {r.t: r.o for r in df.select("t", text._unaccent(F.col("t"), form, ascii_only).alias("o")).collect()}
        for p in points:
            parts = unicodedata.normalize(form, p)
            assert got[p] == "".join(c for c in parts if (ord(c) < 128 if ascii_only else not unicodedata.combining(c))), hex(ord(p))


def test_p_values(spark):
    """Against the tail of Student's t, integrated numerically."""
    import math

    def tail(r, n):
        df, t = n - 2, abs(r) * math.sqrt((n - 2) / (1 - r * r))
        norm = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        steps = 20_000
        area = sum(norm * (1 + ((i + 0.5) * t / steps) ** 2 / df) ** (-(df + 1) / 2) for i in range(steps)) * t / steps
        return max(0.0, 1 - 2 * area)

    from access_spark.operators import study

    rows = [(r, n) for r in (-0.9, -0.2, 0.0, 0.35, 0.8) for n in (3, 4, 5, 6, 9, 20, 57)]
    got = spark.createDataFrame(rows, "r double, n int").select("r", "n", study.correlation_p_value(F.col("r"), F.col("n")).alias("p")).collect()
    assert all(abs(x.p - tail(x.r, x.n)) < 1e-6 for x in got)
    ends = spark.createDataFrame([(1.0, 5), (0.5, 2)], "r double, n int").select(study.correlation_p_value(F.col("r"), F.col("n")).alias("p")).collect()
    assert abs(ends[0].p) < 1e-12 and ends[1].p is None


def test_poisson_borders_reach_the_end():
    from access_spark.operators.bootstrap import poisson_borders

    borders = poisson_borders()
    assert borders == sorted(set(borders)) and len(borders) > 10
    assert abs(borders[0] / 2**40 - 0.36787944) < 1e-8 and borders[-1] < 2**40


def test_correlation_without_spread_is_null(spark):
    from access_spark.operators import study

    rows = [("flat", 1.0, float(i)) for i in range(4)] + [("even", float(i), 2.0 * i) for i in range(4)] + [("one", 1.0, 1.0)]
    out = study.correlations(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y").collect()
    got = {r.g: (r.n, r.spearman_rho, r.pearson_r, r.spearman_p) for r in out}
    assert got["flat"] == (4, None, None, None) and set(got) == {"flat", "even"}
    assert all(abs(v - w) < 1e-12 for v, w in zip(got["even"], (4, 1.0, 1.0, 0.0)))
