"""Finalisation of small registries over box boundaries, and gap-fill write-back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from access_spark import config
from access_spark.operators import fill
from access_spark.plans.finalize import finalize, normalize_coordinates

COLUMNS = (
    "id_centro string, nombre_centro string, sector string, adm0_pcode string, nivel_primaria int, nivel_secbaja int, nivel_secalta int, latitud double, longitud double, "
    "coordinate_source string, acceptance string, geocode_precision string, geo_adm2_check string, orig_adm2_check string, geocode_distance_km double, latitud_geocoded double, longitud_geocoded double"
)
ADDRESS = "adm0_pcode string, id_centro string, raw_adm1 string, raw_adm2 string, raw_locality string, raw_street string, raw_adm1_code string, raw_adm2_code string"
# A land of two strips, south of the equator: Uplands over Lowlands, three districts and an
# islet. Places in the tests are degrees north and east of its south-west corner.
LAT0, LON0 = -32.0, 44.0
BOXES = [
    (0, "QDR", "q", "Quadra", 0, 0, 12, 9), (0, "QDR", "qi", "Quadra", 20, 20, 21, 21), (1, "QDR", "q1", "Uplands", 0, 5, 12, 9), (1, "QDR", "q2", "Lowlands", 0, 0, 12, 5),
    (2, "QDR", "q11", "Corven", 5, 5, 12, 9), (2, "QDR", "q12", "Dalmor", 0, 5, 5, 9), (2, "QDR", "q21", "Estil", 5, 0, 12, 5),
]


@pytest.fixture(scope="module")
def land(spark):
    polygons = [(lv, iso, code, name, code, i) for i, (lv, iso, code, name, *_) in enumerate(BOXES)]
    edges = []
    for lv, iso, code, _, x0, y0, x1, y1 in BOXES:
        ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        edges += [(lv, iso, code, LON0 + a[0], LAT0 + a[1], LON0 + b[0], LAT0 + b[1]) for a, b in zip(ring, ring[1:])]
    return (
        spark.createDataFrame(polygons, "level int, adm0_pcode string, pcode string, name string, adm1_pcode string, poly_seq int"),
        spark.createDataFrame(edges, "level int, adm0_pcode string, pcode string, sx double, sy double, ex double, ey double"),
    )


def row(key, north, east, source="original", geo=(None, None), **more):
    """A school so far from the corner; numbers of 90 and more, and zeros, are as they stand."""

    def place(n, e):
        raw = n is None or n >= 90 or (n, e) == (0.0, 0.0)
        return (n, e) if raw else (LAT0 + n, LON0 + e)

    lat, lon = place(north, east)
    geo = place(*geo)
    base = dict(acceptance="", geocode_precision="", geo="", orig="", km=None)
    base.update(more)
    return (key, f"School {key}", "Public", "QDR", 1, 0, 0, lat, lon, source, base["acceptance"], base["geocode_precision"], base["geo"], base["orig"], base["km"], *geo)


def run(spark, land, rows, addresses=None, policy="adm2"):
    registry = spark.createDataFrame(rows, COLUMNS)
    places = addresses or [("QDR", r[0], "Uplands", "Corven", "", "", "", "") for r in rows]
    countries = spark.createDataFrame([("QDR", policy, LAT0, LAT0 + 9, LON0, LON0 + 12)], "adm0_pcode string, final_match_level string, lat_min double, lat_max double, lon_min double, lon_max double")
    return finalize(registry, spark.createDataFrame(places, ADDRESS), *land, countries)


def by_id(df):
    return {r["id_centro"]: r.asDict() for r in df.collect()}


def test_labels(spark, land):
    rows = [
        row("ok", 7.0, 7.0), row("none", None, None), row("out", 99.0, 99.0), row("west", 7.0, 7.3), row("island", 20.5, 20.5), row("border", 9.02, 5.0),
        row("bad", 180.0, 7.0), row("old", 7.1, 7.1, "adm3_centroid"), row("large", 7.2, 7.2, "adm3_centroid_large"), row("lost", None, None, "geocoded", (7.4, 7.4)),
        row("zero", 0.0, 0.0, "centroid_cascade", (7.5, 7.5)), row("keep", 6.5, 6.5, "geocoded", (1.0, 1.0)), row("no", None, None, "original", (7.0, 7.0)),
    ]
    places = [("QDR", r[0], "Uplands", "Dalmor" if r[0] == "west" else "Corven", "", "", "", "") for r in rows]
    got = by_id(run(spark, land, rows, places))
    label = {k: v["coordinate_quality"] for k, v in got.items()}
    assert label["ok"] == "gps_validated" and got["ok"]["adm2_pcode"] == "q11" and got["ok"]["qc_match_level"] == "ADM2"
    assert label["none"] == "missing" and got["none"]["qc_in_bounds"] is False and got["none"]["adm1_pcode"] == ""
    assert (label["out"], got["out"]["coordinate_quality_reason"]) == ("out_of_bounds", "bbox")
    assert (label["west"], got["west"]["coordinate_quality_reason"]) == ("adm_mismatch", "adm2_mismatch")
    assert got["west"]["qc_distance_to_raw_polygon_km"] > 200
    assert got["island"]["qc_scope_class"] == "remote_territory_or_island" and got["island"]["include_in_spatial_indicators"] is True
    assert got["border"]["qc_scope_class"] == "near_border_review"
    assert got["bad"]["qc_scope_class"] == "invalid_numeric"
    assert (label["old"], got["old"]["qc_centroid_bias"], got["large"]["qc_centroid_bias"]) == ("geocoded_centroid", "normal", "high")
    assert (got["lost"]["latitud"], got["zero"]["latitud"], got["keep"]["latitud"], label["no"]) == (LAT0 + 7.4, LAT0 + 7.5, LAT0 + 6.5, "missing")
    assert list(run(spark, land, rows[:1]).columns) == list(config.ENRICHED_COLUMNS)


def test_policies_and_cluster(spark, land):
    assert by_id(run(spark, land, [row("a", 7.0, 7.0)], policy="bbox_only"))["a"]["coordinate_quality"] == "gps_unverified"
    places = [("QDR", "a", "Uplands", "Invented", "", "", "", "")]
    assert by_id(run(spark, land, [row("a", 7.0, 7.0)], places, "adm1"))["a"]["coordinate_quality"] == "gps_validated"
    five = by_id(run(spark, land, [row(str(i), 7.0, 7.0) for i in range(5)]))
    assert {v["coordinate_quality_reason"] for v in five.values()} == {"cluster_ge5"}


def test_idempotent(spark, land):
    rows = [row("a", 7.0, 7.0), row("b", None, None), row("c", 7.1, 7.1, "adm3_centroid_large"), row("d", 99.0, 99.0)]
    once = run(spark, land, rows)
    places = spark.createDataFrame([("QDR", r[0], "Uplands", "Corven", "", "", "", "") for r in rows], ADDRESS)
    countries = spark.createDataFrame([("QDR", "adm2", LAT0, LAT0 + 9, LON0, LON0 + 12)], "adm0_pcode string, final_match_level string, lat_min double, lat_max double, lon_min double, lon_max double")
    again = finalize(once, places, *land, countries)
    assert by_id(once) == by_id(again)


def test_near_border_rescue(spark, land):
    # the south-west has no level 2 polygon: a declared code or name near by is trusted
    rows = [row("code", 2.0, 4.99), row("name", 2.0, 4.995), row("far", 2.0, 4.9), row("edge", 5.0, 7.0)]
    places = [
        ("QDR", "code", "Lowlands", "", "", "", "", "q21"), ("QDR", "name", "Lowlands", "Estil", "", "", "", ""), ("QDR", "far", "Lowlands", "Estil", "", "", "", ""),
        ("QDR", "edge", "", "Corven", "", "", "", ""),
    ]
    got = by_id(run(spark, land, rows, places))
    assert (got["code"]["adm2_pcode"], got["name"]["adm2_pcode"], got["far"]["adm2_pcode"]) == ("q21", "q21", "")
    # a point on a shared edge lies within no polygon; the nearest one fits its name
    assert got["edge"]["adm2_pcode"] == "q11"


def test_degree_text_column(spark):
    df = spark.createDataFrame([("A", "5 30 0 N", "1 0 0 W"), ("B", "5.5", "x"), ("B", "5 30 0 N", "1")], "adm0_pcode string, latitud string, longitud string")
    got = sorted((r["adm0_pcode"], r["latitud"], r["longitud"]) for r in normalize_coordinates(df).collect() if r["latitud"])
    assert got == [("A", 5.5, -1.0), ("B", 5.5, None)]


def test_apply_decisions(spark):
    registry = spark.createDataFrame(
        [("T", "ghost", 1.0, 1.0, "geocoded", "gps"), ("T", "real", 2.0, 2.0, "original", "gps"), ("T", "new", None, None, "", "missing"), ("T", "cmp", 3.0, 3.0, "", "x")],
        "iso string, id_centro string, latitud double, longitud double, coordinate_source string, coordinate_quality string",
    )
    results = spark.createDataFrame(
        [("T", "ghost", 9.0, 9.0, "fill", "REJECT"), ("T", "real", 9.0, 9.0, "fill", "REJECT"), ("T", "new", 5.0, 6.0, "fill", "ACCEPT"), ("T", "cmp", 9.0, 9.0, "compare", "FLAG")],
        "iso string, id_centro string, geocoded_lat double, geocoded_lon double, target_type string, acceptance string",
    ).withColumns(
        {c: F.lit("") for c in ("geocode_source", "geocode_precision", *config.AUDIT_COLUMNS)}
        | {c: F.lit(None).cast("double") for c in ("arcgis_score", "geocode_distance_km")}
    )
    got = by_id(fill.apply_decisions(registry, results))
    assert (got["ghost"]["latitud"], got["ghost"]["coordinate_source"], got["ghost"]["coordinate_quality"]) == (None, "", "")
    assert (got["real"]["latitud"], got["real"]["coordinate_source"], got["real"]["coordinate_quality"]) == (2.0, "original", "gps")
    assert (got["new"]["latitud"], got["new"]["latitud_geocoded"], got["new"]["coordinate_source"]) == (5.0, 5.0, "geocoded")
    assert (got["cmp"]["latitud"], got["cmp"]["latitud_geocoded"], got["cmp"]["coordinate_source"], got["cmp"]["acceptance"]) == (3.0, 9.0, "original", "FLAG")
