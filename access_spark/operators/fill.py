"""Gap filling from cached geocoder answers and admin centroids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.geo import HIGH_BIAS_AREA_KM2, haversine_km
from access_spark.functions.text import address_queries, clean_text, fold_admin
from access_spark.operators import quality, spatial
from access_spark.operators.clusters import downgrade_shared_results
from access_spark.session import cut_lineage


def query_cascade(targets: DataFrame, country: Column) -> DataFrame:
    """Up to four address queries per school, one row each, most specific first."""
    queries = address_queries(
        F.col("raw_street"), F.col("nombre_centro"), F.col("raw_locality"), F.col("raw_adm2"), F.col("raw_adm1"), country
    )
    keys = ["iso", "id_centro"]
    return targets.select(*keys, F.explode(queries).alias("q")).select(*keys, "q.ord", "q.precision", "q.query")


def cached_answers(queries: DataFrame, cache: DataFrame) -> DataFrame:
    """First query of each school with an answer in the cache; cached failures are skipped."""
    hits = cache.filter("hit").select("query", "lat", "lon", "source", "score")
    answer = F.struct("ord", "query", "precision", "lat", "lon", "source", "score")
    found = queries.join(hits, "query").groupBy("iso", "id_centro").agg(F.min(answer).alias("a"))
    return found.select(
        "iso", "id_centro",
        F.col("a.lat").alias("geocoded_lat"), F.col("a.lon").alias("geocoded_lon"),
        F.coalesce("a.source", F.lit("cache")).alias("geocode_source"),
        quality.geocode_precision(F.col("a.score"), F.col("a.precision")).alias("geocode_precision"),
        F.col("a.query").alias("geocode_query"), F.col("a.score").alias("arcgis_score"),
    )


def within_margin(answers: DataFrame, boxes: DataFrame, margin: float = 1.0) -> DataFrame:
    """New answers inside the country's box, a degree of slack on each side."""
    lat, lon = F.col("lat"), F.col("lon")
    inside = lat.between(F.col("lat_min") - margin, F.col("lat_max") + margin) & lon.between(
        F.col("lon_min") - margin, F.col("lon_max") + margin
    )
    return answers.join(boxes, "iso").filter(inside).select(*answers.columns)


def evaluate(
    results: DataFrame, addresses: DataFrame, boundaries: DataFrame, edges: DataFrame, policies: DataFrame
) -> DataFrame:
    """Admin checks of the geocoded and the original point, and the decision.

    `results` has iso, id_centro, geocoded_lat/lon, original_lat/lon, target_type and
    geocode_precision. Both points of a school are located in one pass.
    """
    keys = ["iso", "id_centro"]
    rows = cut_lineage(results)
    has_original = F.col("original_lat").isNotNull() & (F.col("original_lat") != 0)
    ends = F.array(
        F.when(F.col("geocoded_lat").isNotNull(), F.struct(F.lit("g").alias("side"), F.col("geocoded_lon").alias("x"), F.col("geocoded_lat").alias("y"))),
        F.when(has_original, F.struct(F.lit("o").alias("side"), F.col("original_lon").alias("x"), F.col("original_lat").alias("y"))),
    )
    points = rows.select(*keys, F.explode(ends).alias("p")).filter("p IS NOT NULL").select(
        *keys, F.col("iso").alias("adm0_pcode"), "p.*"
    )
    inside = spatial.polygons_of_points(points, edges.filter("level > 0"), [*keys, "adm0_pcode", "side"]).filter("inside")
    units = boundaries.select("adm0_pcode", "level", "pcode", "name", "poly_seq")
    unit = F.struct("poly_seq", "pcode", "name")
    located = inside.join(units, ["adm0_pcode", "level", "pcode"]).groupBy(*keys).agg(
        *[
            F.min(F.when((F.col("side") == side) & (F.col("level") == lv), unit)).alias(f"_{side}{lv}")
            for side in ("g", "o")
            for lv in (1, 2)
        ]
    )
    declared = addresses.select(
        F.col("adm0_pcode").alias("iso"), "id_centro",
        F.col("qc_raw_adm1" if "qc_raw_adm1" in addresses.columns else "raw_adm1").alias("_d1"),
        F.col("qc_raw_adm2" if "qc_raw_adm2" in addresses.columns else "raw_adm2").alias("_d2"),
        F.col("raw_adm1_code").alias("_dc"),
    )
    out = rows.join(located, keys, "left").join(declared, keys, "left").join(policies, "iso", "left")
    names = {
        f"{label}_in_adm{lv}": clean_text(F.col(f"_{side}{lv}.name"))
        for side, label in (("g", "geocoded"), ("o", "original"))
        for lv in (1, 2)
    }
    out = out.withColumns(names)
    iso = F.col("iso")

    def check1(side: str, label: str) -> Column:
        return quality.code_or_name_check(
            F.col("_dc"), F.col("_d1"), F.col(f"_{side}1.pcode"), F.col(f"{label}_in_adm1"), iso
        )

    def check2(label: str) -> Column:
        return quality.admin_match_strict(F.col("_d2"), F.col(f"{label}_in_adm2"), iso)

    located_new = F.col("geocoded_lat").isNotNull()
    out = out.withColumns(
        {
            "geo_adm1_check": F.when(located_new, check1("g", "geocoded")),
            "geo_adm2_check": F.when(located_new, check2("geocoded")),
            "orig_adm1_check": F.when(has_original, check1("o", "original")).otherwise("NO_DATA"),
            "orig_adm2_check": F.when(has_original, check2("original")).otherwise("NO_DATA"),
        }
    )
    verdict = quality.acceptance(
        F.col("target_type"), F.col("geocode_precision"), F.col("final_match_level"),
        F.col("geo_adm1_check"), F.col("geo_adm2_check"), F.col("orig_adm1_check"), F.col("orig_adm2_check"),
    )
    out = out.withColumn("acceptance", F.when(located_new, verdict))
    blank = {c: F.when(located_new, F.coalesce(c, F.lit(""))).otherwise("") for c in (*config.AUDIT_COLUMNS, "acceptance")}
    drop = ["_g1", "_g2", "_o1", "_o2", "_d1", "_d2", "_dc", "final_match_level"]
    return out.withColumns(blank).drop(*drop)


def gap_fill_results(
    registry: DataFrame, targets: DataFrame, addresses: DataFrame, cache: DataFrame,
    boundaries: DataFrame, edges: DataFrame, policies: DataFrame, country: Column,
) -> DataFrame:
    """Answers and decisions for every target school, from cached answers only.

    `targets` has iso, id_centro and target_type (fill or compare).
    """
    keys = ["iso", "id_centro"]
    wanted = targets.join(registry.select(*keys, "nombre_centro", "latitud", "longitud"), keys).join(
        addresses.withColumnRenamed("adm0_pcode", "iso").select(
            *keys, "raw_street", "raw_locality", "raw_adm2", "raw_adm1"
        ),
        keys, "left",
    )
    queries = query_cascade(wanted, country)
    asked = queries.select(*keys).distinct().withColumn("_asked", F.lit(True))
    results = wanted.select(
        *keys, "nombre_centro", "target_type", F.col("latitud").alias("original_lat"), F.col("longitud").alias("original_lon")
    ).join(cached_answers(queries, cache), keys, "left").join(asked, keys, "left")
    state = F.when(F.col("_asked").isNull(), "no_address").otherwise(F.coalesce("geocode_precision", F.lit("failed")))
    lat, lon = F.col("original_lat"), F.col("original_lon")
    km = F.when(lat != 0, haversine_km(lat, lon, F.col("geocoded_lat"), F.col("geocoded_lon")))
    results = results.withColumns({"geocode_precision": state, "geocode_distance_km": km}).drop("_asked")
    return evaluate(downgrade_shared_results(results), addresses, boundaries, edges, policies)


def apply_decisions(registry: DataFrame, results: DataFrame) -> DataFrame:
    """Registry after a gap-fill run, one join and one CASE per column.

    Accepted fills write the point and its backup; rejected fills that were filled before
    lose theirs; compared schools keep their point and receive evidence. Touched rows lose
    the final label.
    """
    keys = ["iso", "id_centro"]
    payload = [
        "geocoded_lat", "geocoded_lon", "geocode_source", "geocode_precision", "arcgis_score",
        "geocode_distance_km", "acceptance", "target_type", *config.AUDIT_COLUMNS,
    ]
    have = set(results.columns)
    r = results.select(*keys, F.struct(*[c for c in payload if c in have]).alias("r"))
    df = registry.join(r, keys, "left")
    text = ("geocode_source", "geocode_precision", "acceptance", "coordinate_source", *config.AUDIT_COLUMNS)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in registry.columns else F.lit("") for c in text})
    numbers = ("latitud_geocoded", "longitud_geocoded", "geocode_distance_km", "arcgis_score")
    df = df.withColumns({c: F.lit(None).cast("double") for c in numbers if c not in registry.columns})
    answered = F.col("r.geocoded_lat").isNotNull()
    fill, ok = F.col("r.target_type") == "fill", F.col("r.acceptance").isin(*config.FILL_ACCEPTED)
    accepted = F.coalesce(fill & answered & ok, F.lit(False))
    valid = F.col("latitud").isNotNull() & (F.col("latitud") != 0) & (F.col("longitud") != 0)
    source = F.when(valid & (F.col("coordinate_source") == ""), "original").otherwise(F.col("coordinate_source"))
    rejected = F.coalesce(fill & ~ok, F.lit(False)) & (source == "geocoded")
    compared = F.coalesce((F.col("r.target_type") == "compare") & answered, F.lit(False))
    none = F.lit(None).cast("double")

    def choose(name: str, on_fill: Column, on_reject: Column, on_compare: Column) -> Column:
        return (
            F.when(F.col("_acc"), on_fill).when(F.col("_rej"), on_reject).when(F.col("_cmp"), on_compare)
            .otherwise(F.col(name))
        )

    df = df.withColumns({"_acc": accepted, "_rej": rejected, "_cmp": compared, "_src": source})
    out = {
        "latitud": choose("latitud", F.col("r.geocoded_lat"), none, F.col("latitud")),
        "longitud": choose("longitud", F.col("r.geocoded_lon"), none, F.col("longitud")),
        "latitud_geocoded": choose("latitud_geocoded", F.col("r.geocoded_lat"), none, F.col("r.geocoded_lat")),
        "longitud_geocoded": choose("longitud_geocoded", F.col("r.geocoded_lon"), none, F.col("r.geocoded_lon")),
        "arcgis_score": choose("arcgis_score", F.col("r.arcgis_score"), none, F.col("r.arcgis_score")),
        "geocode_distance_km": choose("geocode_distance_km", F.col("geocode_distance_km"), none, F.col("r.geocode_distance_km")),
        "coordinate_source": choose("_src", F.lit("geocoded"), F.lit(""), F.lit("original")),
    }
    for c in ("geocode_source", "geocode_precision", "acceptance", *config.AUDIT_COLUMNS):
        answer = F.coalesce(F.col(f"r.{c}"), F.lit("")) if c in have else F.lit("")
        out[c] = choose(c, answer, F.lit(""), answer)
    touched = F.col("_acc") | F.col("_rej") | F.col("_cmp")
    for c in ("coordinate_quality", "coordinate_quality_reason"):
        if c in registry.columns:
            out[c] = F.when(touched, F.lit("")).otherwise(F.col(c))
    return df.withColumns(out).drop("r", "_acc", "_rej", "_cmp", "_src")


def refresh_compare(registry: DataFrame, addresses: DataFrame, boundaries: DataFrame, edges: DataFrame, policies: DataFrame) -> DataFrame:
    """Decide again on stored alternatives of original points, without new answers."""
    stored = registry.filter(
        F.col("latitud_geocoded").isNotNull() & F.coalesce("coordinate_source", F.lit("")).isin("", "original")
    ).select(
        "iso", "id_centro", F.col("latitud_geocoded").alias("geocoded_lat"), F.col("longitud_geocoded").alias("geocoded_lon"),
        "geocode_source", "geocode_precision", "arcgis_score", "geocode_distance_km", F.lit("compare").alias("target_type"),
        F.col("latitud").alias("original_lat"), F.col("longitud").alias("original_lon"),
    )
    return evaluate(stored, addresses, boundaries, edges, policies)


def _key(columns: Sequence[str], fold: bool) -> Column:
    parts = [fold_admin(F.col(c)) if fold else clean_text(F.col(c)) for c in columns]
    return F.concat_ws("||", *parts)


def centroid_fill(
    registry: DataFrame, addresses: DataFrame, centroids: DataFrame,
    school_keys: Sequence[str], lookup_keys: Sequence[str], fold: bool = True,
) -> DataFrame:
    """Missing points matched to admin centroids on one or more normalised name parts.

    Returns the missing schools with centroid_lat/lon, the bias and `motivo` for those the
    lookup does not know.
    """
    missing = registry.filter(F.col("latitud").isNull()).select("iso", "id_centro", "nombre_centro")
    keyed = missing.join(addresses.withColumnRenamed("adm0_pcode", "iso"), ["iso", "id_centro"], "left").withColumn(
        "centroid_key", _key(school_keys, fold)
    )
    high = F.col("area_km2") > HIGH_BIAS_AREA_KM2
    if "high_bias_centroid" in centroids.columns:
        high = F.coalesce(F.col("high_bias_centroid"), F.lit(False)) | high
    lookup = centroids.select(
        "iso", _key(lookup_keys, fold).alias("centroid_key"), "centroid_lat", "centroid_lon",
        F.when(F.coalesce(high, F.lit(False)), "high").otherwise("normal").alias("qc_centroid_bias"),
    )
    out = keyed.join(lookup, ["iso", "centroid_key"], "left")
    known = F.col("centroid_lat").isNotNull()
    return out.select(
        "iso", "id_centro", "centroid_key", "centroid_lat", "centroid_lon",
        F.when(known, F.col("qc_centroid_bias")).alias("qc_centroid_bias"),
        F.when(~known, "centroid_not_found").alias("motivo"),
    )


def apply_centroids(registry: DataFrame, filled: DataFrame) -> DataFrame:
    """Write matched centroids into the registry with source and bias."""
    hit = filled.filter("centroid_lat IS NOT NULL").select("iso", "id_centro", "centroid_lat", "centroid_lon", F.col("qc_centroid_bias").alias("_bias"))
    df = registry.join(hit, ["iso", "id_centro"], "left")
    use = F.col("centroid_lat").isNotNull()
    lat, lon = F.col("centroid_lat"), F.col("centroid_lon")
    new = {
        "latitud": lat, "longitud": lon, "latitud_geocoded": lat, "longitud_geocoded": lon,
        "geocode_source": F.lit("centroid_cascade"), "geocode_precision": F.lit("centroid"),
        "acceptance": F.lit("ACCEPT_CENTROID"), "coordinate_source": F.lit("centroid_cascade"),
        "qc_centroid_bias": F.col("_bias"), "coordinate_quality": F.lit(""), "coordinate_quality_reason": F.lit(""),
    }
    known = {c: v for c, v in new.items() if c in registry.columns}
    return df.withColumns({c: F.when(use, v).otherwise(F.col(c)) for c, v in known.items()}).drop(
        "centroid_lat", "centroid_lon", "_bias"
    )
