"""Coordinate quality: admin matching, evidence, labels and the inclusion policy.

Everything is an ordered CASE over columns of the evidence table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.text import clean_text, fold_admin, normalize_name


def _map_literal(entries: Mapping[str, object]) -> Column | None:
    if not entries:
        return None
    items = []
    for key, value in entries.items():
        items.append(F.lit(key))
        items.append(F.array(*[F.lit(v) for v in value]) if isinstance(value, (tuple, list, set)) else F.lit(value))
    return F.create_map(*items)


def _flatten(table: Mapping, level: int) -> dict[str, object]:
    return {f"{iso}|{raw}": to for (lv, iso), names in table.items() if lv == level for raw, to in names.items()}


def canonical_admin(iso: Column, normalized: Column, level: int, aliases: Mapping = config.ADMIN_ALIASES) -> Column:
    """Normalised raw name with the country's aliases applied."""
    known = _map_literal(_flatten(aliases, level))
    if known is None:
        return normalized
    return F.coalesce(F.try_element_at(known, F.concat_ws("|", iso, normalized)), normalized)


def admin_match(
    raw: Column,
    polygon: Column,
    iso: Column,
    level: int = 1,
    aliases: Mapping = config.ADMIN_ALIASES,
    groups: Mapping = config.ADMIN_GROUPS,
) -> Column:
    """MATCH, MISMATCH, NO_RAW_ADM or NO_POLYGON for a declared and a found unit name."""
    return match_normalized(normalize_name(raw), normalize_name(polygon), iso, level, aliases, groups)


def match_normalized(
    raw_name: Column,
    found: Column,
    iso: Column,
    level: int = 1,
    aliases: Mapping = config.ADMIN_ALIASES,
    groups: Mapping = config.ADMIN_GROUPS,
) -> Column:
    """The same rule on names that are normalised already."""
    wanted = canonical_admin(iso, raw_name, level, aliases)
    covered = F.lit(False)
    children = _map_literal(_flatten(groups, level))
    if children is not None:
        listed = F.try_element_at(children, F.concat_ws("|", iso, wanted))
        covered = F.coalesce(F.array_contains(listed, found), F.lit(False))
    return (
        F.when(raw_name == "", "NO_RAW_ADM")
        .when(found == "", "NO_POLYGON")
        .when((wanted == found) | found.contains(wanted) | wanted.contains(found) | covered, "MATCH")
        .otherwise("MISMATCH")
    )


def admin_match_strict(declared: Column, found: Column, iso: Column, aliases: Mapping = config.ADMIN_ALIASES) -> Column:
    """Variant for geocoder answers: aliases work both ways, a contained name is PARTIAL
    only when it covers more than 80 % of the longer one."""
    a, b = fold_admin(declared), fold_admin(found)
    known = _map_literal(_flatten(aliases, 1))
    aliased = F.lit(False)
    if known is not None:
        def named(x: Column) -> Column:
            return F.try_element_at(known, F.concat_ws("|", iso, x))

        aliased = F.coalesce(named(a) == b, F.lit(False)) | F.coalesce(named(b) == a, F.lit(False))
    ratio = F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))
    return (
        F.when((a == "") | (b == ""), "NO_DATA")
        .when((a == b) | aliased, "MATCH")
        .when((a.contains(b) | b.contains(a)) & (ratio > 0.8), "PARTIAL")
        .otherwise("MISMATCH")
    )


def code_or_name_check(raw_code: Column, raw_name: Column, code: Column, name: Column, iso: Column) -> Column:
    """Codes decide when both are present, names otherwise."""
    raw_code, code = clean_text(raw_code), clean_text(code)
    both = (raw_code != "") & (code != "")
    return F.when(both, F.when(raw_code == code, "MATCH").otherwise("MISMATCH")).otherwise(
        admin_match_strict(raw_name, name, iso)
    )


def admin_status(
    level: int,
    policy: Column,
    iso: Column,
    has_coords: Column,
    in_bounds: Column,
    raw_name: Column,
    raw_code: Column,
    polygon_name: Column,
    polygon_code: Column,
    aliases: Mapping = config.ADMIN_ALIASES,
    groups: Mapping = config.ADMIN_GROUPS,
) -> Column:
    """Status of one admin level under the country's policy; names come normalised."""
    name = polygon_name
    declared, found = clean_text(raw_code), clean_text(polygon_code)
    both_codes = (declared != "") & (found != "")
    compared = (
        F.when(~has_coords, "NO_DATA")
        .when(~in_bounds, "NOT_RUN")
        .when(name == "", "NO_POLYGON")
        .when(both_codes, F.when(declared == found, "MATCH").otherwise("MISMATCH"))
        .otherwise(match_normalized(raw_name, polygon_name, iso, level, aliases, groups))
    )
    contained = (
        F.when(name != "", "MATCH").when(~has_coords, "NO_DATA").otherwise("NO_POLYGON")
        if level == 1
        else F.lit("NOT_RUN")
    )
    return (
        F.when(policy == "bbox_only", "NOT_RUN").when(policy == "spatial_only", contained).otherwise(compared)
    )


def match_level(policy: Column) -> Column:
    levels = F.create_map(*[F.lit(x) for pair in config.MATCH_LEVELS.items() for x in pair])
    return F.try_element_at(levels, policy)


def scope_class(lat: Column, lon: Column, in_bounds: Column, has_border: Column, covered: Column, border_km: Column) -> Column:
    """Territory class of a point, apart from its quality.

    `has_border` says whether the country has a boundary at all, `covered` whether the
    point lies in it (edges included), `border_km` is the distance to its edge.
    """
    by_box = F.when(in_bounds, "inside_mainland_bbox").otherwise("outside_country")
    by_border = (
        F.when(covered, F.when(in_bounds, "inside_mainland_bbox").otherwise("remote_territory_or_island"))
        .when(border_km <= config.BORDER_REVIEW_KM, "near_border_review")
        .otherwise("outside_country")
    )
    return (
        F.when(lat.isNull() | lon.isNull(), "missing")
        .when((F.abs(lat) > 90) | (F.abs(lon) > 180), "invalid_numeric")
        .when(~F.coalesce(has_border, F.lit(False)), by_box)
        .otherwise(by_border)
    )


def canonical_source(source: Column, bias: Column, lat: Column, lon: Column) -> Column:
    """Struct (coordinate_source, qc_centroid_bias, warning) in today's vocabulary."""
    key = clean_text(source)
    prior = F.when(bias.isin(*config.CENTROID_BIASES), bias).otherwise(F.lit("unknown"))
    has_point = lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0))
    fallback = F.when(has_point, F.lit("original")).otherwise(F.lit(""))
    name, kind = F.when(key == "", fallback), F.when(key == "", prior)
    for old, (new, new_bias) in config.LEGACY_SOURCES.items():
        name, kind = name.when(key == old, new), kind.when(key == old, new_bias)
    canonical = key.isin(*config.COORDINATE_SOURCES)
    name, kind = name.when(canonical, key).otherwise(fallback), kind.when(canonical, prior).otherwise(prior)
    known = (key == "") | canonical | key.isin(*config.LEGACY_SOURCES)
    warning = F.when(~known, F.concat(F.lit("unknown coordinate_source="), key))
    return F.struct(name.alias("coordinate_source"), kind.alias("qc_centroid_bias"), warning.alias("migration_warning"))


def evidence(columns: set[str]) -> dict[str, Column]:
    """Evidence columns with a default wherever a column is absent or null."""

    def text(name: str, default: str = "") -> Column:
        if name not in columns:
            return F.lit(default)
        value = F.col(name).cast("string")
        return F.when(value.isNull() | (value == ""), F.lit(default)).otherwise(value)

    def yes(name: str) -> Column:
        return F.coalesce(F.col(name).cast("boolean"), F.lit(False)) if name in columns else F.lit(False)

    def value(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in columns else F.lit(None).cast(kind)

    has_coords = F.coalesce((F.col("latitud") != 0) & (F.col("longitud") != 0), F.lit(False))
    return {
        "has_coords": has_coords,
        "in_bounds": has_coords & yes("qc_in_bounds"),
        "swapped": yes("qc_swapped"),
        "adm1_status": text("qc_adm1_status", "NOT_RUN"),
        "adm2_status": text("qc_adm2_status", "NOT_RUN"),
        "cluster_size": F.coalesce(value("qc_cluster_size_exact", "bigint"), F.lit(0)),
        "cluster_diff_place": yes("qc_cluster_diff_admin_locality"),
        "frontier_rescue": yes("qc_n2_frontier_rescue"),
        "source": text("coordinate_source"),
        "precision": text("geocode_precision"),
        "acceptance": text("acceptance"),
        "geo_adm2_check": text("geo_adm2_check"),
        "orig_adm2_check": text("orig_adm2_check"),
        "geocode_km": value("geocode_distance_km", "double"),
        "polygon_km": value("qc_distance_to_raw_polygon_km", "double"),
    }


def strong_disagreement(ev: Mapping[str, Column]) -> Column:
    """A flagged answer that is precise, sits in the declared unit alone, or is far away."""
    return (ev["acceptance"] == "FLAG") & (
        ev["precision"].isin("street", "centroid")
        | ((ev["geo_adm2_check"] == "MATCH") & (ev["orig_adm2_check"] == "MISMATCH"))
        | F.coalesce(ev["geocode_km"] >= config.GEOCODER_DISAGREE_KM, F.lit(False))
    )


def in_boundary_zone(ev: Mapping[str, Column]) -> Column:
    """An original point near its declared unit that the geocoder confirms."""
    return (
        F.coalesce(ev["polygon_km"] < config.BOUNDARY_ZONE_KM, F.lit(False))
        & (ev["source"] == "original")
        & F.coalesce(ev["geocode_km"] < config.BOUNDARY_ZONE_KM, F.lit(False))
    )


def coordinate_quality(ev: Mapping[str, Column], policy: Column) -> Column:
    """Struct (label, reason); the first rule that applies decides."""

    def answer(label: str, reason: str) -> Column:
        return F.struct(F.lit(label).alias("label"), F.lit(reason).alias("reason"))

    zone = in_boundary_zone(ev)
    mismatch2 = (policy == "adm2") & (ev["adm2_status"] == "MISMATCH")
    mismatch1 = policy.isin("adm2", "adm1") & (ev["adm1_status"] == "MISMATCH")
    original = ev["source"] == "original"
    size = ev["cluster_size"]
    filled = ev["source"].isin("geocoded", "centroid_cascade")
    street = (ev["source"] == "geocoded") & (ev["precision"] == "street")
    validated = ((policy == "adm2") & (ev["adm2_status"] == "MATCH")) | (
        (policy == "adm1") & (ev["adm1_status"] == "MATCH")
    )
    rules = (
        (~ev["has_coords"], "missing", "missing"),
        (ev["swapped"], "swapped", "swapped"),
        (~ev["in_bounds"], "out_of_bounds", "bbox"),
        (mismatch2 & zone, "boundary_zone", "boundary_zone_<5km"),
        (mismatch2, "adm_mismatch", "adm2_mismatch"),
        (mismatch1 & (policy == "adm2") & zone, "boundary_zone", "boundary_zone_<5km"),
        (mismatch1, "adm_mismatch", "adm1_mismatch"),
        (original & (size >= config.CLUSTER_THRESHOLD), "cluster_centroid", "cluster_ge5"),
        (original & size.isin(3, 4) & ev["cluster_diff_place"], "cluster_centroid", "cluster_3_4_diff_admin_locality"),
        (
            original & (size == 2) & ev["cluster_diff_place"] & ~ev["frontier_rescue"],
            "cluster_centroid", "cluster_2_diff_admin_locality",
        ),
        (strong_disagreement(ev), "geocoder_disagrees", "geocoder_compare"),
        (street, "geocoded_street", "fill_street"),
        (filled, "geocoded_centroid", "fill_centroid"),
        (validated & original & (size < config.CLUSTER_THRESHOLD), "gps_validated", "validated"),
        (ev["acceptance"] == "FLAG", "gps_unverified", "geocoder_low_confidence"),
    )
    decision = F.when(rules[0][0], answer(*rules[0][1:]))
    for cond, label, reason in rules[1:]:
        decision = decision.when(cond, answer(label, reason))
    return decision.otherwise(answer("gps_unverified", "default_unverified"))


def inclusion_policy(scope: Column, quality: Column, adm1_status: Column) -> Column:
    """True, false, or null when a person has to decide."""
    scope, quality = F.coalesce(scope, F.lit("")), F.coalesce(quality, F.lit(""))
    unknown = F.lit(None).cast("boolean")
    near = scope == "near_border_review"
    severe = quality.isin(
        "adm_mismatch", "geocoder_disagrees", "cluster_centroid", "swapped", "missing", "out_of_bounds"
    )
    return (
        F.when(scope.isin("missing", "invalid_numeric", "outside_country"), False)
        .when(quality.isin("missing", "swapped"), False)
        .when(quality.isin("geocoded_street", "boundary_zone"), True)
        .when(quality.isin("geocoded_centroid", "cluster_centroid"), unknown)
        .when(near & severe, unknown)
        .when(near & (quality == "gps_validated"), True)
        .when(near, F.when(adm1_status == "MATCH", True).otherwise(unknown))
        .when(quality.isin("adm_mismatch", "geocoder_disagrees"), unknown)
        .when(scope.isin("inside_mainland_bbox", "remote_territory_or_island"), True)
        .otherwise(False)
    )


def geocode_precision(score: Column, query_precision: Column) -> Column:
    """Precision from the geocoder score; without a score, from the kind of query."""
    return (
        F.when(score >= 95, "street")
        .when(score >= 90, "centroid")
        .when(score.isNotNull(), "uncertain")
        .when(query_precision == "admin", "centroid")
        .otherwise("uncertain")
    )


def acceptance(
    target: Column, precision: Column, policy: Column,
    geo_adm1: Column, geo_adm2: Column, orig_adm1: Column, orig_adm2: Column,
) -> Column:
    """Decision on a geocoder answer for a gap to fill or a coordinate to compare."""
    good = ("MATCH", "PARTIAL")
    in_unit, in_parent = geo_adm2.isin(*good), geo_adm1.isin(*good)
    best = F.when(policy == "adm2", in_unit).otherwise(in_parent)
    confirmed = F.when(policy == "adm2", orig_adm2.isin(*good)).otherwise(orig_adm1.isin(*good))
    fill = target == "fill"
    return (
        F.when(policy.isin("adm1", "adm2") & (geo_adm1 == "MISMATCH"), "REJECT")
        .when(precision == "uncertain", F.when(fill, "REJECT").otherwise("FLAG"))
        .when(fill & (precision == "street") & best, "ACCEPT")
        .when(fill & (policy == "adm2") & (precision == "street") & in_parent, "ACCEPT_WITH_FLAG")
        .when(fill & (precision == "centroid") & (best | in_parent), "ACCEPT_CENTROID")
        .when(fill, "REJECT")
        .when(confirmed, "KEEP_ORIGINAL")
        .otherwise("FLAG")
    )


def prepass_status(
    swapped: Column, in_bounds: Column, polygon_name: Column, polygon_code: Column, raw_code: Column,
    raw_name: Column, iso: Column, spatial_only: Column, level: int = 1, aliases: Mapping = config.ADMIN_ALIASES,
) -> Column:
    """First-pass status of a located school (used by the summary reports)."""
    from access_spark.functions.text import fold_name

    found, declared = fold_name(polygon_name), fold_name(raw_name)
    code, wanted_code = clean_text(polygon_code), clean_text(raw_code)
    wanted = canonical_admin(iso, declared, 1, aliases)
    return (
        F.when(swapped, "LIKELY_SWAPPED")
        .when(~in_bounds, "OUT_OF_BOUNDS")
        .when(found == "", "NO_POLYGON")
        .when((wanted_code != "") & (code != ""), F.when(wanted_code == code, "MATCH").otherwise("MISMATCH"))
        .when(spatial_only, "MATCH")
        .when(declared == "", "NO_RAW_ADM")
        .when((wanted == found) | found.contains(wanted) | wanted.contains(found), "MATCH")
        .otherwise("MISMATCH")
    )
