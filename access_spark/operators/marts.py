"""Report marts: coverage, quality counts, funnels and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.numeric import percent, round_even
from access_spark.functions.text import clean_text
from access_spark.operators.keyed import exact_quantiles, top_per_group

# Roll-up of the quality labels.
QUALITY_GROUPS = {
    "gps_preciso": ("gps_validated",),
    "gps_pendiente_validacion": ("gps_unverified",),
    "centroide_detectado": ("cluster_centroid", "geocoded_centroid"),
    "limite_administrativo": ("boundary_zone",),
    "flag_ambiguo": ("adm_mismatch", "geocoder_disagrees", "out_of_bounds", "swapped"),
    "street_geocoder": ("geocoded_street",),
    "sin_coordenadas": ("missing",),
}
# Trace bucket -> (status, root cause); anything else needs review.
TRACE_BUCKETS = {
    "initial_scope_exclusion": ("methodological_difference", "legacy_scope_exclusion"),
    "initial_exclusion_plus_private_addition": ("methodological_difference", "legacy_scope_exclusion"),
    "private_addition": ("methodological_difference", "private_inclusion"),
    "private_addition_or_scope_shift": ("methodological_difference", "private_inclusion"),
    "k12_filter_exclusion": ("methodological_difference", "legacy_scope_exclusion"),
    "prebasic_exclusion": ("methodological_difference", "prebasic_exclusion_policy"),
    "internal_status_policy_review": ("methodological_difference", "status_policy_difference"),
    "legacy_private_filter_bug": ("legacy_output_bug", "legacy_private_filter_bug"),
    "legacy_private_filter_and_level_limit": ("source_review_needed", "legacy_private_filter_bug"),
    "legacy_level_bug": ("legacy_output_bug", "legacy_level_bug"),
    "scope_and_year_mismatch": ("source_review_needed", "source_year_mismatch"),
    "aligned_to_legacy": ("match", "aligned_to_legacy"),
    "year_mismatch": ("source_difference", "source_year_mismatch"),
    "unit_of_analysis_difference": ("methodological_difference", "unit_of_analysis_difference"),
    "internal_ingestion_fix_mostly_resolved": ("resolved_internal", "internal_ingestion"),
    "internal_key_reconciliation": ("resolved_internal", "unit_of_analysis_difference"),
    "resolved_internal_crosswalk": ("resolved_internal", "unit_of_analysis_difference"),
    "internal_mapping_fix_resolved": ("resolved_internal", "internal_mapping_fix"),
    "partially_resolved_internal_mapping_fix": ("resolved_internal", "internal_mapping_fix"),
    "internal_id_field_fix_resolved": ("resolved_internal", "internal_id_fix"),
    "legacy_missing_level_columns": ("baseline_limited", "legacy_missing_levels"),
    "legacy_only_source": ("baseline_limited", "legacy_only_source"),
    "no_legacy_iso": ("baseline_limited", "baseline_missing"),
}
# Labels of a country's validation level.
VALIDATION_LABELS = {
    "adm2": "ADM2 (la unidad más fina disponible)",
    "adm1": "ADM1 (provincia / departamento / región)",
    "spatial_only": "verificación espacial (la coordenada debe caer dentro de algún polígono del país)",
    "bbox_only": "solo bounding box del país",
}


def _count(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _known_point() -> Column:
    return F.col("latitud").isNotNull() & F.col("longitud").isNotNull()


def _raw_source() -> Column:
    return clean_text(F.col("coordinate_source")).isin("", "original")


def _is(column: str, *labels: str) -> Column:
    return F.coalesce(F.col(column).isin(*labels), F.lit(False))


# ---- quality and coverage -----------------------------------------------------------


def qc_baseline(registry: DataFrame, policies: DataFrame, corrections: DataFrame) -> DataFrame:
    """Seven tests per country, sector and mode: one aggregate over (total, sector).

    `corrections` has iso, n_reprojected, n_zero_pairs, n_swapped: known events corrected
    before; they are reported for mode 'pre' and all sectors together only.
    """
    raw = _raw_source()
    quality = F.col("coordinate_quality")
    sectors = F.array(F.lit("total"), F.when(F.col("sector") == "Public", "public"), F.when(F.col("sector") == "Private", "private"))
    rows = registry.select(
        "iso", F.explode(F.filter(sectors, lambda s: s.isNotNull())).alias("sector"), raw.alias("raw"), quality.alias("q"),
        "qc_adm1_status", "qc_adm2_status", "qc_cluster_diff_addr_exact",
    )
    seen = F.col("raw")

    def statuses(level: int) -> list[Column]:
        status = F.col(f"qc_adm{level}_status")
        return [
            _count(seen & status.isin("MATCH", "MISMATCH")).alias(f"_eval{level}"),
            _count(seen & (status == "MISMATCH")).alias(f"_mis{level}"),
        ]

    sums = rows.groupBy("iso", "sector").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(seen & (F.coalesce("q", F.lit("")) != "missing")).alias("n_georef"),
        _count(seen & (F.col("q") == "out_of_bounds")).alias("test3_oob_n"),
        *statuses(1), *statuses(2),
        _count(seen & F.col("qc_cluster_diff_addr_exact")).alias("test7_dup_n"),
    )
    # every country shows all three sectors
    frame = registry.select("iso").distinct().select(
        "iso", F.explode(F.array(*[F.lit(s) for s in ("total", "public", "private")])).alias("sector")
    )
    counts = [c for c in sums.columns if c not in ("iso", "sector")]
    out = (
        frame.join(sums, ["iso", "sector"], "left").fillna(0, counts)
        .join(policies, "iso", "left").join(corrections, "iso", "left")
        .withColumn("mode", F.explode(F.array(F.lit("pre"), F.lit("post"))))
    )
    by_name = ~F.coalesce(F.col("final_match_level").isin("spatial_only", "bbox_only"), F.lit(False))

    def event(name: str) -> Column:
        return F.when(F.col("mode") == "post", F.lit(0)).when(F.col("sector") == "total", F.coalesce(name, F.lit(0))).cast("bigint")

    def match(level: int) -> Column:
        share = 1 - F.col(f"_mis{level}") / F.nullif(F.col(f"_eval{level}"), F.lit(0))
        return F.when(by_name, round_even(share * 100, 1))

    def evaluated(level: int) -> Column:
        return F.when(by_name, F.col(f"_eval{level}")).otherwise(F.lit(0))

    return out.select(
        "iso", "mode", "sector", "n_total", "n_georef",
        event("n_reprojected").alias("test1_wgs84_n"), event("n_zero_pairs").alias("test2_zero_zero_n"), "test3_oob_n",
        event("n_swapped").alias("test4_swapped_n"), percent(F.col("n_georef"), F.col("n_total")).alias("test5_georef_pct"),
        match(1).alias("test6_adm1_match_pct"), evaluated(1).alias("test6_adm1_n_evaluated"),
        match(2).alias("test6_adm2_match_pct"), evaluated(2).alias("test6_adm2_n_evaluated"),
        percent(F.col("test7_dup_n"), F.col("n_georef")).alias("test7_dup_pct"), "test7_dup_n",
    )


def target_summary(targets: DataFrame) -> DataFrame:
    """Pending buckets and finished fills per country and sector (total, public, private)."""
    source = clean_text(F.col("coordinate_source"))
    pending = source.isin("", "original")
    sectors = F.array(F.lit("total"), F.when(F.col("sector") == "Public", "public"), F.when(F.col("sector") == "Private", "private"))
    rows = targets.withColumn("_s", F.explode(F.filter(sectors, lambda s: s.isNotNull())))
    return rows.groupBy("iso", F.col("_s").alias("sector")).agg(
        F.count_if(pending & (F.col("missing") | F.col("zeros"))).alias("n_pending_missing"),
        F.count_if(pending & F.col("zeros")).alias("n_pending_zeros"),
        F.count_if(pending & F.col("out_of_bounds")).alias("n_pending_out_of_bounds"),
        F.count_if(pending & F.col("mismatches")).alias("n_pending_mismatches"),
        F.count_if(pending & F.col("centroids")).alias("n_pending_centroids"),
        F.count_if(pending & F.col("dup_addr")).alias("n_pending_dup_addr"),
        F.count_if(source == "geocoded").alias("n_already_geocoded"),
        F.count_if(source == "centroid_cascade").alias("n_already_cascade"),
    )


def funnel_status(targets: DataFrame) -> DataFrame:
    """Schools in the gap-fill funnel with the one bucket they count in."""
    source = clean_text(F.col("coordinate_source"))
    pending = source.isin("", "original")
    status = (
        F.when(source == "geocoded", "already_geocoded")
        .when(source == "centroid_cascade", "already_cascade")
        .when(pending & (F.col("missing") | F.col("zeros")), "pending_missing")
        .when(pending & F.col("out_of_bounds"), "pending_out_of_bounds")
        .when(pending & F.col("mismatches"), "pending_mismatches")
        .when(pending & F.col("centroids"), "pending_centroids")
    )
    return targets.select("iso", "id_centro", "sector", status.alias("funnel_status")).filter("funnel_status IS NOT NULL")


def funnel_counts(funnel: DataFrame, ledger: DataFrame) -> DataFrame:
    """Schools per country, sector, route and whether the geocoder tried them, with a row
    for all sectors together (grouping sets)."""
    routes = {
        "already_geocoded": "fill_recovered", "already_cascade": "fill_recovered", "pending_missing": "fill_pending",
        "pending_out_of_bounds": "compare", "pending_mismatches": "compare", "pending_centroids": "compare",
    }
    mapping = F.create_map(*[F.lit(x) for pair in routes.items() for x in pair])
    tried = ledger.select("iso", "id_centro").distinct().withColumn("_tried", F.lit(True))
    rows = funnel.join(tried, ["iso", "id_centro"], "left").select(
        "iso",
        F.when(F.col("sector") == "Public", "public").when(F.col("sector") == "Private", "private").otherwise("unknown").alias("sector"),
        F.coalesce(F.try_element_at(mapping, F.col("funnel_status")), F.lit("other")).alias("route_bucket"),
        F.coalesce("_tried", F.lit(False)).alias("attempted"),
    )
    keys = ["iso", "sector", "route_bucket", "attempted"]
    counted = rows.groupingSets([keys, ["iso", "route_bucket", "attempted"]], *keys).agg(
        F.count(F.lit(1)).alias("n_schools"), F.grouping("sector").alias("_all")
    )
    return counted.withColumn("sector", F.when(F.col("_all") == 1, "total").otherwise(F.col("sector"))).drop("_all")


def funnel_headline(funnel: DataFrame, ledger: DataFrame) -> DataFrame:
    """Recovered, validated and unprocessed schools; the three add up to the funnel."""
    tried = ledger.select("iso", "id_centro").distinct().withColumn("_tried", F.lit(True))
    rows = funnel.join(tried, ["iso", "id_centro"], "left")
    recovered = F.col("funnel_status").isin("already_geocoded", "already_cascade")
    attempted = F.coalesce("_tried", F.lit(False))
    compare = F.col("funnel_status").isin("pending_mismatches", "pending_centroids", "pending_out_of_bounds")
    return rows.agg(
        F.count(F.lit(1)).alias("funnel_total"),
        F.count_if(recovered).alias("funnel_recovered"),
        F.count_if(~recovered & attempted).alias("funnel_validated"),
        F.count_if(~recovered & ~attempted).alias("funnel_unprocessed"),
        F.count_if(compare).alias("funnel_compare_candidates"),
        F.count_if(compare & attempted).alias("funnel_compare_processed"),
        F.count_if(~compare).alias("funnel_fill_candidates"),
        F.count_if(~compare & attempted & ~recovered).alias("funnel_fill_attempted_failed"),
    )


def prepass_summary(checked: DataFrame) -> DataFrame:
    """First-pass counts per country; the rate leaves out schools without a declared unit.

    `checked` has iso, the coordinates and qc_status (null without coordinates)."""
    status = F.col("qc_status")
    out = checked.groupBy("iso").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_known_point()).alias("with_coords"),
        F.count(status).alias("qc_checked"),
        *[
            _count(status == label).alias(label.lower())
            for label in ("MATCH", "MISMATCH", "OUT_OF_BOUNDS", "LIKELY_SWAPPED", "NO_POLYGON", "NO_RAW_ADM")
        ],
    )
    base = F.greatest(F.col("qc_checked") - F.col("no_raw_adm"), F.lit(1))
    return out.withColumns(
        {"missing_coords": F.col("total") - F.col("with_coords"), "match_rate_pct": percent(F.col("match"), base)}
    )


def coverage(registry: DataFrame, universe: DataFrame) -> DataFrame:
    """Georeferencing, precision tiers and coverage of the expected universe per country."""
    point = F.col("latitud").isNotNull()
    sector = F.col("sector")
    sums = registry.groupBy("iso").agg(
        F.count(F.lit(1)).alias("n_schools_in_file"),
        F.count_if(point).alias("n_georef"),
        _count(sector == "Public").alias("_pub"), _count((sector == "Public") & point).alias("_pubg"),
        _count(sector == "Private").alias("_prv"), _count((sector == "Private") & point).alias("_prvg"),
        F.count_if(_is("coordinate_quality", *config.HIGH_PRECISION)).alias("n_high_precision"),
        F.count_if(_is("coordinate_quality", *config.CENTROID_PRECISION)).alias("n_centroid_precision"),
        F.count_if(_is("coordinate_quality", *config.UNVERIFIED)).alias("n_unverified"),
    )
    n = F.col("n_schools_in_file")
    out = universe.join(sums, "iso", "left")
    shown = {
        "n_missing_coords": n - F.col("n_georef"),
        "pct_georef": percent(F.col("n_georef"), n),
        "n_georef_public": F.when(F.col("_pub") > 0, F.col("_pubg")),
        "pct_georef_public": percent(F.col("_pubg"), F.col("_pub")),
        "n_georef_private": F.when(F.col("_prv") > 0, F.col("_prvg")),
        "pct_georef_private": percent(F.col("_prvg"), F.col("_prv")),
        **{f"pct_{c}": percent(F.col(f"n_{c}"), n) for c in ("high_precision", "centroid_precision", "unverified")},
        "private_universe": F.col("total_universe_est") - F.col("public_universe"),
        "pct_coverage_vs_public": percent(n, F.col("public_universe")),
        "pct_coverage_vs_total": percent(n, F.col("total_universe_est")),
        "private_gap_flag": (F.col("sector_scope") == "public")
        & F.coalesce(F.col("total_universe_est") > F.col("public_universe") * 1.05, F.lit(False)),
    }
    return out.withColumns(shown).drop("_pub", "_pubg", "_prv", "_prvg")


def country_summary(registry: DataFrame, countries: DataFrame) -> DataFrame:
    """Current counts per country: sectors, georeferencing, precision, inclusion and labels."""
    include = F.col("include_in_spatial_indicators")
    point, raw = _known_point(), _raw_source()
    labels = [F.count_if(_is("coordinate_quality", q)).alias(f"q_{q}") for q in config.QUALITY_LABELS]
    sums = registry.groupBy("iso").agg(
        F.count(F.lit(1)).alias("current_total"),
        _count(F.col("sector") == "Public").alias("current_public"), _count(F.col("sector") == "Private").alias("current_private"),
        F.count_if(point).alias("n_georef_current"), F.count_if(point & raw).alias("n_georef_raw"),
        F.count_if(_is("coordinate_quality", *config.VERIFIED_LIKE)).alias("n_verified_like"),
        F.count_if(_is("coordinate_quality", *config.HIGH_PRECISION)).alias("n_high_precision"),
        F.count_if(_is("coordinate_quality", *config.CENTROID_PRECISION)).alias("n_centroid_precision"),
        F.count_if(_is("coordinate_quality", *config.UNVERIFIED)).alias("n_unverified"),
        _count(include).alias("n_include_spatial"), _count(~include).alias("n_exclude_spatial"),
        F.count_if(include.isNull()).alias("n_review_spatial"), *labels,
    )
    total = F.col("current_total")
    shares = ("verified_like", "high_precision", "centroid_precision", "unverified", "include_spatial", "exclude_spatial", "review_spatial", "georef_current", "georef_raw")
    extra = {
        "file_exists": total.isNotNull(),
        "current_unknown": total - F.col("current_public") - F.col("current_private"),
        "n_gap_filled": F.col("n_georef_current") - F.col("n_georef_raw"),
        **{f"pct_{c}": percent(F.col(f"n_{c}"), total) for c in shares},
        "pct_gps_validated": percent(F.col("q_gps_validated"), total),
        **{f"qg_{g}": sum((F.col(f"q_{m}") for m in members[1:]), F.col(f"q_{members[0]}")) for g, members in QUALITY_GROUPS.items()},
    }
    return countries.join(sums, "iso", "left").withColumns(extra)


def trace_status(rows: DataFrame) -> DataFrame:
    """Reconciliation status and root cause of a trace bucket; an open question to the
    source overrides the status."""
    status = F.create_map(*[F.lit(x) for k, (s, _) in TRACE_BUCKETS.items() for x in (k, s)])
    cause = F.create_map(*[F.lit(x) for k, (_, c) in TRACE_BUCKETS.items() for x in (k, c)])
    open_question = F.lower(clean_text(F.col("needs_source_owner_followup"))) == "true"
    return rows.withColumns(
        {
            "step01_reconciliation_status": F.when(open_question, "source_review_needed").otherwise(
                F.coalesce(F.try_element_at(status, F.col("trace_bucket")), F.lit("needs_review"))
            ),
            "step01_root_cause": F.coalesce(F.try_element_at(cause, F.col("trace_bucket")), F.lit("unmapped")),
        }
    )


def reconciliation_view(country: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of the view that the summary has."""
    return country.select(*[c for c in columns if c in country.columns])


def _by_scope(country: DataFrame) -> DataFrame:
    scopes = F.array(F.when(F.col("pipeline_enabled"), "pipeline"), F.when(F.col("analysis_included"), "analysis"))
    return country.withColumn("scope", F.explode(F.filter(scopes, lambda s: s.isNotNull())))


def scope_totals(country: DataFrame) -> DataFrame:
    """Totals over the pipeline and the analysis countries."""
    names = {
        "total_schools": "current_total", "public_schools": "current_public", "private_schools": "current_private",
        "n_georef_current": "n_georef_current", "n_georef_raw": "n_georef_raw", "n_verified_like": "n_verified_like",
        "n_gps_validated": "q_gps_validated", "n_high_precision": "n_high_precision",
        "n_centroid_precision": "n_centroid_precision", "n_unverified": "n_unverified",
        "n_include_spatial": "n_include_spatial", "n_exclude_spatial": "n_exclude_spatial", "n_review_spatial": "n_review_spatial",
    }
    sums = _by_scope(country).groupBy("scope").agg(
        F.count(F.lit(1)).alias("countries"), *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(n) for n, c in names.items()]
    )
    shares = [n for n in names if n.startswith("n_")]
    return sums.withColumns({f"pct_{n[2:]}": percent(F.col(n), F.col("total_schools")) for n in shares})


def _shares_of_total(country: DataFrame, prefix: str, names: Sequence[str], label: str, rest: str | None = None) -> DataFrame:
    """Counts of the columns prefix + name by scope, with their share of all schools; `rest`
    names a row for what they leave, where they leave something. One pass over the summary."""
    sums = _by_scope(country).groupBy("scope").agg(
        F.sum(F.coalesce("current_total", F.lit(0))).alias("_total"), *[F.sum(F.coalesce(F.col(f"{prefix}{n}"), F.lit(0))).alias(f"_{n}") for n in names]
    )
    rows = [F.struct(F.lit(n).alias(label), F.col(f"_{n}").alias("count")) for n in names]
    if rest is not None:
        seen = sum((F.col(f"_{n}") for n in names), F.lit(0))
        rows.append(F.when(seen != F.col("_total"), F.struct(F.lit(rest).alias(label), (F.col("_total") - seen).alias("count"))))
    long = sums.select("scope", "_total", F.explode(F.array(*rows)).alias("x")).filter("x IS NOT NULL")
    return long.select("scope", f"x.{label}", "x.count", percent(F.col("x.count"), F.col("_total")).alias("pct_of_total"))


def quality_totals(country: DataFrame) -> DataFrame:
    """Count and share per quality label and scope, with a remainder row when labels are missing."""
    return _shares_of_total(country, "q_", config.QUALITY_LABELS, "quality", "unclassified")


def rollup_totals(country: DataFrame) -> DataFrame:
    return _shares_of_total(country, "qg_", list(QUALITY_GROUPS), "bucket")


def build_summary(registry: DataFrame) -> DataFrame:
    return registry.groupBy("iso").agg(
        F.count(F.lit(1)).alias("total_k12"), _count(F.col("sector") == "Public").alias("public"),
        _count(F.col("sector") == "Private").alias("private"), F.count_if(_known_point()).alias("georef"),
    )


def registry_profile(df: DataFrame, categories: Sequence[str], keys: Sequence[str], coords: Sequence[str]) -> DataFrame:
    """Long profile: rows, values per category, rows beyond the first of a repeated key, and
    missing coordinates. Every row of the one scan gives its lines, which are summed."""
    def line(part: str, value: Column, n: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), value.cast("string").alias("value"), n.cast("bigint").alias("n"))

    one = F.lit(1)
    lines = [line("rows", F.lit(""), one), *[line("null", F.lit(c), F.col(c).isNull().cast("int")) for c in coords]]
    lines += [line(c, F.col(c), one) for c in categories]
    # keys are told apart by their JSON text, nulls among them; a prefix keeps them from categories
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    lines = [F.struct(F.lit(False).alias("keyed"), x.alias("x")) for x in lines] + [F.struct(F.lit(True).alias("keyed"), line("duplicates", key, one).alias("x"))]
    long = df.select(F.explode(F.array(*lines)).alias("l")).select("l.keyed", "l.x.*")
    empty = [(False, "rows", "", 0), *[(False, "null", c, 0) for c in coords], (True, "duplicates", None, 1)]  # lines of a table without rows
    long = long.union(df.sparkSession.createDataFrame(empty, "keyed boolean, part string, value string, n long"))
    counts = long.groupBy("keyed", "part", "value").agg(F.sum("n").alias("n"))
    shown = F.when(F.col("keyed"), "+".join(keys)).otherwise(F.col("value"))
    return counts.groupBy("keyed", "part", shown.alias("value")).agg(F.sum(F.when(F.col("keyed"), F.col("n") - 1).otherwise(F.col("n"))).alias("n")).drop("keyed")


def label_crosstab(registry: DataFrame, base: DataFrame, label: str) -> DataFrame:
    """Label by inclusion (yes, no, undecided) over the schools of the K-12 base."""
    include = F.col("include_in_spatial_indicators")
    kept = registry.join(base.select("iso", "id_centro"), ["iso", "id_centro"], "left_semi")
    return kept.groupBy(label).agg(
        _count(include).alias("include_true"), _count(~include).alias("include_false"), F.count_if(include.isNull()).alias("include_null")
    )


def inclusion_share(registry: DataFrame, base: DataFrame) -> DataFrame:
    kept = registry.join(base.select("iso", "id_centro"), ["iso", "id_centro"], "left_semi")
    return kept.groupBy("iso").agg(
        F.count(F.lit(1)).alias("n"), percent(_count(F.col("include_in_spatial_indicators")), F.count(F.lit(1))).alias("pct_include")
    )


def admin_concentration(registry: DataFrame, names: DataFrame, top: int = 5) -> DataFrame:
    """Admin units with the most schools that are excluded or undecided, a few per country."""
    include = F.col("include_in_spatial_indicators")
    units = registry.groupBy("iso", "adm1_pcode").agg(
        F.count(F.lit(1)).alias("n_total"), _count(include).alias("n_include"), _count(~include).alias("n_exclude"),
        F.count_if(include.isNull()).alias("n_review"),
    ).withColumn("n_problems", F.col("n_exclude") + F.col("n_review")).filter("n_problems > 0")
    worst = top_per_group(units, ["iso"], [F.desc("n_problems"), F.asc_nulls_last("adm1_pcode")], top)
    return worst.join(names, "adm1_pcode", "left").withColumn("pct_problems", percent(F.col("n_problems"), F.col("n_total")))


# ---- geocoding ------------------------------------------------------------------------


def _ledger_text(ledger: DataFrame) -> DataFrame:
    return ledger.withColumns(
        {
            "target_type": F.lower(clean_text(F.col("target_type"))), "acceptance": F.upper(clean_text(F.col("acceptance"))),
            "geocode_precision": F.lower(clean_text(F.col("geocode_precision"))),
        }
    )


def _ledger_counts() -> list[Column]:
    compare, fill = F.col("target_type") == "compare", F.col("target_type") == "fill"
    acceptance = F.col("acceptance")
    out = [
        F.count_if(compare & (acceptance == v)).alias(f"compare_{n}")
        for n, v in (("keep_original", "KEEP_ORIGINAL"), ("flag", "FLAG"), ("reject", "REJECT"), ("pending", ""))
    ]
    out.append(F.count_if(fill & acceptance.isin(*config.FILL_ACCEPTED)).alias("fill_accept"))
    return out + [
        F.count_if(fill & (acceptance == v)).alias(f"fill_{n}")
        for n, v in (
            ("accept_street", "ACCEPT"), ("accept_centroid", "ACCEPT_CENTROID"), ("accept_with_flag", "ACCEPT_WITH_FLAG"),
            ("reject", "REJECT"), ("pending", ""),
        )
    ]


def geocoding_overview(ledger: DataFrame, total_schools: int) -> DataFrame:
    """One row on the whole ledger. The list of countries has one entry per country."""
    rows = _ledger_text(ledger)
    compare, fill = F.col("target_type") == "compare", F.col("target_type") == "fill"
    out = rows.agg(
        F.count(F.lit(1)).alias("geocoder_universe_total"), F.count_if(compare).alias("compare_universe"), F.count_if(fill).alias("fill_universe"),
        F.array_join(F.sort_array(F.collect_set("iso")), ",").alias("processed_country_isos"),
        F.count_distinct("iso").alias("processed_countries"),
        F.count_distinct(F.when(compare, F.col("iso"))).alias("compare_countries"),
        F.count_distinct(F.when(fill, F.col("iso"))).alias("fill_countries"), *_ledger_counts(),
    )
    total = F.lit(total_schools)
    outside = F.greatest(total - F.col("geocoder_universe_total"), F.lit(0))
    return out.withColumns(
        {
            "total_schools": total, "outside_geocoder_universe": outside, "outside_geocoder_universe_pct": percent(outside, total),
            "compare_universe_pct": percent(F.col("compare_universe"), total), "fill_universe_pct": percent(F.col("fill_universe"), total),
        }
    )


def geocoding_by_country(ledger: DataFrame, ground_truth: DataFrame | None = None) -> DataFrame:
    rows = _ledger_text(ledger)
    out = rows.groupBy("iso").agg(
        F.count(F.lit(1)).alias("processed_total"),
        F.count_if(F.col("target_type") == "compare").alias("compare_total"), F.count_if(F.col("target_type") == "fill").alias("fill_total"),
        *[F.count_if(F.col("geocode_precision") == p).alias(f"precision_{p}") for p in ("street", "centroid", "uncertain")],
        *_ledger_counts(),
    )
    if ground_truth is None:
        return out
    known = ground_truth.select(
        "iso", F.col("sample_size").alias("gt_sample_size"), F.col("score_median").alias("gt_score_median"),
        F.col("dist_median_km").alias("gt_dist_median"), F.col("pct_lt_5km").alias("gt_pct_lt_5km"),
    )
    return out.join(known, "iso", "left")


def score_range(score: Column) -> Column:
    return F.when(score >= 95, ">=95").when(score >= 90, "90-95").when(score.isNotNull(), "<90")


def ground_truth(samples: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distance between answers and known points: `samples` has km and score."""
    km = F.col("km")
    keys = list(by)
    out = samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_size"), F.round(F.avg(km), 4).alias("dist_mean_km"), F.round(F.max(km), 4).alias("dist_max_km"),
        *[percent(F.count_if(km < k), F.count(F.lit(1))).alias(f"pct_lt_{k}km") for k in (1, 5, 15)],
        percent(F.count_if(km > 30), F.count(F.lit(1))).alias("pct_gt_30km"),
    )
    distances = exact_quantiles(samples, keys, "km", [0.5, 0.9], "_km")
    scores = exact_quantiles(samples, keys, "score", [0.5], "_score")
    return out.join(distances, keys, "left").join(scores, keys, "left").withColumns(
        {
            "dist_median_km": F.round(F.get("_km", F.lit(0)), 4), "dist_p90_km": F.round(F.get("_km", F.lit(1)), 4),
            "score_median": F.round(F.get("_score", F.lit(0)), 4),
        }
    ).drop("_km", "_score")


# ---- buildings ---------------------------------------------------------------------------


def building_kinds(schools: DataFrame) -> DataFrame:
    """Real and synthetic building ids per country."""
    synthetic = F.coalesce(F.col("id_edificio").contains("_SYN_"), F.lit(False))
    out = schools.groupBy("iso").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(~synthetic).alias("n_real"), F.count_if(synthetic).alias("n_synthetic")
    )
    return out.withColumns({f"pct_{k}": percent(F.col(f"n_{k}"), F.col("n_total")) for k in ("real", "synthetic")})


def building_outliers(schools: DataFrame, threshold: int = 20, top: int = 30) -> DataFrame:
    """Buildings with implausibly many schools and their most frequent quality label.

    Two aggregations: labels within a building, then the building; a tie goes to the label
    seen first.
    """
    labels = schools.groupBy("id_edificio", "coordinate_quality").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_seq").alias("seq"),
        F.min_by("iso", "row_seq").alias("iso"),
        F.min_by("latitud", F.when(F.col("latitud").isNotNull(), F.col("row_seq"))).alias("lat"),
        F.min(F.when(F.col("latitud").isNotNull(), F.col("row_seq"))).alias("lat_seq"),
        F.min_by("longitud", F.when(F.col("longitud").isNotNull(), F.col("row_seq"))).alias("lon"),
        F.min(F.when(F.col("longitud").isNotNull(), F.col("row_seq"))).alias("lon_seq"),
    )
    first = F.struct(F.col("n"), (-F.col("seq")).alias("s"))
    out = labels.groupBy("id_edificio").agg(
        F.sum("n").alias("n_schools"), F.min_by("iso", "seq").alias("iso"), F.min_by("lat", "lat_seq").alias("lat"),
        F.min_by("lon", "lon_seq").alias("lon"), F.max_by("coordinate_quality", first).alias("dominant_coordinate_quality"),
        F.max("n").alias("_top"),
    ).filter(F.col("n_schools") >= threshold)
    out = out.withColumns(
        {
            "dominant_quality_pct": percent(F.col("_top"), F.col("n_schools")),
            "is_synthetic": F.col("id_edificio").contains("_SYN_"),
        }
    ).drop("_top")
    # a top-k report
    return out.orderBy(F.desc("n_schools"), "id_edificio").limit(top)


# ---- reconciliation -----------------------------------------------------------------------


def source_check(current: DataFrame, source: DataFrame, dataset: str, fields: Mapping[str, str]) -> DataFrame:
    """Current metrics against a stored summary: which fields differ.

    `fields` maps a column of the summary to the current column; null equals null.
    """
    stored = source.select("iso", *[F.col(s).alias(f"_s_{s}") for s in fields])
    rows = current.join(stored, "iso")
    wrong = F.filter(
        F.array(*[F.when(~F.col(f"_s_{s}").eqNullSafe(F.col(c)), F.lit(s)) for s, c in fields.items()]),
        lambda name: name.isNotNull(),
    )
    return rows.select(
        "iso", F.lit(dataset).alias("dataset"), (F.size(wrong) > 0).alias("any_mismatch"), F.concat_ws(", ", wrong).alias("mismatch_fields")
    )


def attach_scope_flags(df: DataFrame, country: DataFrame) -> DataFrame:
    """Fresh scope flags; stale or suffixed copies are dropped first."""
    flags = ("pipeline_enabled", "analysis_included")
    stale = [c for c in df.columns if c in flags or any(c.startswith(f"{f}_") for f in flags)]
    return df.drop(*stale).join(country.select("iso", *flags), "iso", "left")


def in_funnel(ledger: DataFrame, funnel: DataFrame) -> DataFrame:
    """Ledger rows of schools the funnel counts."""
    return ledger.join(funnel.select("iso", "id_centro"), ["iso", "id_centro"], "left_semi")


def box_subset(df: DataFrame, box: tuple[float, float, float, float], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Rows inside (min_lon, min_lat, max_lon, max_lat)."""
    return df.filter(F.col(lon).between(box[0], box[2]) & F.col(lat).between(box[1], box[3]))


# ---- country info ---------------------------------------------------------------------------


def country_info(info: DataFrame, countries: DataFrame, targets: DataFrame, totals: DataFrame) -> DataFrame:
    """Source type, rendered labels and pending counts per country.

    A: the source has street addresses; B: only admin units; C: neither.
    """
    named = (clean_text(F.col("raw_adm1_label")) != "") | (clean_text(F.col("raw_adm2_label")) != "")
    kind = F.when(F.coalesce("has_addresses", F.lit(False)), "A").when(named, "B").otherwise("C")
    parts = F.filter(
        F.array(*[F.nullif(clean_text(F.col(c)), F.lit("")) for c in ("raw_adm1_label", "raw_adm2_label", "raw_locality_label")]),
        lambda x: x.isNotNull(),
    )
    labels = F.create_map(*[F.lit(x) for pair in VALIDATION_LABELS.items() for x in pair])
    pending = targets.filter("sector = 'total'").drop("sector")
    return (
        info.join(countries, "iso", "left").join(pending, "iso", "left").join(totals, "iso", "left")
        .withColumns(
            {
                "type": kind,
                "raw_admin_levels_es": F.when(F.size(parts) == 0, "—").otherwise(F.array_join(parts, ", ")),
                "has_addresses_label_es": F.when(F.coalesce("has_addresses", F.lit(False)), "Sí").otherwise("No"),
                "validation_level_es": F.coalesce(
                    F.try_element_at(labels, F.col("final_match_level")), F.col("final_match_level"), F.lit("—")
                ),
            }
        )
    )
