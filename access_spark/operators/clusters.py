"""Schools that share a point: sizes, differing addresses and reports.

Facts of a point are partial aggregates joined back to its rows, so a placeholder
coordinate shared by a large part of the table stays spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.numeric import flag, percent, round_even
from access_spark.functions.text import clean_text



def _lat() -> Column:
    return F.col("latitud")


def _lon() -> Column:
    return F.col("longitud")


def usable_point() -> Column:
    """Both coordinates known and neither exactly zero."""
    return F.coalesce((_lat() != 0) & (_lon() != 0), F.lit(False))


def _address_key() -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("raw_street", "raw_adm2", "raw_locality")]
    return F.lower(F.concat_ws("|", *parts))


def _known_word(name: str) -> Column:
    word = F.lower(clean_text(F.col(name)))
    return F.when(~word.isin("", "nan", "none"), word)


def _differs(col: Column) -> Column:
    return F.coalesce(F.min(col) != F.max(col), F.lit(False))


def with_exact_clusters(df: DataFrame, decimals: int = 5, frontier_km: float = config.BOUNDARY_ZONE_KM) -> DataFrame:
    """Evidence from the other schools at the same rounded point.

    Adds qc_cluster_size_exact, qc_cluster_diff_addr_exact, qc_cluster_diff_admin_locality
    and qc_n2_frontier_rescue. Needs adm0_pcode, the coordinates, raw_street, raw_adm1,
    raw_adm2, raw_locality and qc_distance_to_raw_polygon_km.
    """
    both = _lat().isNotNull() & _lon().isNotNull()
    keyed = df.withColumns(
        {
            "_lat": F.when(both, round_even(_lat(), decimals)),
            "_lon": F.when(both, round_even(_lon(), decimals)),
        }
    )
    usable = usable_point()
    facts = (
        keyed.filter(both)
        .groupBy("adm0_pcode", "_lat", "_lon")
        .agg(
            F.count_if(usable).alias("_n"),
            _differs(_address_key()).alias("_addr"),
            (
                _differs(_known_word("raw_adm1"))
                | _differs(_known_word("raw_adm2"))
                | _differs(_known_word("raw_locality"))
            ).alias("_place"),
            F.min(F.when(usable, F.col("qc_distance_to_raw_polygon_km"))).alias("_edge"),
        )
    )
    out = keyed.join(facts, ["adm0_pcode", "_lat", "_lon"], "left")
    return out.withColumns(
        {
            "qc_cluster_size_exact": F.when(usable, F.col("_n")).otherwise(F.lit(0)).cast("bigint"),
            "qc_cluster_diff_addr_exact": F.coalesce("_addr", F.lit(False)),
            "qc_cluster_diff_admin_locality": F.coalesce("_place", F.lit(False)),
            "qc_n2_frontier_rescue": usable
            & F.coalesce((F.col("_n") == 2) & (F.col("_edge") < frontier_km), F.lit(False)),
        }
    ).drop("_lat", "_lon", "_n", "_addr", "_place", "_edge")


def with_near_clusters(df: DataFrame, bin_degrees: float = config.CLUSTER_BIN_DEGREES) -> DataFrame:
    """Number of schools in the same bin of about 50 m (qc_cluster_size_50m)."""
    usable = usable_point()
    keyed = df.withColumns(
        {
            "_by": F.when(usable, F.rint(_lat() / bin_degrees).cast("bigint")),
            "_bx": F.when(usable, F.rint(_lon() / bin_degrees).cast("bigint")),
        }
    )
    sizes = (
        keyed.filter(F.col("_by").isNotNull())
        .groupBy("adm0_pcode", "_by", "_bx")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    out = keyed.join(sizes, ["adm0_pcode", "_by", "_bx"], "left")
    return out.withColumn("qc_cluster_size_50m", F.coalesce("_n", F.lit(0)).cast("bigint")).drop("_by", "_bx", "_n")


def shared_point_report(df: DataFrame, decimals: int = 5) -> DataFrame:
    """Schools at a point used twice or more, with the size and whether addresses differ."""
    both = _lat().isNotNull() & _lon().isNotNull()
    keyed = df.filter(both).withColumns(
        {"_lat": round_even(_lat(), decimals), "_lon": round_even(_lon(), decimals)}
    )
    key = F.concat_ws(
        "|", *[F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in ("raw_street", "raw_adm2", "raw_locality")]
    )
    facts = keyed.groupBy("adm0_pcode", "_lat", "_lon").agg(
        F.count(F.lit(1)).alias("n_schools"), _differs(key).alias("diff_addr")
    )
    shared = facts.filter("n_schools > 1")
    return keyed.join(shared, ["adm0_pcode", "_lat", "_lon"]).drop("_lat", "_lon")


def shared_point_summary(df: DataFrame, decimals: int = 5) -> DataFrame:
    """Per country: schools at shared points, with differing addresses, and in groups of 5 or more."""
    both = _lat().isNotNull() & _lon().isNotNull()
    key = F.concat_ws(
        "|", *[F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in ("raw_street", "raw_adm2", "raw_locality")]
    )
    points = (
        df.filter(both)
        .groupBy("adm0_pcode", round_even(_lat(), decimals).alias("_lat"), round_even(_lon(), decimals).alias("_lon"))
        .agg(F.count(F.lit(1)).alias("n"), _differs(key).alias("diff"))
    )
    n = F.sum("n")
    out = points.groupBy("adm0_pcode").agg(
        n.alias("n_with_coords"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("dup_coord_schools"),
        F.sum(F.when((F.col("n") > 1) & F.col("diff"), F.col("n")).otherwise(0)).alias("dup_diff_addr"),
        F.sum(F.when(F.col("n") >= 5, F.col("n")).otherwise(0)).alias("dup_ge5_schools"),
    )
    whole = F.greatest(F.col("n_with_coords"), F.lit(1))
    return out.withColumns(
        {
            "dup_coord_pct": percent(F.col("dup_coord_schools"), whole),
            "dup_diff_addr_pct": percent(F.col("dup_diff_addr"), whole),
            "dup_ge5_pct": percent(F.col("dup_ge5_schools"), whole),
        }
    )


def cluster_size_distribution(df: DataFrame, decimals: int = 5) -> DataFrame:
    """Clusters of five and more by size band, with median, mean and largest size."""
    n = F.col("n")
    band = (
        F.when(n < 10, "5-9").when(n < 20, "10-19").when(n < 50, "20-49").when(n < 100, "50-99")
        .when(n < 500, "100-499").when(n < 1000, "500-999").otherwise("1000+")
    )
    points = (
        df.filter(usable_point())
        .groupBy("adm0_pcode", round_even(_lat(), decimals).alias("_lat"), round_even(_lon(), decimals).alias("_lon"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(n >= config.CLUSTER_THRESHOLD)
    )
    return points.groupBy("adm0_pcode", band.alias("size_band")).agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.sum("n").alias("n_schools"),
        F.median("n").alias("median_size"),
        F.round(F.avg("n"), 4).alias("mean_size"),
        F.max("n").alias("max_size"),
    )


def centroid_concentration(df: DataFrame, decimals: int = 5) -> DataFrame:
    """Per admin unit: schools at centroid points, their share of the country's, and the
    largest shared point."""
    points = (
        df.filter(usable_point())
        .groupBy(
            "adm0_pcode", "adm1_pcode",
            round_even(_lat(), decimals).alias("_lat"), round_even(_lon(), decimals).alias("_lon"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= config.CLUSTER_THRESHOLD)
    )
    units = points.groupBy("adm0_pcode", "adm1_pcode").agg(
        F.sum("n").alias("n_schools"), F.max("n").alias("largest_point")
    )
    total = units.groupBy("adm0_pcode").agg(F.sum("n_schools").alias("_total"))
    return units.join(total, "adm0_pcode").withColumn("pct_of_country", percent(F.col("n_schools"), F.col("_total"))).drop("_total")


def geocode_targets(df: DataFrame) -> DataFrame:
    """Boolean target buckets per school in one pass over the enriched registry.

    missing, zeros, out_of_bounds, mismatches, dup_addr, centroids; the centroid bucket
    keeps only differing addresses in countries where any cluster has them. When an id
    repeats, its rows are taken one by one.
    """
    size = F.coalesce(F.col("qc_cluster_size_exact"), F.lit(0)) >= config.CLUSTER_THRESHOLD
    differs = F.coalesce(F.col("qc_cluster_diff_addr_exact"), F.lit(False))
    status = lambda level: F.coalesce(F.col(f"qc_adm{level}_status") == "MISMATCH", F.lit(False))
    rows = df.withColumns(
        {
            "missing": _lat().isNull() | _lon().isNull(),
            "zeros": F.coalesce((_lat() == 0) | (_lon() == 0), F.lit(False)),
            "out_of_bounds": F.coalesce(~F.col("qc_in_bounds"), F.lit(False)) & usable_point(),
            "mismatches": status(1) | status(2),
            "dup_addr": differs,
            "_big": size,
        }
    )
    has_addresses = rows.groupBy("adm0_pcode").agg(F.max(flag(F.col("dup_addr"))).alias("_any"))
    return (
        rows.join(has_addresses, "adm0_pcode", "left")
        .withColumn("centroids", F.col("_big") & ((F.col("_any") == 0) | F.col("dup_addr")))
        .withColumn("centroids_address_filtered", F.col("_any") == 1)
        .drop("_big", "_any")
    )


def downgrade_shared_results(results: DataFrame, threshold: int = 5, decimals: int = 3) -> DataFrame:
    """Geocoder answers that many schools share are centroids, not street matches."""
    lat, lon = F.col("geocoded_lat"), F.col("geocoded_lon")
    keyed = results.withColumns({"_lat": round_even(lat, decimals), "_lon": round_even(lon, decimals)})
    counts = (
        keyed.filter(lat.isNotNull())
        .groupBy("iso", "_lat", "_lon")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= threshold)
    )
    shared = F.col("_n").isNotNull() & (F.col("geocode_precision") == "street")
    return (
        keyed.join(counts, ["iso", "_lat", "_lon"], "left")
        .withColumn("geocode_precision", F.when(shared, F.lit("centroid")).otherwise(F.col("geocode_precision")))
        .drop("_lat", "_lon", "_n")
    )
