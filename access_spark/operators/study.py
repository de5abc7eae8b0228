"""Wealth against poverty: weighted statistics, rank correlation and decile tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark.functions.numeric import finite, percent
from access_spark.operators.keyed import exact_quantiles, running_total


def weighted_stats(rows: DataFrame, keys: Sequence[str], value: str, error: str, weight: str) -> DataFrame:
    """Count, weight, weighted mean and variance (around the mean, second pass), plain means."""
    w, x = F.col(weight), F.col(value)
    total = F.nullif(F.greatest(F.sum(w), F.lit(0.0)), F.lit(0.0))
    means = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"), F.coalesce(total, F.lit(0.0)).alias("pop_total"), (F.sum(w * x) / total).alias("weighted_mean"),
        F.avg(x).alias("unweighted_mean"), F.avg(error).alias("error_mean"),
    )
    off = x - F.col("weighted_mean")
    spread = (
        rows.join(means.select(*keys, "weighted_mean"), list(keys))
        .groupBy(*keys).agg((F.sum(w * off * off) / total).alias("weighted_var"))
    )
    return means.join(spread, list(keys), "left")


def average_ranks(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Rank of each value in its group, ties share their average rank.

    Ranks are computed on distinct values: count per value, running count, then joined
    back, so a frequent value is one row.
    """
    keys = list(group)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(
        counts.withColumn("_tie", F.lit(0)), keys, value, "_tie", F.col("_n"), "_cum"
    ).select(*keys, value, (F.col("_cum") - (F.col("_n") - 1) / 2.0).alias(name))
    return df.join(ranked, [*keys, value], "left")


def correlation(x: str, y: str) -> Column:
    """Aggregate: Pearson correlation, null where a side has no spread (`corr` would fail on it)."""
    spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
    return F.when(spread.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.covar_pop(x, y) / spread)))


def correlations(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Spearman and Pearson correlation per group over rows with both values; null, like its
    p-value, where one of them is the same in all rows."""
    keys = list(group)
    rows = df.select(*keys, finite(F.col(x)).alias("_x"), finite(F.col(y)).alias("_y")).filter("_x IS NOT NULL AND _y IS NOT NULL")
    ranked = average_ranks(average_ranks(rows, keys, "_x", "_rx"), keys, "_y", "_ry")
    return ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), correlation("_rx", "_ry").alias("spearman_rho"), correlation("_x", "_y").alias("pearson_r")
    ).filter("n >= 2").withColumns(
        {"spearman_p": correlation_p_value(F.col("spearman_rho"), F.col("n")), "pearson_p": correlation_p_value(F.col("pearson_r"), F.col("n"))}
    )


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation of n pairs by Student's t with n - 2 degrees.

    The tail is the regularised incomplete beta function, as a finite sum for whole degrees;
    null below 3 pairs or without a correlation, 0 for a perfect one.
    """
    df = n - 2
    x = 1 - r * r  # cos^2 of the angle whose tangent is t / sqrt(df)
    angle = F.asin(F.least(F.abs(r), F.lit(1.0)))
    terms = F.floor((df - F.when(df % 2 == 0, 2).otherwise(3)) / 2).cast("int")
    # a sum of (x^k times the product of odd over even numbers) up to the degrees
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    steps = F.when(terms >= 1, F.sequence(F.lit(1), F.greatest(terms, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    odd_degrees = df % 2 == 1

    def grow(acc: Column, k: Column) -> Column:
        ratio = F.when(odd_degrees, (2.0 * k) / (2.0 * k + 1)).otherwise((2.0 * k - 1) / (2.0 * k))
        term = acc["term"] * ratio * x
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.aggregate(steps, state, grow)["sum"]
    inside_even = F.abs(r) * total
    inside_odd = 2.0 / 3.141592653589793 * (angle + F.when(df > 1, F.abs(r) * F.sqrt(x) * total).otherwise(0.0))
    inside = F.when(odd_degrees, inside_odd).otherwise(inside_even)
    return F.when((df >= 1) & r.isNotNull(), F.greatest(1.0 - inside, F.lit(0.0)))


def with_decile(df: DataFrame, group: Sequence[str], value: str, name: str, buckets: int = 10) -> DataFrame:
    """Quantile bucket 1..n from exact interpolated edges; equal edges are merged, a value on
    an edge belongs to the lower bucket."""
    keys = list(group)
    edges = exact_quantiles(df, keys, value, [i / buckets for i in range(buckets + 1)], "_all").select(
        *keys, F.array_distinct("_all").alias("_edges")
    )
    below = F.size(F.filter("_edges", lambda e: e < F.col(value)))
    return df.join(edges, keys).withColumn(name, F.greatest(below, F.lit(1))).drop("_edges")


def decile_crosstab(df: DataFrame, group: Sequence[str], wealth: str, poverty: str) -> DataFrame:
    """Counts per wealth decile (1 = richest) and poverty decile (1 = lowest)."""
    keys = list(group)
    rows = df.select(*keys, (-F.col(wealth)).alias("_w"), F.col(poverty).alias("_p")).filter("_w IS NOT NULL AND _p IS NOT NULL")
    both = with_decile(with_decile(rows, keys, "_w", "rwi_decile"), keys, "_p", "pov_decile")
    return both.groupBy(*keys, "rwi_decile", "pov_decile").agg(F.count(F.lit(1)).alias("n"))


def decile_agreement(df: DataFrame, group: Sequence[str], wealth: str, poverty: str) -> DataFrame:
    """Shares of units in the same decile and at most one apart (wealth counted from the rich end)."""
    keys = list(group)
    rows = df.select(*keys, F.col(wealth).alias("_w"), F.col(poverty).alias("_p")).filter("_w IS NOT NULL AND _p IS NOT NULL")
    both = with_decile(with_decile(rows, keys, "_w", "_dw"), keys, "_p", "_dp")
    gap = F.abs((11 - F.col("_dw")) - F.col("_dp"))
    return both.groupBy(*keys).agg(
        F.avg((gap == 0).cast("int")).alias("decile_exact_match"), F.avg((gap <= 1).cast("int")).alias("decile_within_one")
    )


def strongest_target(tests: DataFrame, countries: DataFrame) -> DataFrame:
    """Per country the poverty measure with the strongest correlation, the other one as
    second, and a status. `tests` has iso, target, n, spearman_rho, decile shares and the
    interval; `countries` has iso with has_wealth, has_adm2, has_poverty, blocked."""
    order = F.struct(F.abs(F.col("spearman_rho")).alias("a"), F.when(F.col("target") == "POVERTY_RATE", 1).otherwise(0).alias("b"))
    rows = tests.filter(F.col("target").isin("POVERTY_RATE", "NBI_RATE"))
    picked = rows.groupBy("iso").agg(
        F.max_by(F.struct("*"), order).alias("first"), F.min_by(F.struct("*"), order).alias("last"), F.count(F.lit(1)).alias("_n")
    )
    first, second = F.col("first"), F.when(F.col("_n") > 1, F.col("last"))
    done = F.col("_n").isNotNull()
    status = (
        F.when(~F.col("has_wealth"), "no_rwi_data")
        .when(~F.col("has_adm2"), "no_adm2_polygons")
        .when(~F.col("has_poverty"), "no_poverty_data")
        .when(F.col("blocked") & ~done, "blocked")
        .when(~done, "pending")
        .otherwise("completed")
    )
    out = countries.join(picked, "iso", "left").withColumn("status", status)
    ok = F.col("status") == "completed"
    rho = first["spearman_rho"]
    return out.select(
        "iso", "status",
        F.when(ok, first["target"]).alias("target_used"), F.when(ok, first["n"]).alias("n"), F.when(ok, rho).alias("spearman_rho"),
        F.when(ok, F.round(first["decile_within_one"] * 100, 1)).alias("decile_within_one"), F.when(ok, F.round(rho * rho, 3)).alias("r2"),
        F.when(ok, second["target"]).alias("secondary_target"), F.when(ok, second["spearman_rho"]).alias("secondary_rho"),
    )


def quintile_composition(schools: DataFrame, quintile: str) -> DataFrame:
    """Sector shares, and public schools with upper secondary, per wealth quintile."""
    public = F.col("sector") == "Public"
    return schools.filter(F.col(quintile).isNotNull()).groupBy("iso", quintile).agg(
        F.count(F.lit(1)).alias("n"), percent(F.count_if(public), F.count(F.lit(1))).alias("pct_public"),
        percent(F.count_if(F.col("sector") == "Private"), F.count(F.lit(1))).alias("pct_private"),
        percent(F.count_if(public & (F.col("nivel_secalta") == 1)), F.count_if(public)).alias("pct_public_secalta"),
    )


def equal_quintile(schools: DataFrame, group: Sequence[str], value: str, tie: str, name: str) -> DataFrame:
    """Quintile 1..5 with equal numbers of rows, lowest values first."""
    keys = list(group)
    ranked = running_total(schools.filter(F.col(value).isNotNull()), keys, value, tie, F.lit(1).cast("bigint"), "_r")
    bucket: Column = F.floor((F.col("_r") - 1) * 5 / F.col("_r_total")).cast("int") + 1
    return ranked.withColumn(name, bucket).drop("_r", "_r_total")
