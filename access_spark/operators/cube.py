"""Wealth quintiles and the accessibility indicator cube."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.numeric import finite, percent, reach_flag
from access_spark.operators.keyed import running_total

POVERTY_QUINTILES = tuple(f"quintile_{i}" for i in range(1, 6))
WEALTH_QUINTILES = tuple(f"rwi_q{i}" for i in range(1, 6))
# grouping sets of the cube: (idgeo, geography keys, breakdown key)
SLICES = (
    ("country", (), None), ("country", (), "area"), ("country", (), "q_pov"), ("country", (), "q_rwi"),
    ("admin1", ("adm1_pcode",), None), ("admin1", ("adm1_pcode",), "area"),
    ("admin1", ("adm1_pcode",), "q_pov"), ("admin1", ("adm1_pcode",), "q_rwi"),
    ("admin2", ("adm2_pcode",), None), ("admin2", ("adm2_pcode",), "area"),
)


def weighted_quintiles(
    df: DataFrame,
    specs: Sequence[tuple[str, str, Sequence[str], bool]],
    weight: Column,
    group: Sequence[str] = ("iso",),
    tie: str = "cell_id",
) -> DataFrame:
    """Add quintile labels that hold about a fifth of the group weight each.

    `specs` lists (value column, new column, labels poorest first, high value is rich).
    Equal values keep the order of `tie` in either direction. Rows without a value or
    with a weight that is not positive get null. All specs share one pass over the narrow
    ordered columns; the labels are joined back on (group, tie).
    """
    keys = list(group)
    orders = [
        F.struct(
            F.lit(i).alias("_spec"),
            (finite(F.col(value)) * (1.0 if rich_high else -1.0)).alias("_order"),
        )
        for i, (value, _, _, rich_high) in enumerate(specs)
    ]
    valid = (
        df.select(*keys, tie, weight.cast("double").alias("_w"), F.explode(F.array(*orders)).alias("_o"))
        .select(*keys, tie, "_w", "_o.*")
        .filter(F.col("_order").isNotNull() & (F.col("_w") > 0))
    )
    ranked = running_total(valid, [*keys, "_spec"], "_order", tie, F.col("_w"), "_cum")
    share = (F.col("_cum") - 0.5 * F.col("_w")) / F.col("_cum_total")
    index = F.least(F.greatest((share * 5).cast("int"), F.lit(0)), F.lit(4)) + 1
    found = ranked.groupBy(*keys, tie).agg(
        *[F.max(F.when(F.col("_spec") == i, index)).alias(f"_q{i}") for i in range(len(specs))]
    )
    out = df.join(found, [*keys, tie], "left")
    labels = {
        name: F.get(F.array(*[F.lit(x) for x in texts]), F.col(f"_q{i}") - 1)
        for i, (_, name, texts, _) in enumerate(specs)
    }
    return out.withColumns(labels).drop(*[f"_q{i}" for i in range(len(specs))])


def area_label(area_class: Column) -> Column:
    """Published area name; an unknown class stops the job."""
    mapping = F.create_map(*[F.lit(x) for pair in config.AREA_LABELS.items() for x in pair])
    label = F.try_element_at(mapping, area_class)
    problem = F.raise_error(F.concat(F.lit("unmapped area_class: "), F.coalesce(area_class, F.lit("null"))))
    return F.coalesce(label, problem.cast("string"))


def school_age_population() -> Column:
    return F.col("pop_5_9") + F.col("pop_10_14") + F.col("pop_15_19")


def prepare_grid(grid: DataFrame) -> DataFrame:
    """Grid with the area label and both wealth quintiles."""
    specs = [
        ("poverty_rate", "q_pov", POVERTY_QUINTILES, False),
        ("rwi", "q_rwi", WEALTH_QUINTILES, True),
    ]
    out = weighted_quintiles(grid, specs, school_age_population())
    return out.withColumn("area", area_label(F.col("area_class")))


def quintile_coverage(prepared: DataFrame) -> DataFrame:
    """Share of the school-age population that has a quintile, per country."""
    weight = school_age_population()
    return prepared.groupBy("iso").agg(
        *[
            percent(F.sum(F.when(F.col(q).isNotNull(), weight).otherwise(0.0)), F.sum(weight)).alias(name)
            for q, name in (("q_pov", "pct_with_q_pov"), ("q_rwi", "pct_with_q_rwi"))
        ]
    )


def _combinations():
    return [
        (mode, level, sector)
        for mode in config.MODES
        for level in config.LEVELS
        for sector in ("public", "private")
    ]


def times_by_cell(matrix: DataFrame) -> DataFrame:
    """One row per cell with a minutes column for each mode, level and sector."""
    minutes = finite(F.col("minutes"))
    return matrix.groupBy("iso", "cell_id").agg(
        *[
            F.min(
                F.when((F.col("mode") == m) & (F.col("level") == lv) & (F.col("sector") == s), minutes)
            ).alias(f"t_{m}_{lv}_{s}")
            for m, lv, s in _combinations()
        ]
    )


def base_sums(prepared: DataFrame, matrix: DataFrame) -> DataFrame:
    """Population and reached population at the finest cube key.

    One shuffle of the matrix by cell, one join to the grid, and one aggregation of
    cell x (mode, level, sector) rows that carries the three bands as columns.
    """
    cells = prepared.join(times_by_cell(matrix), ["iso", "cell_id"], "left")
    items = []
    for mode in config.MODES:
        for level, (_, population, _) in config.LEVELS.items():
            public, private = (F.col(f"t_{mode}_{level}_{s}") for s in ("public", "private"))
            for sector, minutes in (
                ("total", F.least(public, private)), ("public", public), ("private", private),
            ):
                items.append(
                    F.struct(
                        F.lit(mode).alias("mode"), F.lit(level).alias("level"), F.lit(sector).alias("sector"),
                        F.col(population).cast("double").alias("pop"), minutes.alias("minutes"),
                    )
                )
    keys = ["iso", "adm1_pcode", "adm2_pcode", "area", "q_pov", "q_rwi"]
    long = cells.select(*keys, F.explode(F.array(*items)).alias("c")).select(*keys, "c.*")
    return long.groupBy(*keys, "mode", "level", "sector").agg(
        F.sum("pop").alias("pop"),
        *[
            F.sum(F.coalesce(F.col("pop") * reach_flag(F.col("minutes"), b), F.lit(0.0))).alias(f"reach_{b}")
            for b in config.TIME_BANDS
        ],
    )


def _present_combinations(matrix: DataFrame) -> DataFrame:
    """Sectors that exist in the matrix; 'total' exists when either sector does."""
    present = matrix.select("iso", "mode", "level", "sector").filter(F.col("sector").isin("public", "private"))
    total = present.withColumn("sector", F.lit("total"))
    return present.union(total).distinct()


def indicator_cube(
    prepared: DataFrame,
    matrix: DataFrame,
    admin_names: DataFrame,
    method: str,
    source: str,
    admin1_only: Sequence[str] = config.ADMIN1_ONLY,
) -> DataFrame:
    """Long indicator table: share of the age group within each time band.

    `prepared` is the output of prepare_grid, `matrix` has one row per (iso, cell_id,
    mode, level, sector) with minutes to the nearest school, `admin_names` maps
    adm1/adm2 codes to names. Slices whose population rounds to zero are left out.
    """
    base = base_sums(prepared, matrix)
    combos = ["iso", "mode", "level", "sector"]
    dims = ["adm1_pcode", "adm2_pcode", "area", "q_pov", "q_rwi"]
    sets = [
        [*combos, *geo, *([by] if by else [])] for _, geo, by in SLICES
    ]
    sums = base.groupingSets(sets, *combos, *dims).agg(
        F.sum("pop").alias("pop"),
        *[F.sum(f"reach_{b}").alias(f"reach_{b}") for b in config.TIME_BANDS],
        *[F.grouping(d).alias(f"_g_{d}") for d in dims],
    )
    # a key that takes part in the set but is null is a dropped group
    real = F.lit(True)
    for d in dims:
        real = real & ((F.col(f"_g_{d}") == 1) | F.col(d).isNotNull())
    by_adm2, by_adm1 = F.col("_g_adm2_pcode") == 0, F.col("_g_adm1_pcode") == 0
    sums = sums.filter(real & (F.round("pop", 2) > 0))
    if admin1_only:
        sums = sums.filter(~(by_adm2 & F.col("iso").isin(*admin1_only)))
    parents = (
        prepared.filter(F.col("adm1_pcode").isNotNull() & F.col("adm2_pcode").isNotNull())
        .groupBy("iso", "adm2_pcode")
        .agg(F.min_by("adm1_pcode", "cell_id").alias("parent"))
    )
    rows = (
        sums.join(_present_combinations(matrix), combos, "left_semi")
        .join(parents, ["iso", "adm2_pcode"], "left")
        .withColumn("idgeo", F.when(by_adm2, "admin2").when(by_adm1, "admin1").otherwise("country"))
        .withColumn("admin1_pcode", F.coalesce(F.when(by_adm2, F.col("parent")), F.col("adm1_pcode"), F.lit("")))
        .withColumn("admin2_pcode", F.coalesce("adm2_pcode", F.lit("")))
        .withColumn("area_out", F.coalesce("area", F.lit("Total")))
        .withColumn("quintile", F.coalesce("q_pov", "q_rwi", F.lit("Total")))
    )
    names1 = admin_names.groupBy(F.col("adm1_pcode").alias("admin1_pcode")).agg(F.max("adm1_name").alias("admin1_name"))
    names2 = admin_names.groupBy(F.col("adm2_pcode").alias("admin2_pcode")).agg(F.max("adm2_name").alias("admin2_name"))
    rows = rows.join(names1, "admin1_pcode", "left").join(names2, "admin2_pcode", "left")
    ages = F.create_map(*[F.lit(x) for level, meta in config.LEVELS.items() for x in (level, meta[0])])
    sectors = F.create_map(*[F.lit(x) for pair in config.SECTOR_LABELS.items() for x in pair])
    bands = F.explode(
        F.array(*[F.struct(F.lit(f"le{b}").alias("band"), F.col(f"reach_{b}").alias("num")) for b in config.TIME_BANDS])
    )
    return rows.withColumn("b", bands).select(
        F.col("iso").alias("isoalpha3"),
        "idgeo",
        "admin1_pcode",
        F.coalesce("admin1_name", F.lit("")).alias("admin1_name"),
        "admin2_pcode",
        F.coalesce("admin2_name", F.lit("")).alias("admin2_name"),
        F.lit(config.INDICATOR).alias("indicator"),
        "mode",
        F.col("level").alias("education_level"),
        F.element_at(ages, F.col("level")).alias("age"),
        F.element_at(sectors, F.col("sector")).alias("sector"),
        F.col("area_out").alias("area"),
        "quintile",
        F.col("b.band").alias("time_band"),
        F.round(100.0 * F.col("b.num") / F.col("pop"), 4).alias("value"),
        F.round("pop", 2).alias("population_base"),
        F.lit(config.POPULATION_YEAR).alias("year"),
        F.lit(method).alias("method"),
        F.lit(source).alias("source"),
    )


def publication_rule(point: DataFrame, other: DataFrame) -> DataFrame:
    """Compare two methods slice by slice: below 5 points one value is published, up to
    20 a range, above that the slice waits for review."""
    keys = list(config.CUBE_KEY)
    pair = point.select(*keys, F.col("value").alias("value_a")).join(
        other.select(*keys, F.col("value").alias("value_b")), keys
    )
    gap = F.abs(F.round(F.col("value_a") - F.col("value_b"), 4))
    return pair.withColumn("gap", gap).withColumn(
        "publication",
        F.when(F.col("gap") < 5, "point").when(F.col("gap") <= 20, "range").otherwise("pending"),
    )


def weighted_mean_minutes(prepared: DataFrame, matrix: DataFrame, population: str = "pop_total") -> DataFrame:
    """Population-weighted mean travel time over reachable cells."""
    keys = ["iso", "mode", "level", "sector"]
    rows = prepared.select("iso", "cell_id", F.col(population).alias("w")).join(matrix, ["iso", "cell_id"])
    minutes = finite(F.col("minutes"))
    known = F.when(minutes.isNotNull(), F.col("w"))
    return rows.groupBy(*keys).agg(
        F.round(F.sum(known * minutes) / F.nullif(F.sum(known), F.lit(0.0)), 4).alias("mean_minutes")
    )
