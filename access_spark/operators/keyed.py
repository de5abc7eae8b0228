"""Keyed table operators: first and last rows, lookups, prefix sums and numbering.

None of them puts a whole key group into one task: first and last rows are partial
aggregates, group facts are aggregated and joined back (AQE splits a hot key), and
running totals are computed per ordered slice and shifted by slice offsets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from access_spark.session import cut_lineage, parallelism

class DuplicateKeyError(ValueError):
    """A table that must be unique on its key is not."""


def keep_first(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row with the lowest order value per key, by a partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.min_by(F.struct(*rest), order).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row with the highest order value per key."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.max_by(F.struct(*rest), order).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def guarded_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The same rows under a plan that fails, with a message that names the key, as soon as a
    task meets a key twice. No action of its own: the test is a streamed row number in the
    partitioning that a join on the keys needs anyway."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    message = F.concat(F.lit(f"{what}: duplicate keys {list(keys)}, e.g. "), shown)
    held = df.withColumn("_times", number)
    return held.filter(F.when(F.col("_times") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("_times")


def one_to_one_join(left: DataFrame, right: DataFrame, on: Sequence[str], what: str) -> DataFrame:
    """Left join that refuses repeated keys on either side, null keys among them, when it runs."""
    one = guarded_unique(left, on, f"{what} (left side)")
    other = guarded_unique(right, on, f"{what} (right side)")
    return one.join(other, list(on), "left")


def union_columns(*frames: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side are null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _block_ends(cuts: str, block: int) -> Column:
    """Last element of every full block of sorted cut points."""
    return F.filter(cuts, lambda _, i: (i + 1) % block == 0)


def _count_below(cuts: str, ends: str, value: Column, block: int) -> Column:
    """Number of sorted cut points below a value: whole blocks first, then one block."""
    blocks = F.size(F.filter(ends, lambda c: c < value))
    rest = F.slice(cuts, blocks * block + 1, F.lit(block))
    return blocks * block + F.size(F.filter(rest, lambda c: c < value))


def ordered_slices(df: DataFrame, group: Sequence[str], value: str, tie: str, slices: int | None = None) -> DataFrame:
    """Rows with the slice of their group that they belong to, in the order of `value`.

    Cuts are approximate quantiles. Odd slices hold one value, equal to a cut; they are
    split by `tie` into as many parts as cuts equal it, so a value may hold any share of the
    rows and a group has no more than two pieces a cut. Adds `_slice`, `_part` and the group's
    size `_group_rows`.

    Approximate quantiles follow the order rows arrive in, which a second reading of a shuffle
    changes, so the cuts are checkpointed: every use of the rows deals them to the same slices.
    """
    slices = slices or parallelism(df.sparkSession)
    block = max(2, math.isqrt(slices))
    group = list(group)
    probs = F.expr(f"array({', '.join(f'{i / slices!r}D' for i in range(1, slices))})")
    accuracy = F.lit(max(100, 20 * slices))
    cuts = df.groupBy(*group).agg(
        F.percentile_approx(value, probs, accuracy).alias("_all_cuts"),
        F.percentile_approx(tie, probs, accuracy).alias("_tie_cuts"),
        F.count(F.lit(1)).alias("_group_rows"),
    )
    cuts = cuts.withColumn("_cuts", F.array_distinct("_all_cuts"))
    shares = F.transform("_cuts", lambda cut: F.size(F.filter("_all_cuts", lambda other: other == cut)))
    cuts = cuts.withColumns({"_shares": shares, "_ends": _block_ends("_cuts", block), "_tie_ends": _block_ends("_tie_cuts", block)}).drop("_all_cuts")
    # shuffled after it was read, so that AQE knows how small it is
    rows = df.join(cut_lineage(cuts).repartition(*group), group)
    rows = rows.withColumn("_below", _count_below("_cuts", "_ends", F.col(value), block))
    at_cut = F.coalesce(F.get("_cuts", F.col("_below")) == F.col(value), F.lit(False))
    share = F.get("_shares", F.col("_below"))
    tie_part = F.floor(_count_below("_tie_cuts", "_tie_ends", F.col(tie), block) * share / slices).cast("int")
    return rows.withColumns(
        {
            "_slice": 2 * F.col("_below") + at_cut.cast("int"),
            "_part": F.when(at_cut, tie_part).otherwise(0),
        }
    ).drop("_cuts", "_shares", "_tie_cuts", "_ends", "_tie_ends", "_below")


def running_total(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    tie: str,
    weight: Column,
    name: str,
    slices: int | None = None,
) -> DataFrame:
    """Running sum of `weight` in the order (value, tie) inside each group.

    Adds `name` (running sum including the row), `<name>_total` (group sum).
    A group may hold any share of the table: its rows are cut into ordered slices at
    approximate quantiles of `value` (and of `tie` for rows that equal a cut point, so
    one repeated value is split as well). The slice of a row depends only on the row and
    the cut points, the sums are exact, and only slice sums cross slice borders.
    `value` and `tie` are numeric and not null, (value, tie) is unique in a group.
    """
    group = list(group)
    rows = ordered_slices(df, group, value, tie, slices).drop("_group_rows").withColumn("_weight", weight)
    sums = rows.groupBy(*group, "_slice", "_part").agg(F.sum("_weight").alias("_sum"))
    # one row per slice: bounded by the number of slices, whatever the group size
    across = Window.partitionBy(*group).orderBy("_slice", "_part")
    offsets = sums.select(
        *group,
        "_slice",
        "_part",
        (F.sum("_sum").over(across) - F.col("_sum")).alias("_before"),
        F.sum("_sum").over(Window.partitionBy(*group)).alias(f"{name}_total"),
    )
    inside = (
        Window.partitionBy(*group, "_slice", "_part")
        .orderBy(value, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_inside", F.sum("_weight").over(inside))
        .join(offsets, [*group, "_slice", "_part"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_slice", "_part", "_weight", "_inside", "_before")
    )


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float], name: str = "quantiles"
) -> DataFrame:
    """Exact quantiles per group with linear interpolation, as an array in the order of `probs`.

    Values are counted, the counts are accumulated with `running_total`, and the two
    neighbours of each position are picked by an aggregate, so no task holds the values of
    a group.
    """
    keys = list(group)
    counts = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL").groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranked = running_total(counts.withColumn("_tie", F.lit(0)), keys, "_v", "_tie", F.col("_n"), "_cum")
    first, last = F.col("_cum") - F.col("_n"), F.col("_cum") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, last), F.col("_v")))

    picks = []
    for i, p in enumerate(probs):
        place = (F.col("_cum_total") - 1) * F.lit(float(p))
        picks += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}"), F.max(place - F.floor(place)).alias(f"_f{i}")]
    found = ranked.groupBy(*keys).agg(*picks)
    parts = [F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}") for i in range(len(probs))]
    return found.select(*keys, F.array(*parts).alias(name))


def number_rows(
    df: DataFrame, group: Sequence[str], value: str, tie: str, name: str, start: int = 1
) -> DataFrame:
    """Gap-free numbering in the order (value, tie) inside each group."""
    numbered = running_total(df, group, value, tie, F.lit(1).cast("bigint"), name)
    return numbered.withColumn(name, F.col(name) - 1 + start).drop(f"{name}_total")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows per group. Spark limits the rank inside each input partition
    before the shuffle, so a group sends at most n rows per partition to one task."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
