"""Helpers shared by the operators: tables, global order, connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from access_spark.session import cut_lineage, parallelism


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, `doc`: what is added beside it cannot clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def partitions_for(spark: SparkSession, rows: float, rows_each: int) -> int:
    """Partitions that hold about `rows_each` rows, at least as many as Spark's own setting."""
    return max(parallelism(spark), int(rows // rows_each) + 1)


def range_slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows dealt into ranges of a global order; `_slice` numbers the ranges in that order.

    The result is checkpointed: ranges come from a sample, and a lost executor must not
    change them. Make `order` unique, so that a repeated key is split as well.
    """
    ranged = df.repartitionByRange(parallelism(df.sparkSession), *order)
    return cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))


def sums_before(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Add, under each name, the sum of an integer expression over all earlier rows.

    The order is global. Ranges are summed apart and shifted by the totals of the ranges
    before them, of which there is one row per partition; no task holds more than a range.
    """
    held = {name: f"_of_{name}" for name in sums}
    rows = range_slices(df.withColumns({held[n]: e.cast("bigint") for n, e in sums.items()}), order)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_slice").agg(*[F.sum(held[n]).alias(held[n]) for n in sums])
    # one row per partition of the range exchange, whatever the size of the table
    starts = totals.select("_slice", *[F.coalesce(F.sum(held[n]).over(earlier), F.lit(0)).alias(f"_start_{n}") for n in sums])
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_in_{n}": F.coalesce(F.sum(held[n]).over(inside), F.lit(0)) for n in sums})
    rows = rows.join(F.broadcast(starts), "_slice")
    return rows.withColumns({n: F.col(f"_start_{n}") + F.col(f"_in_{n}") for n in sums}).drop(
        "_slice", *held.values(), *[f"_start_{n}" for n in sums], *[f"_in_{n}" for n in sums]
    )


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node it reaches.

    Alternates large-star and small-star steps (Kiveris et al., 2014). Rounds grow with the
    logarithm of the graph. A node with very many links is summed by partial aggregates and
    its joins are left to adaptive skew handling. Links stay distributed throughout. A round
    has few shuffles: the driver keeps a thread for each of them for a minute.
    """
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    for _ in range(max_rounds):
        # settled when every node hangs on one other, which itself hangs on none
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
        degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if degrees.filter("up > 1 OR up = 1 AND down = 1").isEmpty():
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("b")).agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = cut_lineage(edges.join(low, "b").select("a", F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
        edges = cut_lineage(small.filter("a <> b").distinct())
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
