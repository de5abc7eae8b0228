"""URL filters by a sort-merge range join.

A host is turned round (`blog.example.net` becomes `net.example.blog`) and followed by the
path, so that a rule is an interval of keys: all that start with its own key. Keys of urls and starts of rules are
sorted together and swept: each key looks at the last rule that started, which carries the
stack of rules it is nested in, and takes the innermost one that has not ended. DataFrame
functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from access_spark.llm.common import range_slices

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts after every key that goes on with any character.
END = "\U0010ffff"


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty for null or without it."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"\A([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def url_key(labels: Column, path: Column) -> Column:
    """Reversed host and path; no host has the `/` between them, so a key starts with
    another only if the hosts are equal."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path)


def rule_intervals(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as key intervals, each with the stack it is nested in.

    Equal rules count once, a block before an allow. Intervals of prefixes are either nested
    or apart, so the stack of a rule is itself and the rules whose keys start its key.
    """
    rows = [(v, h.translate(str.maketrans(UPPER, LOWER)), p) for v, h, p in rules]
    df = spark.createDataFrame(rows, "verdict string, host string, path string")
    df = df.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.struct(
        url_key(F.split("host", r"\."), F.col("path")).alias("key"),
        F.concat("host", "path").alias("rule"), F.col("verdict").alias("verdict"),
    )
    held = df.select(rule.alias("r")).select("r.*")
    prefixes = held.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("key")))).select(
        "key", F.substring(F.col("key"), F.lit(1), F.col("_at")).alias("_outer")
    )
    outer = held.select(F.col("key").alias("_outer"), F.struct(F.length("key").alias("depth"), F.col("key").alias("start"), "rule", "verdict").alias("_r"))
    return prefixes.join(outer, "_outer").groupBy("key").agg(F.sort_array(F.collect_list("_r")).alias("stack"))


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of `pages`: key, host, path, rule and verdict.

    A rule (verdict, host, path) fits a url whose host is the rule's or below it and whose
    path starts with the rule's. Of several, the one with the longest text wins (a tie goes
    to the longer host); without any, rule is null and the verdict is `default`. Null urls
    and urls without `://` have empty host and path. Repeated rows and null keys stay, other
    columns are ignored, and an empty table gives none.

    A url has one key for each host it lies below, at most one per label of its host, so that
    its path follows the host of the rule in the key. Keys are dealt into ranges of the
    common order and a host may hold any share of them, because ties are split by page and
    row; ranges start with the rule that started last before them.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    labels = F.split("host", r"\.")
    rows = rows.withColumn("_parts", F.monotonically_increasing_id()).withColumn("_labels", labels)
    below = F.explode(F.sequence(F.lit(1), F.size("_labels")))
    keys = rows.withColumn("_n", below).select(
        key, "host", "path", F.col("_parts").alias("_row"),
        url_key(F.slice("_labels", -F.col("_n"), F.col("_n")), F.col("path")).alias("_key"),
    )
    starts = rule_intervals(spark, rules)
    events = keys.withColumn("_stack", F.lit(None).cast(starts.schema["stack"].dataType)).unionByName(
        starts.select(F.col("key").alias("_key"), F.col("stack").alias("_stack")), allowMissingColumns=True
    )
    # a rule starts before the equal key of a url
    order = [F.col("_key"), F.col("_stack").isNull(), F.col("_row")]
    swept = range_slices(events, order)
    last = swept.filter("_stack IS NOT NULL").groupBy("_slice").agg(F.max_by("_stack", "_key").alias("_last"))
    # one row per partition of the range exchange at most
    slices = swept.select("_slice").distinct().join(last, "_slice", "left")
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    along = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = swept.withColumn("_seen", F.last("_stack", ignorenulls=True).over(along)).filter("_row IS NOT NULL")
    swept = swept.join(F.broadcast(carried), "_slice").withColumn("_open", F.coalesce("_seen", "_carried"))
    active = F.filter("_open", lambda r: F.col("_key") < F.concat(r["start"], F.lit(END)))
    inner = F.try_element_at(active, F.lit(-1))
    best = F.struct(F.length(inner["rule"]), inner["depth"], inner["rule"].alias("rule"), inner["verdict"].alias("verdict"))
    # the keys of one url: at most one per label
    found = swept.groupBy("_row").agg(
        F.first(key).alias(key), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(inner.isNotNull(), best)).alias("_best"),
    )
    return found.select(
        key, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
