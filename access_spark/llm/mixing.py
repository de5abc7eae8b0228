"""Mixing sources to target weights by weighted fair queueing.

Every document, in a shuffled order of its source, gets a virtual finish time: the words of
the source up to and with it, divided by the target of the source. Sources served in the
order of these times advance together. All copies are sorted by it over the whole corpus,
and the queue is cut where the total budget is spent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark.llm.common import sums_before, whole_row
from access_spark.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _text_key() -> Column:
    parts = ("doc_id", "source", "text")
    return F.struct(F.xxhash64(*parts).alias("a"), F.hash(*parts).alias("b"))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """Targets of the sources (source, source_size) that share the sum of all sizes.

    Sources in code point order, null last, take the weights in turn. No target is above
    `max_repeats` times its source; what a cap leaves goes to the others by weight. The
    sharing ends at a common level L with target = least(cap, L * weight). With the sources
    ordered by cap / weight, L is the first (rest of the budget) / (weights not yet capped)
    that its own source does not cap. Adds `place` (from 0), `words_before` and `target`.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = sums_before(sizes, order, {"place": F.lit(1), "words_before": F.col("source_size")})
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    if min(weights) <= 0 or any(int(w) != w for w in weights):
        raise ValueError("weights are positive whole numbers")
    placed = cut_lineage(placed.withColumns({"_weight": choice, "_cap": F.col("source_size") * max_repeats}))
    total, weight_sum = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0.0))).first()
    by_cap = [F.col("_cap") / F.col("_weight"), F.col("place")]
    seen = sums_before(placed, by_cap, {"_caps_before": F.col("_cap"), "_weights_before": F.col("_weight")})
    level = (F.lit(int(total)) - F.col("_caps_before")) / (F.lit(float(weight_sum)) - F.col("_weights_before"))
    fits = seen.withColumn("_level", level).filter(F.col("_level") <= F.col("_cap") / F.col("_weight"))
    found = fits.agg(F.min_by("_level", F.struct(F.col("_cap") / F.col("_weight"), "place"))).first()[0]
    return placed.withColumn(
        "target", F.least(F.col("_cap").cast("double"), F.lit(float(found or 0.0)) * F.col("_weight"))
    ).drop("_weight", "_cap")


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeats: int = 3, seed: str = "mix"
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and copies.

    `docs` has doc_id, text and source; other columns are ignored. A document enters the
    queue up to `max_repeats` times, each time after all of its source has passed once more.
    Order within a source: md5 of the id and the seed, so reruns agree. Text null or without
    words: size 0, taken 0, queued once. A null source is a source of its own, the last. A
    null doc_id is kept and sorts as an empty string. Repeated rows count as often as they
    occur. No rows: no result. `_text_key` (two hashes of
    id, source and text) finds the rows again.
    """
    rows = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))).alias("_shuffle"),
        _text_key().alias("_text_key"),
    )
    # read the texts once; what follows works on these few narrow columns
    rows = cut_lineage(rows)
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats)
    order = [F.col("source").isNull(), F.col("source"), "_shuffle", "doc_id", "size", "_text_key"]
    queued = sums_before(rows, order, {"_row": F.lit(1), "_before": F.col("size")})
    targets = targets.withColumnRenamed("source", "_source")
    queued = queued.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    last = F.when(F.col("size") > 0, max_repeats - 1).otherwise(0)
    copies = queued.withColumn("_copy", F.explode(F.sequence(F.lit(0), last)))
    passed = F.col("_copy") * F.col("source_size") + F.col("_before") - F.col("words_before") + F.col("size")
    copies = copies.withColumn("_finish", F.coalesce(F.try_divide(passed.cast("double"), F.col("target")), F.lit(0.0)))
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    served = sums_before(
        copies.select("_row", "doc_id", "size", "source_size", "target", "_text_key", "_copy", "_finish", "place"),
        ["_finish", "place", "_row", "_copy"], {"_queue": F.col("size")},
    )
    inside = F.col("_queue") + F.col("size") <= F.lit(int(total))
    return (
        served.groupBy("_row", "doc_id", "size", "source_size", "target", "_text_key")
        .agg(F.sum(F.when(inside, 1).otherwise(0)).alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size")).drop("_row")
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """The documents of the mix, all columns kept, each as often as the mix takes it.

    Rows equal in id, source and text share their copies; if their other columns differ,
    any of them stands for the rest.
    """
    counts = mix_sources(docs, weights, max_repeats).groupBy("_text_key").agg(F.sum("copies").alias("n"))
    one = docs.select(whole_row(docs), _text_key().alias("_text_key")).dropDuplicates(["_text_key"])
    taken = one.join(counts.filter("n > 0"), "_text_key")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("doc.*")
