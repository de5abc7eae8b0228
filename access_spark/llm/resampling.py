"""Quality by importance resampling with hashed n-gram models.

Two generative models over hashed word n-grams are counted in Spark: one of the target, the
documents labelled good, one of the raw corpus, all documents. The ratio of a text's
likelihoods is its importance weight. Adding Gumbel noise to the log-weights and taking the
k largest draws k documents without replacement in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark.llm.common import sums_before, whole_row
from access_spark.llm.words import hash_spans, mix64, text_groups, word_spans
from access_spark.session import cut_lineage

BUCKETS = 1 << 15
#: Buckets whose counts make one row between tasks.
SEGMENT = 1 << 9
#: Log-ratios are whole multiples of 1 / UNIT.
UNIT = 1 << 20
#: Words of the raw model that the target model of each bucket starts with, as if counted: a
#: bucket that either has seen little of says little.
PRIOR = 200.0

# classes of bytes: 0 white space, 1 letters, digits and bytes of other scripts, 2 the rest
_LETTERS = np.zeros(256, bool)
_LETTERS[48:58] = _LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_REST = ~_LETTERS
_REST[[32, 9, 10, 11, 12, 13]] = False


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every unigram and bigram, first one of each text and the end).

    Words are runs of letters and digits or runs of other signs. A-Z count as a-z, but a word
    all in capitals is another one. All pairs of a word with itself are one bigram.
    """
    data, starts, ends, _ = word_spans(texts, _LETTERS)
    _, other, other_ends, _ = word_spans(texts, _REST)
    capital = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    loud = ((capital[ends] - capital[starts]) == ends - starts) & (ends - starts > 1)
    words = hash_spans(data, starts, ends)
    signs = hash_spans(data, other, other_ends)
    order = np.argsort(np.concatenate([starts, other]), kind="stable")
    hashes = np.concatenate([np.where(loud, words ^ np.uint64(0x5555), words), signs])[order]
    places = np.concatenate([starts, other])[order]
    bounds = np.cumsum([0] + [len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts])
    firsts = np.searchsorted(places, bounds)
    pairs = np.zeros(len(hashes), np.uint64)
    pairs[1:] = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    pairs[1:][hashes[:-1] == hashes[1:]] = 1  # the same word twice, whichever it is
    both = np.stack([mix64(hashes), mix64(pairs)], axis=1)
    both[firsts[:-1][np.diff(firsts) > 0], 1] = 0  # the first word of a text ends no pair
    return (both % np.uint64(BUCKETS)).astype(np.int32), firsts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task: documents of the raw model and those of the target (the second
    column tells which)."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        texts, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        for group in text_groups(texts):
            buckets, firsts = grams(group)
            of_target = np.repeat(np.array(wanted[at : at + len(group)], bool), np.diff(firsts))
            raw += np.bincount(buckets[~of_target].reshape(-1), minlength=BUCKETS)
            target += np.bincount(buckets[of_target].reshape(-1), minlength=BUCKETS)
            at += len(group)
    yield from _segments(raw, target)


def _segments(raw: np.ndarray, target: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The segments that have counts, as rows of lists."""
    rows = [a.reshape(-1, SEGMENT) for a in (raw, target)]
    used = np.flatnonzero((rows[0] + rows[1]).any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(list(a[used]), pa.list_(pa.int64())) for a in rows]], ["segment", "raw", "target"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the segments of a task."""
    sums = np.zeros((2, BUCKETS // SEGMENT, SEGMENT), np.int64)
    for batch in batches:
        for k in (0, 1):
            np.add.at(sums[k], batch.column(0).to_numpy(), batch.column(k + 1).flatten().to_numpy().reshape(-1, SEGMENT))
    yield from _segments(sums[0].reshape(-1), sums[1].reshape(-1))


def log_ratios(docs: DataFrame, good: DataFrame) -> np.ndarray | None:
    """log(target probability / raw probability) of each bucket; None without a target.

    The raw model counts every document, the target every one whose id is in `good` (doc_id).
    For the target, texts meet the ids by a shuffle. The driver gets the counts of each bucket
    once, of which there are BUCKETS.
    """
    # labels grow with the documents, so the plan is the one for large tables at any size
    target = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left_semi")
    parts = docs.select("text", F.lit(False).alias("target")).union(target.select("text", F.lit(True)))
    kinds = "segment int, raw array<long>, target array<long>"
    counts = parts.mapInArrow(_count, kinds).repartition("segment").mapInArrow(_add, kinds)
    table = np.zeros((2, BUCKETS))
    for r in counts.collect():
        table[:, r.segment * SEGMENT : (r.segment + 1) * SEGMENT] = (r.raw, r.target)
    raw, target = table
    if not target.sum():
        return None
    return np.log(target + PRIOR) - np.log(raw * (target.sum() / raw.sum()) + PRIOR)


def _weights(held, text: Column) -> Column:
    """Column of the log-weight: whole multiples of 2**-20 are added, so that a text's sum is
    the same in any batch."""

    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ratios = held.value
        for batch in batches:
            sums = [np.zeros(0, np.int64)]
            for group in text_groups(batch.to_pylist()):
                buckets, firsts = grams(group)
                total = np.concatenate([[0], np.cumsum(ratios[buckets].sum(axis=1))])
                sums.append(total[firsts[1:]] - total[firsts[:-1]])
            yield pa.array(np.concatenate(sums) / UNIT, pa.float64())

    weigh.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(weigh, "double")(text)


def _noise(doc_id: Column, text: Column, seed: int) -> Column:
    """Gumbel noise from a hash."""
    uniform = (F.shiftrightunsigned(F.xxhash64(doc_id, text, F.lit(seed)), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def weights(docs: DataFrame, labels: DataFrame, seed: int) -> list[Column]:
    """Columns log_weight, noisy_weight and expected for rows of `docs`; see `resample`."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
    marks = marks.agg((F.min("quality") > 0).alias("_good"))
    share = marks.agg(F.avg(F.col("_good").cast("double"))).first()[0] or 0.0
    good = marks.filter("_good").select(F.col("_id").alias("doc_id"))
    ratios = log_ratios(docs, good) if share else None
    if ratios is None:
        return [F.lit(0.0).alias("log_weight"), F.lit(0.0).alias("noisy_weight"), F.lit(1.0).alias("expected")]
    held = docs.sparkSession.sparkContext.broadcast(np.round(ratios * UNIT).astype(np.int64))
    weight = _weights(held, F.col("text"))
    expected = F.least(F.lit(1.0), F.lit(share) * F.exp(F.least(weight, F.lit(50.0))))
    noisy = weight + _noise(F.col("doc_id"), F.col("text"), seed)
    return [weight.alias("log_weight"), noisy.alias("noisy_weight"), expected.alias("expected")]


def cut_of(weighted: DataFrame) -> float:
    """The k-th largest noisy weight; infinity if k is 0. `weighted` is narrow."""
    k = round(weighted.agg(F.coalesce(F.sum("expected"), F.lit(0.0))).first()[0])
    ranked = sums_before(weighted, [F.col("noisy_weight").desc(), F.col("doc_id")], {"_rank": F.lit(1)})
    least = ranked.filter(F.col("_rank") < k).agg(F.min("noisy_weight")).first()[0]
    return float("inf") if least is None else least


def resample(docs: DataFrame, labels: DataFrame, seed: int = 13) -> DataFrame:
    """One row per document: doc_id, log_weight, noisy_weight, expected and kept.

    `docs` has doc_id and text, `labels` doc_id and quality (1: good). log_weight is the log
    of the ratio of the two models for the whole text; noisy_weight adds Gumbel noise, a hash
    of the id and the text, so reruns agree. The k documents of largest noisy weight are
    kept, with those that tie with the last. k is the number of good documents that the
    models expect: with the share p of good ones among the labelled, a document is good with
    probability min(1, p * weight) (`expected`), and k is the sum, rounded.

    The raw model counts all documents, the target model all those labelled good.
    Texts that are null, empty or without words weigh 1. Rows with null ids are judged like
    others; null qualities are left out, and of several labels of an id the lower counts.
    Without good labels every document is kept. Repeated rows are judged alike. Other columns
    are ignored. No rows give none.
    """
    weighted = cut_lineage(docs.select("doc_id", *weights(docs, labels, seed)))
    return weighted.withColumn("kept", F.col("noisy_weight") >= cut_of(weighted))


def kept_documents(docs: DataFrame, labels: DataFrame, seed: int = 13) -> DataFrame:
    """The documents that `resample` keeps, with all their columns and no others."""
    columns = weights(docs, labels, seed)
    cut = cut_of(cut_lineage(docs.select("doc_id", *columns)))
    return docs.select(whole_row(docs), columns[1].alias("noisy")).filter(F.col("noisy") >= cut).select("doc.*")
