import numpy as np

from access_spark.llm import resampling
from tests.llm.helpers import documents, prose


def test_grams():
    buckets, firsts = resampling.grams(["one two", "", None, "ONE, one one", "..."])
    assert np.diff(firsts).tolist() == [2, 0, 0, 4, 1]
    assert buckets[0, 0] == buckets[4, 0] != buckets[2, 0]  # all capitals is another word
    assert buckets[0, 1] == buckets[2, 1] == 0


def make(n=400):
    rows, marks = [], []
    for i in range(n):
        good = i % 6 != 0
        words = prose(i, 20 + i % 60).split()
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        rows.append((i, text, "s"))
        if i % 2:
            marks.append((i, int(good), 0))
    return rows, marks


def test_good_documents_stay_and_junk_goes(spark):
    rows, marks = make()
    extra = [(None, prose(3, 50), "s"), (5000, None, "s"), (5001, "", "s"), (5002, prose(8, 30_000), "s"), (5003, "A!! B!! " * 5000, "s"), (1, rows[1][1], "s")]
    docs = documents(spark, rows + extra, "1 AS log_weight;2 AS kept;3 AS expected;4 AS noisy_weight")
    labels = spark.createDataFrame(marks + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    out = resampling.resample(docs, labels).collect()
    assert len(out) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in out}
    good = [by_id[i].kept for i in range(400) if i % 6]
    junk = [by_id[i].kept for i in range(400) if i % 6 == 0]
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.05
    assert by_id[5000].log_weight == by_id[5001].log_weight == 0.0
    assert by_id[5002].kept and not by_id[5003].kept
    assert len({r.noisy_weight for r in out if r.doc_id == 1}) == 1
    k = round(sum(r.expected for r in out))
    assert abs(sum(r.kept for r in out) - k) <= 2
    assert min(r.noisy_weight for r in out if r.kept) > max(r.noisy_weight for r in out if not r.kept)
    kept = resampling.kept_documents(docs.repartition(7), labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if r.kept)


def test_weights_are_those_of_the_two_models(spark):
    rows, marks = make(60)
    docs = documents(spark, rows)
    good = {i for i, quality, _ in marks if quality}
    counts = np.zeros((2, resampling.BUCKETS))
    for i, text, _ in rows:
        own = np.bincount(resampling.grams([text])[0].reshape(-1), minlength=resampling.BUCKETS)
        counts[0] += own
        counts[1] += own * (i in good)
    ratio = np.log(counts[1] + resampling.PRIOR) - np.log(counts[0] * counts[1].sum() / counts[0].sum() + resampling.PRIOR)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    for r in resampling.resample(docs, labels).collect():
        assert abs(r.log_weight - ratio[resampling.grams([rows[r.doc_id][1]])[0]].sum()) < 1e-3


def test_every_good_document_counts(spark):
    """More labelled good documents than fit a sample, and few of a group with its own words."""
    from pyspark.sql import functions as F

    rare = F.concat_ws(" ", *[F.concat(F.lit("qx"), (F.col("id") * 7 + k).cast("string")) for k in range(4)])
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4000 == 1, F.repeat(F.concat(rare, F.lit(" ")), 100)).otherwise("a b c").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    out = resampling.resample(docs, labels).agg(F.min("log_weight"), F.max("log_weight"), F.min("kept")).first()
    # the two models are the same
    assert abs(out[0]) < 1e-2 and abs(out[1]) < 1e-2 and out[2]


def test_noise_is_gumbel(spark):
    from pyspark.sql import functions as F

    noise = spark.range(4000).select(resampling._noise(F.col("id"), F.lit("t"), 13).alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(noise[0] - 0.5772) < 0.1 and abs(noise[1] - 1.2825) < 0.1


def test_without_labels_or_rows(spark):
    docs = documents(spark, [(1, "a b c", "s"), (2, None, "s")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in resampling.resample(docs, none).collect()] == [True, True]
    assert resampling.kept_documents(docs, none).count() == 2
    some = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert resampling.resample(docs.limit(0), some).collect() == []
