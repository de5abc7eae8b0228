import numpy as np
import pyarrow as pa
import pytest

from access_spark.llm import gru, toxicity
from tests.llm.helpers import documents, prose


def test_gradients():
    rng = np.random.default_rng(1)
    steps, rows = 5, 4
    p = {k: v.astype(np.float64) for k, v in gru.initial(6).items()}
    words, heads, tails = rng.integers(0, 7, (steps, rows)), rng.integers(0, 9, (steps, rows)), rng.integers(0, 9, (steps, rows))
    mask = np.ones((steps, rows), bool)
    mask[3:, 0] = False
    labels = np.array([0, 1, 1, 0.0])
    _, g = gru.loss_and_gradients(p, words, heads, tails, mask, labels)
    for name in p:
        flat = p[name].reshape(-1)
        for i in rng.choice(min(flat.size, 60), min(flat.size, 6), replace=False):
            held, step = flat[i], 1e-3
            flat[i] = held + step
            above = gru.loss_and_gradients(p, words, heads, tails, mask, labels)[0]
            flat[i] = held - step
            below = gru.loss_and_gradients(p, words, heads, tails, mask, labels)[0]
            flat[i] = held
            assert abs((above - below) / (2 * step) - g[name].reshape(-1)[i]) < 2e-4, name


def test_windows_cover_every_word():
    firsts = np.array([0, 0, 5, 37, 69 + 17, 300])
    start, text = toxicity.window_places(firsts)
    for t, (a, b) in enumerate(zip(firsts, firsts[1:])):
        own = start[text == t]
        covered = {w for s in own for w in range(s, min(s + toxicity.WINDOW, b))}
        assert covered == set(range(a, b))
        assert all(y - x <= toxicity.STRIDE for x, y in zip(own, own[1:]))


def test_scorer_equals_the_training_pass():
    rng = np.random.default_rng(2)
    p = gru.initial(5)
    words, heads, tails = rng.integers(0, 6, 64), rng.integers(0, 50, 64), rng.integers(0, 50, 64)
    at = np.arange(8)[:, None] + np.array([0, 8, 30])
    logits = gru.Scorer(p).logits(words, heads, tails, at, None)
    mask = np.ones(at.shape, bool)
    loss, _ = gru.loss_and_gradients(p, words[at], heads[at], tails[at], mask, np.ones(3))
    assert abs(loss + np.mean(np.log(gru.sigmoid(logits)))) < 1e-5


@pytest.fixture(scope="module")
def corpus():
    rows, marks = [], []
    for i in range(700):
        words = prose(i, 30 + i % 90).split()
        toxic = i % 5 == 0
        if toxic:
            for k in range(0, len(words), 9):
                words[k] = ("gromble", "SNERK", "vexul" + words[k])[(i // 5 + k) % 3]
        rows.append((i, " ".join(words), "s"))
        if i % 7:
            marks.append((i, 1, int(toxic)))
    return rows, marks


def test_held_out_accuracy_and_defined_cases(spark, corpus):
    rows, marks = corpus
    more = [(2000, None, "s"), (2001, "", "s"), (2002, " .. !", "s"), (None, "gromble gromble", "s"), (2003, prose(5, 20_000) + " gromble snerk gromble " * 3, "s"), (2004, prose(6, 40), "s"), (2004, prose(6, 40), "s")]
    docs = documents(spark, rows + more, "0.5D AS score;9 AS predicted;'x' AS held_out")
    labels = spark.createDataFrame(marks + [(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == len(rows) + len(more)
    by_id = {r.doc_id: r for r in out}
    assert all(by_id[i].score == 0.0 and by_id[i].predicted == 0 for i in (2000, 2001, 2002))
    assert by_id[2003].predicted == 1 and by_id[None].score > 0
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 700]
    assert 100 < len(held) < 250
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert right >= 0.97 * len(held)
    again = {r.doc_id: r.score for r in toxicity.score_documents(docs.repartition(5), labels).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in out)
    clean = toxicity.clean_documents(docs, labels)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in out if not r.predicted)


def test_without_labels_or_rows(spark):
    docs = documents(spark, [(1, "a b c", "s")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.score_documents(docs, none).collect()] == [(0.0, 0)]
    assert toxicity.score_documents(docs.limit(0), none).collect() == []


def test_windows_are_trained_on_in_a_few_arrays():
    """No object for each window: an Arrow table in whatever order gives the same network."""
    rnd = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rnd.integers(0, 30, 80)) + (" vile" if i % 2 else "") for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(40)], pa.int32()), pa.array(range(40), pa.int64())], ["text", "_label", "_doc"])
    rows = pa.Table.from_batches(toxicity._window_rows(iter([batch])))
    one, two = toxicity.fit(rows), toxicity.fit(rows.take(rnd.permutation(len(rows))))
    assert len(one.known) == 31 and all((one.params[k] == two.params[k]).all() for k in one.params)
    assert toxicity.fit(rows.slice(0, 0)) is None
