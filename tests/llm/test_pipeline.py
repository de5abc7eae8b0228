"""The pipeline's stages against what their operators say about the stage's own input."""

import os
import shutil

import pytest

import corpus_pipeline
from access_spark.llm import ngram_join, pieces, resampling, toxicity
from tests.llm.helpers import DOCS, documents, prose

COLUMNS = [c.split()[0] for c in DOCS.split(", ")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of all kinds and their labels, as a folder of tables."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows, marks = [], []
    for i in range(420):
        words = prose(i, 40 + i % 50).split()
        toxic, junk = i % 7 == 0, i % 7 == 1
        if toxic:
            words[::7] = ["gromble"] * len(words[::7])
        text = " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words)
        rows.append((i, text, f"s{i % 3}"))
        if i % 3:
            marks.append((i, int(not junk), int(toxic)))
    for k in range(40):  # copies, one word apart
        words = prose(2, 42).split()
        words[k] = "edit"
        rows.append((1000 + k, " ".join(words), "s0"))
    rows += [(2000, None, "s1"), (2001, "", None), (None, prose(9000, 50), "s2"), (2002, prose(9001, 30_000), None)]
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    inputs = []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    ids = [sorted((str(r.doc_id) for r in d.select("doc_id").collect())) for d in [*inputs, docs]]
    scored = toxicity.score_documents(inputs[0], labels).filter("predicted = 0")
    assert ids[1] == sorted(str(r.doc_id) for r in scored.collect())
    drawn = resampling.resample(inputs[1], labels).filter("kept")
    assert ids[2] == sorted(str(r.doc_id) for r in drawn.collect())
    groups = ngram_join.jaccard_components(inputs[2]).filter("doc_id IS NULL OR doc_id = component_id")
    assert ids[3] == sorted(str(r.doc_id) for r in groups.collect())
    assert sum(int(x) >= 1000 and int(x) < 1040 for x in ids[3] if x != "None") <= 1
    assert set(ids[4]) <= set(ids[3]) and ids[5] == ids[4]
    # toxic and junk documents are gone, clean ones are not
    assert not [x for x in ids[2] if x != "None" and int(x) < 420 and int(x) % 7 < 2]
    assert len([x for x in ids[2] if x != "None" and int(x) < 420]) >= 0.97 * 300


def test_tokens_are_written(spark, tmp_path):
    docs = documents(spark, [(1, "Some words, été 😀", "s"), (2, None, "s"), (None, "", None)])
    corpus_pipeline.tokens_stage(spark, docs, "").write.parquet(f"{tmp_path}/tokens")
    rows = spark.read.parquet(f"{tmp_path}/tokens").collect()
    whole = pieces.encode_documents(docs, corpus_pipeline.tokenizer_file(corpus_pipeline.PIECE_MODEL), keep=["doc_id"], spans=True).collect()
    assert {r.doc_id: (r.ids, r.ends) for r in rows} == {r.doc_id: (r.ids, r.ends) for r in whole}
    assert all(len(r.ids) == len(r.ends) == r.n_tokens and r.ends[-1] == r.n_bytes for r in rows)


def test_stages_keep_columns_of_any_name(spark, folder):
    """Columns named like those that the stages add come out as they went in."""
    names = ["_toxicity", "score", "_noisy", "noisy", "_n", "n", "_k", "_text_key", "doc", "row", "id", "size", "copies", "_copy"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 60").selectExpr("*", *[f"{i} AS {n}" for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert out.select(*names).distinct().collect() == [tuple(range(len(names)))], name


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[0] == "doc_id" and out.count() > 200
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_library_works_without_this_part():
    """The entry module imports in a copy of the whole repository without the deleted folders."""
    import subprocess
    import sys
    import tempfile

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    copy = os.path.join(tempfile.mkdtemp(prefix="entry-"), "repo")
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("llm", "__pycache__", ".git", ".pytest_cache"))
    code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 100 and not [x for x in n if x[:2] == 'op' or x == 'pipeline'] and set(e.oracle_sql()) <= set(n)"
    assert os.path.exists(os.path.join(copy, "corpus_pipeline.py"))
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": copy})


def test_stages_hand_whole_texts_to_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(key)
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    corpus_pipeline.tokens_stage(spark, docs, "unused")
    assert int(spark.conf.get(key)) <= 1000
    spark.conf.unset(key)
