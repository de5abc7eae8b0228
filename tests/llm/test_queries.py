"""Registered queries on the small tables: against SQL where there is some, else by hand."""

import hashlib
import os
import zlib

import pytest

from check import compare, duck
from access_spark.llm.queries import ORACLES, PIECE_MODEL, QUERIES, tokenizer_file

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name])
    assert ok, message


def test_url_query_is_native(spark):
    plan = QUERIES["op10_url_filters"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_op3(spark):
    out = QUERIES["op3_toxicity"](spark, SF_DIR).collect()
    assert len(out) == table(spark, "documents").count()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op4(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_proto=tokenizer_file(PIECE_MODEL))
    out = {r.doc_id: r for r in QUERIES["op4_sentencepiece"](spark, SF_DIR).collect()}
    for r in table(spark, "documents").collect():
        ids = library.encode(r.text or "") + [library.eos_id()]
        own = out[r.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_op6(spark):
    from tests.llm.test_ngram_join import by_hand

    rows = [(r.doc_id, r.text, r.source) for r in table(spark, "documents").collect()]
    out = QUERIES["op6_ngram_join"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == by_hand(rows)


def test_op5_op7_op1_have_a_row_for_each_input(spark):
    for name, source in (("op5_main_text", "pages"), ("op7_token_counts", "documents"), ("op1_quality", "documents")):
        assert QUERIES[name](spark, SF_DIR).count() == table(spark, source).count()


def test_op2_op8(spark):
    import numpy as np

    from tests.llm.test_vectors import search_by_hand

    rows = table(spark, "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    truth = search_by_hand(ids, x, 20)
    got = {}
    for r in QUERIES["op2_neighbours"](spark, SF_DIR).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {v for v, _ in own}) for q, own in truth.items()) >= 0.9 * 20 * len(truth)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = dict(zip(ids, ((unit @ unit.T) >= 0.9).sum(axis=1) - 1))
    assert {r.vec_id: r.n_links for r in QUERIES["op8_near_vectors"](spark, SF_DIR).collect()} == links


def test_op13(spark):
    from tests.llm.test_repeats import by_hand

    rows = table(spark, "documents").collect()
    out = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_repeats"](spark, SF_DIR).collect()}
    assert [out[r.doc_id] for r in rows] == by_hand([r.text for r in rows], 200)
