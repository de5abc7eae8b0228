"""Repeated passages against a plain count of all substrings."""

import hashlib
import random

import numpy as np
import pytest

from access_spark.llm import repeats
from tests.llm.helpers import documents, prose


def by_hand(texts, length):
    """(bytes, removed, spans, digest of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p : p + length]] = seen.get(d[p : p + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def made(seed, n=60):
    """Texts with copies, edits, shared passages at various places and runs of one character."""
    rnd = random.Random(seed)
    passages = [prose(900 + i, 30 + 11 * i) for i in range(4)]
    texts = []
    for i in range(n):
        words = prose(i, rnd.randint(5, 160)).split()
        for _ in range(rnd.randint(0, 2)):
            words.insert(rnd.randint(0, len(words)), rnd.choice(passages)[: rnd.choice([80, 150, 199, 200, 201, 320, 900])])
        texts.append(" ".join(words))
    near = prose(7, 150).split()
    for i in range(12):
        near[(i * 37) % 150] = f"edit{i}é"
        texts.append(" ".join(near))
    return texts + ["", None, "a" * 450, "b" * 200, "xy" * 180, "é" * 150, "日本" * 90, texts[0], texts[0], texts[3][:-1], "z" * 199, "z" * 199]


@pytest.mark.parametrize("gram,together", [(64, 20_000), (64, 2), (20, 0), (200, 20_000)])
def test_equals_plain_count(spark, gram, together):
    texts = made(1)
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    out = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(docs, ["doc_id"], gram=gram, together=together).collect()}
    expected = by_hand(texts, 200)
    assert [out[i] for i in range(len(texts))] == expected
    assert sum(e[1] for e in expected) > 5_000 and any(e[2] > 1 for e in expected)


def test_other_lengths(spark):
    texts = made(2, 25)
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    for length, gram, together in [(50, 16, 20_000), (50, 25, 1), (33, 33, 0)]:
        out = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(docs, ["doc_id"], length, gram, together).collect()}
        assert [out[i] for i in range(len(texts))] == by_hand(texts, length)


def test_texts_longer_than_a_chunk(monkeypatch):
    """Cut into chunks, every window still has its gram and stands in one row."""
    rnd = np.random.default_rng(5)
    data = rnd.integers(97, 101, 3_000, dtype=np.uint8)
    hashes = repeats.Hashes(4_000)
    whole = repeats.windows_by_gram(hashes, data, 200, 64)
    grams = np.repeat(whole[0], whole[3])
    for at in range(0, 2_801, 700):
        part = repeats.windows_by_gram(hashes, data[at : at + 700 + 199], 200, 64)
        assert (np.repeat(part[0], part[3]) == grams[at : at + 700]).all()


def test_defined_cases(spark):
    long_text = prose(50, 30_000)
    rows = [(1, long_text, "s"), (None, long_text, None), (None, None, None), (4, "", "s"), (5, "short", "s"), (5, "short", "s")]
    docs = documents(spark, rows, "7 AS n_bytes;8 AS a;9 AS h;1 AS gram;'x' AS row;2 AS copies")
    out = repeats.remove_repeats(docs, texts=True)
    assert out.columns.count("n_bytes") == 1 and {"a", "h", "gram", "row", "copies"} <= set(out.columns)
    got = out.collect()
    assert len(got) == len(rows) and all((r.a, r.h, r.row) == (8, 9, "x") for r in got)
    for r in got:
        if r.n_bytes > 1000:
            assert r.n_removed == r.n_bytes and r.kept == b"" and r.cuts == [0, r.n_bytes]
        else:
            assert r.n_removed == 0 and r.n_spans == 0 and len(r.kept) == r.n_bytes
    assert repeats.remove_repeats(docs.limit(0)).collect() == []
