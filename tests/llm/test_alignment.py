"""Alignment of two tokenizers against a plain walk over their tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from access_spark.llm import alignment
from access_spark.llm.queries import BYTE_MODEL, PIECE_MODEL, tokenizer_file
from tests.llm.helpers import documents, prose

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("tiktoken")

TEXTS = [
    "", None, " ", "a", "  two  spaces ", "Hello, wörld! 日本語 🤖🤖 é́", "▁not given back▁", "\x00 zero", "\n\n\t x\r\n", "<|endoftext|> </s> <unk> <0x41>",
    "a" * 500, " " * 300, "don't we'll 123456 ３４ x=y+1;", "ﬁne ﷽ ㍿", "word " * 3000,
]


def by_hand(texts):
    """Rows as the operator gives them, by the two libraries and a loop over tokens."""
    a_lib = tokenizers.Tokenizer.from_str(tokenizer_file(BYTE_MODEL).decode())
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_proto=tokenizer_file(PIECE_MODEL))
    letters = alignment._letters()
    links, shown = [], []
    for text in texts:
        whole = b" " + (text or "").encode()
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        a_bytes = [bytes(letters[c] for c in a_lib.id_to_token(i)) if i != 50256 else b"" for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            links.append([])
            shown.append((0, 0, 0, ""))
            continue
        own, groups, i, j, s, t = [], [[[], []]], 0, 0, 0, 0
        while i < len(a) and j < len(b):
            own.append((a[i], b[j]))
            s_end, t_end = s + len(a_bytes[i]), t + len(b_bytes[j])
            if s_end <= t_end:
                groups[-1][0].append(a[i])
            if t_end <= s_end:
                groups[-1][1].append(b[j])
            if s_end == t_end:
                groups.append([[], []])
            if s_end <= t_end:
                i, s = i + 1, s_end
            if t_end <= s_end:
                j, t = j + 1, t_end
        groups.pop()
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        links.append(own)
        shown.append((len(a), len(b), len(groups), hashlib.sha256(told.encode()).hexdigest()))
    count = Counter(p for own in links for p in own)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (n_a, n_b, n_groups, len(own), sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own), sha)
        for (n_a, n_b, n_groups, sha), own in zip(shown, links)
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def made():
    rnd = random.Random(8)
    alphabet = "ab c  d\n\té漢字🤖.,!?ABC0123 ́'s"
    return TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 90))) for _ in range(150)] + [prose(i, 80) for i in range(60)] + [prose(1, 80)] * 5


@pytest.mark.parametrize("broadcast", [alignment.BROADCAST_PAIRS, 0])
def test_equals_walk(spark, broadcast, monkeypatch):
    texts = made()
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    out = alignment.align_tokens(docs, tokenizer_file(BYTE_MODEL), tokenizer_file(PIECE_MODEL), ["doc_id"], broadcast_pairs=broadcast)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == by_hand(texts)


def test_spans_give_the_text_back(spark):
    texts = ["Hello, wörld of 日本語", "", "plain words here"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    out = alignment.align_tokens(docs, tokenizer_file(BYTE_MODEL), tokenizer_file(PIECE_MODEL), spans=True)
    assert set(out.columns) == {"doc_id", "lang", "source", "n_chars", *COLUMNS, *alignment.SPANS}
    a, b = alignment.ByteLevel(tokenizer_file(BYTE_MODEL)), alignment.Pieces(tokenizer_file(PIECE_MODEL))
    for r in out.collect():
        whole = (" " + texts[r.doc_id]).encode() if texts[r.doc_id] else b""
        for entries, ids, ends in ((a.entries, r.a_ids, r.a_ends), (b.entries, r.b_ids, r.b_ends)):
            assert b"".join(entries[i] for i in ids) == whole
            assert [len(entries[i]) for i in ids] == np.diff([0, *ends]).tolist()
        assert r.cuts == sorted(set(r.a_ends) & set(r.b_ends)) and len(r.cuts) == r.n_groups


def test_defined_cases(spark):
    rows = [(None, "some text", "s"), (3, "some text", None), (3, "some text", None), (4, None, None)]
    docs = documents(spark, rows, "1 AS n_a;2 AS pairs;3 AS number;4 AS row;5 AS times")
    out = alignment.align_tokens(docs, tokenizer_file(BYTE_MODEL), tokenizer_file(PIECE_MODEL))
    assert out.columns.count("n_a") == 1
    got = out.collect()
    assert len(got) == 4 and all((r.pairs, r.number, r.row, r.times) == (2, 3, 4, 5) for r in got)
    assert len({tuple(r[c] for c in COLUMNS) for r in got if r.doc_id != 4}) == 1
    assert alignment.align_tokens(docs.limit(0), tokenizer_file(BYTE_MODEL), tokenizer_file(PIECE_MODEL)).collect() == []


def test_gallop():
    rnd = np.random.default_rng(2)
    for n, m in [(1, 1), (5, 50), (300, 301), (1000, 40_000), (4096, 5000), (17, 17)]:
        into = np.unique(rnd.integers(0, 10 * m, m))
        ends = np.unique(rnd.integers(0, into[-1] + 1, n))
        assert (alignment.gallop(ends, into) == np.searchsorted(into, ends)).all()
    assert len(alignment.gallop(np.zeros(0, np.int64), np.array([1]))) == 0


def test_other_files_are_refused():
    import json

    spec = json.loads(tokenizer_file(BYTE_MODEL))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        alignment.ByteLevel(json.dumps(spec).encode())
