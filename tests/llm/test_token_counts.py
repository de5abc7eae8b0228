import itertools

import pytest

from access_spark.llm import token_counts
from access_spark.llm.piece_model import PieceModel, fields, parse
from access_spark.llm.queries import PIECE_MODEL, tokenizer_file
from tests.llm.helpers import documents, prose


def best_by_hand(word, counter):
    """All segmentations of a short word."""
    found = []
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        score = tokens = 0
        for p in parts:
            if p in counter.scores:
                score, tokens = score + counter.scores[p], tokens + 1
            elif len(p) == 1:
                score, tokens = score + counter.unknown, tokens + (len(p.encode()) if counter.by_bytes else 1)
            else:
                break
        else:
            found.append((score, -tokens))
    return -max(found)[1]


def test_shared_prefixes_give_the_best_segmentation():
    pieces = ["<unk>", "a", "b", "ab", "aba", "ba", "bb", "abab", "c", "cab"]
    scores = [0, -3, -3.5, -4, -4.5, -5, -4, -8, -3, -6.5]
    for by_bytes in (False, True):
        counter = token_counts.TrieCounter(PieceModel(pieces, scores, [2] + [1] * 9, byte_fallback=by_bytes))
        words = ["".join(w) for n in range(1, 8) for w in itertools.product("abcé", repeat=n) if hash(w) % 5 == 0 or n < 5]
        counts = counter.count_all(words)
        assert len(counts) == len(words)
        assert all(counts[w] == best_by_hand(w, counter) for w in words)


def test_agrees_with_the_library_read_as_a_unigram_model():
    sentencepiece = pytest.importorskip("sentencepiece")
    data = tokenizer_file(PIECE_MODEL)
    trainer = next(v for n, v in fields(data) if n == 2)
    assert trainer.count(b"\x18\x02", 0, 200) == 1  # the model type, BPE
    library = sentencepiece.SentencePieceProcessor(model_proto=data.replace(trainer, trainer.replace(b"\x18\x02", b"\x18\x01", 1)))
    counter = token_counts.TrieCounter(parse(data))
    words = sorted({w for i in range(20) for w in prose(i, 200).split()} | {"naïve", "日本語", "x" * 40, "Hello,", "don't"})
    counts = counter.count_all(["▁" + w for w in words])
    same = [counts["▁" + w] == len(library.encode(w)) for w in words]
    assert sum(same) >= 0.99 * len(same)  # equal scores may be cut differently


def test_documents(spark):
    model = tokenizer_file(PIECE_MODEL)
    texts = ["one two  two", "", None, "日本語 🤖\n", prose(1, 30_000), "one two  two"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(None, "x", None)], "1 AS n_tokens")
    out = {r.doc_id: (r.n_tokens, r.n_pretokens) for r in token_counts.count_tokens(docs, model).collect()}
    counter = token_counts.TrieCounter(parse(model))
    one = counter.count_all(["▁one", "▁two", "▁▁two"])
    assert out[0] == out[5] == (sum(one.values()), 3)
    assert out[1] == out[2] == (0, 0)
    assert out[4][1] == 30_000 and len(out) == 7
    assert token_counts.count_tokens(docs.limit(0), model).collect() == []
