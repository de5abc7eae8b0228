import random
import struct

import pytest

from access_spark.llm import piece_model, pieces
from access_spark.llm.queries import PIECE_MODEL, tokenizer_file
from tests.llm.helpers import documents

sentencepiece = pytest.importorskip("sentencepiece")

TEXTS = [
    "", " ", "  ", "a", "\n\n", "\t x", " a  b   c    d", "日本語 テキスト 🤖🤖 é́", "▁▁ ▁a b▁c", "\x00 zero\x00", "﷽ ㍿", "​ x　y z",
    "a" * 3000, " " * 999 + "x", "\r\n a\r\n", "é" * 50, "<s> </s> <0x41> <unk>", "word " * 20_000,
]


@pytest.fixture(scope="module")
def model():
    return tokenizer_file(PIECE_MODEL)


def test_equals_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = pieces.Codec(model)
    rnd = random.Random(3)
    alphabet = "ab c  d\n\té漢字▁🤖.,!?ABC0123 ́"
    texts = TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    for text in texts:
        ids = library.encode(text)
        own, ends = codec.encode(text)
        assert codec.ids(text, end=False) == ids
        assert codec.decode(ids) == codec.decode_stretches(own) == library.decode(ids)
        assert len(ends) == len(ids) and (not len(ids) or ends[-1] == len(text.encode()))


def test_long_stretches_without_spaces(model):
    """Merged by a heap: equal to the library, and the time does not follow the square."""
    import time

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = pieces.Codec(model)
    rnd = random.Random(11)
    for alphabet in ("abcdefghijklmnop", "aab", "漢字日本語テキスト", "é🤖x", "ABCDEFGH0123456789+/="):
        for size in (61, 200, 3_000):
            text = "".join(rnd.choice(alphabet) for _ in range(size))
            assert codec.ids(text, end=False) == library.encode(text)
            short = codec._merged_scan(text[:60], {})
            assert codec._merged_heap(text[:60], {}) == short
            assert [codec.model.pieces[i] if i < codec.other else None for i in codec._merged_ids(text[:60])] == [s if s in codec.model.ids else None for s in short]
    text = "".join(rnd.choice("thequickbrownfoxes") for _ in range(1_000_000))
    start = time.time()
    own, ends = codec.encode(text)
    assert time.time() - start < 60 and ends[-1] == len(text)
    assert codec.decode_stretches(own) == text


def test_ends_are_those_of_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = pieces.Codec(model)
    for text in ["Hello wörld, ab  cd", "añb c", "x\ny zz"]:
        assert codec.encode(text)[1].tolist() == [p.end for p in library.encode_as_proto(text).pieces]


def _varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _field(number, value):
    return _varint(number << 3 | 2) + _varint(len(value)) + value


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"])
def test_compiled_character_maps(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=True)
    proto = library.serialized_model_proto()
    spec = next(v for n, v in piece_model.fields(proto) if n == 3)
    charmap = dict(piece_model.fields(spec))[2]
    model = piece_model.PieceModel(["<unk>"], [0.0], [2], charmap=charmap, dummy_prefix=True, trim_spaces=True)
    for text in ["ＡＢＣ ①② ﬁn", "  a  b ", "é é Å ﷺ", "Straße İ", "㍿x　y", "ｶﾞｷﾞ", "", " ", "a​b", "\x01a\x7f", "½ x⁵ № 5", "日本 한국"]:
        normal, origin = piece_model.normalise(text, model)
        assert normal == library.normalize(text), text
        assert len(origin) == len(normal) + 1 and origin == sorted(origin)
        assert origin[-1] <= len(text.encode())


def test_alignment_points_to_the_source():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nfkc", remove_extra_whitespaces=True)
    spec = next(v for n, v in piece_model.fields(library.serialized_model_proto()) if n == 3)
    model = piece_model.PieceModel(["<unk>"], [0.0], [2], charmap=dict(piece_model.fields(spec))[2], dummy_prefix=True, trim_spaces=True)
    normal, origin = piece_model.normalise("  ﬁn  ①x ", model)
    assert normal == "▁fin▁1x"
    assert origin == [2, 2, 2, 5, 6, 8, 11, 12]


def test_unigram_style_scores_and_unused_pieces():
    """A small model by hand: merges by score, an unused piece is split again, no bytes."""

    def piece(text, score, kind=1):
        return _field(1, _field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + (b"\x18" + bytes([kind]) if kind != 1 else b""))

    proto = piece("<unk>", 0, 2) + piece("</s>", 0, 3) + piece("▁a", -1) + piece("bc", -2) + piece("▁abc", -3, 5) + piece("▁", -9) + piece("a", -9) + piece("b", -9) + piece("c", -9)
    proto += _field(3, b"\x18\x01\x20\x00")
    codec = pieces.Codec(proto)
    assert [codec.model.pieces[i] for i in codec.ids("abc", end=False)] == ["▁a", "bc"]
    assert codec.ids("abz") == [2, 7, 0, 1]
    assert codec.decode([2, 3, 0]) == "abc ⁇ "


def test_documents(spark, model):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, None, None), (3, "a", "s"), (3, "a", "s")]
    docs = documents(spark, rows, "1 AS n_tokens;2 AS ids;3 AS n_bytes")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = pieces.encode_documents(docs, model, spans=True)
    assert out.columns.count("n_tokens") == 1 and "text" not in out.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, tuple(r.ids), r.n_bytes, r.ends[-1]) for r in out.collect())
    expected = []
    for i, text, _ in rows:
        ids = library.encode(text or "") + [library.eos_id()]
        size = len((text or "").encode())
        expected.append((i if i is not None else -1, len(ids), tuple(ids), size, size))
    assert got == sorted(expected)
    assert pieces.encode_documents(docs.limit(0), model).collect() == []
