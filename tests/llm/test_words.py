import numpy as np

from access_spark.llm import words


def test_words_split_on_six_white_bytes_only():
    texts = ["a\tb\nc\x0bd\x0ce\rf g", "x\u00a0y\u3000z", "", None, "  one  "]
    _, firsts = words.word_hashes(texts)
    assert np.diff(firsts).tolist() == [7, 1, 0, 0, 1]


def test_hash_is_of_the_word_alone_and_folds_ascii_capitals():
    long = "w" * 70_000
    many = ["Foo bar"] + ["pad " * 20_000] + ["bar foo", f"foo {long}", f"x x x {long} bar", long * 3, long * 3 + "y"]
    hashes, firsts = words.word_hashes(many)
    first = [hashes[a:b] for a, b in zip(firsts, firsts[1:])]
    assert first[0][0] == first[2][1] and first[0][1] == first[2][0] == first[4][-1]
    assert first[3][1] == first[4][3]
    assert first[5][0] != first[6][0]
    assert words.word_hashes(["É"])[0][0] != words.word_hashes(["é"])[0][0]


def test_shingle_sets():
    sets = words.shingle_sets(["a b c d e f", "A B C D E F", "a b c", "a b c d e f a b c d e f", "", None, "a b c d e"])
    assert [len(s) for s in sets] == [2, 2, 1, 6, 0, 0, 1]
    assert (sets[0] == sets[1]).all()
    assert sets[6][0] in sets[0]
    whole = words.shingle_sets(["q " * 10 + "r"] * 3000)
    assert all((s == whole[0]).all() for s in whole)
