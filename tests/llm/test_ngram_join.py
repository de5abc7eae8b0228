import random
from collections import defaultdict

from access_spark.llm import ngram_join
from access_spark.llm.common import connected_components
from tests.llm.helpers import documents, prose


def by_hand(rows):
    """Components by counting common shingles of all pairs."""
    sets, lists = {}, defaultdict(list)
    for i, text, _ in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        for s in sets[i]:
            lists[s].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    common = defaultdict(int)
    for own in lists.values():
        for k, a in enumerate(own):
            for b in own[:k]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(text, rnd, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


def check(spark, rows):
    out = ngram_join.jaccard_components(documents(spark, rows, "1 AS key;2 AS n_shingles;3 AS size;4 AS component_id")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == by_hand(rows)
    assert len(out) == len(rows)


def test_small_cases(spark):
    base = prose(1, 80)
    texts = [base, base.upper(), base + " end", " ".join(base.split()[:79]), "a b", "A  B", "a b c", "", None, " \n", "a b c d e", "a b c d e f", base * 200, base * 200 + " x"]
    check(spark, [(i, t, "s") for i, t in enumerate(texts)])


def test_copies_boilerplate_and_chains(spark):
    """A group whose members are not all alike, a passage and a line that many share, short
    documents made of common lines, chains of gradual edits, copies."""
    rnd = random.Random(4)
    texts, base, passage = [], prose(50, 60), prose(51, 40)
    texts += [edited(base, rnd, rnd.randint(0, 3)) for _ in range(160)]
    texts += [f"{prose(100 + i, rnd.randint(20, 90))} {passage} {prose(900 + i, 30)}" for i in range(120)]
    texts += [f"{passage} {prose(2000 + i, rnd.randint(0, 8))}" for i in range(60)]
    texts += [prose(3000 + i % 9, 7) for i in range(90)]
    chain = prose(4000, 70)
    for _ in range(40):
        chain = edited(chain, rnd, 1)
        texts.append(chain)
    texts += [prose(5000, 40)] * 30
    texts += [prose(6000 + i, 50, words=6) for i in range(60)]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    check(spark, [(i, texts[k], "s") for i, k in enumerate(order)])


def test_long_lists_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_LIST", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rnd = random.Random(9)
    base = prose(70, 50)
    texts = [edited(base, rnd, rnd.randint(0, 4)) for _ in range(150)] + [prose(80 + i, 30, words=5) for i in range(60)]
    check(spark, [(i, t, "s") for i, t in enumerate(texts)])


def test_prefixes_of_similar_sets_share_a_signature():
    """Whatever the levels say, sets at the threshold have a common signature."""
    import numpy as np

    rnd = np.random.default_rng(3)
    edges = ngram_join.band_edges(75)
    for _ in range(1500):
        size = int(rnd.integers(1, 120))
        common = rnd.integers(0, 2**63, size, dtype=np.uint64)
        extra = [rnd.integers(0, 2**63, int(rnd.integers(0, 1 + size // 4)), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([common[: size - int(rnd.integers(0, 2))], e])) for e in extra)
        shared = len(np.intersect1d(a, b))
        if not shared or 100 * shared < 75 * (len(a) + len(b) - shared):
            continue
        mode = int(rnd.integers(0, 4))

        def level(x):
            mixed = (x >> np.uint64(7)) % np.uint64(100)
            kinds = [np.zeros(len(x)), np.where(mixed < 50, 200, mixed), np.where(mixed < 30, 200, 201), np.full(len(x), 201)]
            return kinds[mode].astype(np.uint8)

        one, two = (ngram_join.prefix_signatures(x, level(x), 75, edges) for x in (a, b))
        assert np.intersect1d(one[1], two[1]).size, (len(a), len(b), shared, mode)


def test_nulls_repeats_and_no_rows(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).collect() == []
    rows = [(3, "a b c d e f", "s"), (3, "a b c d e f", "s"), (None, "a b c d e f", "s"), (5, "a b c d e f", "s"), (None, None, "s")]
    out = ngram_join.jaccard_components(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == sorted(
        [(3, 2, 3), (3, 2, 3), (5, 2, 3), (None, 2, None), (None, 0, None)], key=str
    )
    kept = ngram_join.one_of_each(documents(spark, rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, None, None]


def test_one_of_each_tells_texts_under_a_repeated_id_apart(spark):
    """The copy goes, the only row of the other text stays; ids never stand for texts."""
    a, b, near = prose(1, 60), prose(2, 60), prose(2, 60).split()
    near[30] = "edit"
    rows = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (5, b, "s"), (7, " ".join(near), "s"), (8, None, "s"), (9, "", "s")]
    docs = documents(spark, rows, "1 AS row;2 AS size;3 AS component_id;4 AS id;5 AS doc")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(1, a), (5, b), (8, ""), (9, "")])


def test_components_of_a_path_that_ends_in_two_stars(spark):
    """After one round 3 and 5 hang on nodes that hang on none, but one of them on two."""
    links = spark.createDataFrame([(5, 1), (5, 4), (4, 3), (3, 2)], "a long, b long")
    assert sorted(map(tuple, connected_components(links).collect())) == [(i, 1) for i in range(1, 6)]
    assert connected_components(links.limit(0)).collect() == []


def test_few_shuffles_where_nothing_is_left_to_compare(spark):
    """The driver keeps a thread for each shuffle, so texts without near copies must not cost the later steps."""
    docs = documents(spark, [(i, prose(i, 40), "s") for i in range(40)])
    jobs = lambda: int(str(spark.sparkContext._jsc.sc().dagScheduler().nextJobId()))
    before = jobs()
    assert len({r.component_id for r in ngram_join.jaccard_components(docs).collect()}) == 40
    assert jobs() - before <= 40
