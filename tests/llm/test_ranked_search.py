"""Ranked search against scores computed term by term."""

import math
import random
import re
from collections import Counter

import pytest

from access_spark.llm import ranked_search
from tests.llm.helpers import documents, prose

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def own_terms(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(rows, items, k=20):
    counts = [(i, Counter(own_terms(t)), len(own_terms(t))) for i, t in rows if own_terms(t)]
    n_all, size = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c, n in counts:
            m = 100 - 25 + 25 * n * n_all // size
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in own_terms(text) if c[t])
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0))
        for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, None if none else d, -s))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(4)
    rows = [(i, prose(i, rnd.randint(1, 300), 64)) for i in range(400)]
    rows += [(400 + i, prose(3, 50)) for i in range(40)]  # ties
    rows += [(None, prose(3, 50)), (None, None), (900, ""), (901, " .,;!"), (902, "Ünï-Cödé ＡＢ É9 x_y\x00z"), (902, "ABC abc"), (902, "ABC abc"), (903, "the " * 30_000 + "ünï")]
    items = [(i, prose(1000 + i, 30, 50)) for i in range(30)]
    items += [(30, prose(3, 50)), (31, "ünï  abc ABC abc"), (32, None), (33, ""), (34, "nowhere"), (None, "É9 the the"), (5, "x y z"), (5, "x y z")]
    return rows, items


def frames(spark, rows, items):
    docs = documents(spark, [(i, t, "s") for i, t in rows], "1 AS item_id;2 AS score;3 AS rank")
    return docs, spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, score int")


@pytest.mark.parametrize("at_once", [2_000, 7])
def test_equals_scores_by_hand(spark, tables, at_once):
    rows, items = tables
    docs, asked = frames(spark, rows, items)
    out = ranked_search.search(docs, asked, at_once=at_once)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == by_hand(rows, items)


def test_other_depths_and_small_heaps(spark, tables, monkeypatch):
    rows, items = tables
    docs, asked = frames(spark, rows, items)
    assert sorted((tuple(r) for r in ranked_search.search(docs, asked, k=3).collect()), key=str) == by_hand(rows, items, 3)


def test_empty_tables(spark, tables):
    docs, asked = frames(spark, *tables)
    assert ranked_search.search(docs.limit(0), asked).collect() == []
    assert ranked_search.search(docs, asked.limit(0)).collect() == []


def test_shared_sums_hold_every_item():
    """Each row of the graph unfolds to the leaves of the items, and sums are shared."""
    rnd = random.Random(9)
    items = [[rnd.randint(0, 40) for _ in range(rnd.randint(0, 30))] for _ in range(60)] + [[7, 7, 7, 8]] * 3
    graph = ranked_search.shared_sums(items)
    unfolded = {i: Counter([t]) for i, t in enumerate(graph.leaf_terms)}
    for rows, left, right in graph.levels:
        for r, a, b in zip(rows.tolist(), left.tolist(), right.tolist()):
            unfolded[r] = unfolded[a] + unfolded[b]
    for item, parts in zip(items, graph.parts):
        total = Counter()
        for p in parts.tolist():
            total += unfolded[p]
        assert total == Counter(item)
    adds = sum(len(r) for r, _, _ in graph.levels) + sum(max(0, len(p) - 1) for p in graph.parts)
    assert adds < 0.7 * sum(max(0, len(i) - 1) for i in items)


def test_best_cuts_keep_ties_by_id():
    import numpy as np

    best = ranked_search.Best(2, 3)
    for start in range(0, 40, 8):
        ids = np.arange(start, start + 8)[::-1].copy()
        best.add(np.stack([np.full(8, 5), ids % 4]), ids)
        best.cut()
    item, score, ids = best.cut()
    assert ids[item == 0].tolist() == [0, 1, 2] and ids[item == 1].tolist() == [3, 7, 11]
