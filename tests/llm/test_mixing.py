import pytest

from access_spark.llm import mixing
from tests.llm.helpers import documents, prose

ROWS = [(i, prose(i, 5 + i % 40), ("a", "b", "c", None)[i % 4]) for i in range(200)] + [
    (900, None, "a"), (901, "", "b"), (902, " \t\n", "c"), (None, "three words here", "a"), (7, prose(7, 12), None), (7, prose(7, 12), None), (903, "w " * 5000, "d"),
]


def by_hand(rows, weights=(5, 2, 1), cap=3):
    """Targets shared in rounds, as the definition says."""
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len((text or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    left, free = float(sum(size.values())), set(order)
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        share = left
        left = 0.0
        for s in sorted(free, key=order.index):
            target[s] += share * weight[s] / total
        for s in list(free):
            if target[s] >= cap * size[s]:
                left += target[s] - cap * size[s]
                target[s] = cap * size[s]
                free.discard(s)
    return size, target


def test_targets_and_takes(spark):
    docs = documents(spark, ROWS, "1 AS size;2 AS target;3 AS taken;'x' AS copies")
    out = mixing.mix_sources(docs).collect()
    size, target = by_hand(ROWS)
    assert len(out) == len(ROWS)
    taken = {}
    for r in out:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        source = next(s for s in target if abs(target[s] - r.target) < 1e-6 * max(1, target[s]) and size[s] == r.source_size)
        taken[source] = taken.get(source, 0) + r.taken
    longest = {s: max(len((t or "").split()) for _, t, own in ROWS if own == s) for s in size}
    for s, goal in target.items():
        # what long documents of one source leave of the budget goes to the others
        assert abs(taken.get(s, 0) - goal) <= longest[s] + goal / sum(target.values()) * sum(longest.values())
    assert sum(taken.values()) <= sum(size.values())
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_documents_of_the_mix(spark):
    docs = documents(spark, ROWS)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {}
    for r in mixing.mix_sources(docs).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + r.copies
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in counts.items() if v}


def test_empty_table_and_empty_texts(spark):
    assert mixing.mix_sources(documents(spark, [])).collect() == []
    out = mixing.mix_sources(documents(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in out) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_weights_are_checked(spark):
    with pytest.raises(ValueError):
        mixing.mix_sources(documents(spark, ROWS[:3]), weights=(1, 0))
