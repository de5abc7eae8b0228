import numpy as np
import pytest
from pyspark.sql import functions as F

from access_spark.llm import near_vectors, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(int(i) if i is not None else None, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows], SCHEMA)


def bad_rows(dim):
    one = [1.0] * (dim - 1)
    return [(9001, None), (9002, [0.0] * dim), (9003, one + [None]), (9004, one + [float("nan")]), (9005, one + [float("inf")]), (9006, []), (None, one + [1.0]), (9007, one)]


def mixed(n=600, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    for i in range(0, n, 10):  # groups of near copies of all grades
        centre = rng.standard_normal(dim)
        for k in range(rng.integers(2, 9)):
            x[(i + k) % n] = centre + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.2, 0.3])
    x[50:90] = x[50] + rng.standard_normal((40, dim)) * 0.05  # a large group
    x[100:130] = x[100]  # equal vectors
    x[131] = 7 * x[100]
    return x


def components(adjacent):
    root = np.arange(len(adjacent))
    while True:
        new = np.array([min(root[i], root[a].min(initial=root[i])) for i, a in enumerate(adjacent)])
        if (new == root).all():
            return root
        root = new


@pytest.mark.parametrize("block", [1024, 16])
def test_links_of_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    x = mixed()
    ids = np.random.default_rng(1).permutation(len(x)) * 3 + 5
    rows = [*zip(ids, x), *bad_rows(x.shape[1]), (ids[3], x[3])]
    out = near_vectors.near_duplicates(vectors(spark, rows)).collect()
    assert len(out) == len(rows)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in out}
    found = sum(got[i].n_links for i in ids)
    assert all(got[i].n_links <= n for i, n in zip(ids, near.sum(axis=1)))
    assert found >= 0.98 * near.sum()
    if found == near.sum():
        order = np.argsort(ids)
        place = {o: k for k, o in enumerate(order)}
        root = components([np.array([place[b] for b in np.flatnonzero(near[o])], int) for o in order])
        for k, o in enumerate(order):
            assert got[ids[o]].component_id == ids[order[root[k]]]
    for i, _ in bad_rows(24):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id or r.vec_id is None) for r in out)


def test_calibration_and_growth():
    assert near_vectors.projections_for(10) == 256
    assert near_vectors.projections_for(40_000) <= 2.1 * near_vectors.projections_for(10_000)
    listed, least = near_vectors.calibrate(512, 0.9)
    assert least >= 1 and listed >= 8
    assert near_vectors.calibrate(512, 0.6)[0] > listed


def test_no_rows(spark):
    empty = vectors(spark, [])
    assert near_vectors.near_duplicates(empty).collect() == []
    assert neighbours.search(empty, empty["vec_id"] % 2 == 0).collect() == []
    only_bad = vectors(spark, bad_rows(4))
    assert len(near_vectors.near_duplicates(only_bad).collect()) == 8


def search_by_hand(ids, x, top):
    x = x.astype(np.float64)
    found = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = (x * x[i]).sum(axis=1)
        order = [k for k in np.lexsort((ids, -scores)) if ids[k] != ids[i]][:top]
        found[ids[i]] = [(ids[k], scores[k]) for k in order]
    return found


@pytest.mark.parametrize("n,dim,clustered", [(2500, 16, True), (1500, 48, False)])
def test_recall_and_exact_scores(spark, n, dim, clustered):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, dim))
    if clustered:
        x = x * 0.5 + rng.standard_normal((40, dim))[rng.integers(0, 40, n)]
    x = (x * rng.uniform(0.8, 1.2, (n, 1))).astype(np.float32)
    ids = np.arange(n) * 2
    out = neighbours.search(vectors(spark, [*zip(ids, x), *bad_rows(dim), (ids[7], x[7])]), F.col("vec_id") % 20 == 0, 20).collect()
    truth = search_by_hand(ids, x, 20)
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(truth) and all(len(v) == 20 for v in got.values())
    assert all(r.rank >= 1 for r in out)
    hits = sum(len({v for v, _ in truth[q]} & {v for v, _ in got[q]}) for q in truth)
    assert hits >= 0.92 * 20 * len(truth)
    double = dict(zip(ids, x.astype(np.float64)))
    for q, own in got.items():
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)
        assert all(abs(s - double[q] @ double[v]) < 1e-12 for v, s in own)


def test_few_rows_ties_and_blocks(spark, monkeypatch):
    rows = [(i, [1.0, 2.0]) for i in range(1, 70)] + [(80, [1.0, 2.0]), (100, [3.0, 1.0]), (-20, [0.0, -1.0])]
    monkeypatch.setattr(neighbours, "ROW_BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
    out = neighbours.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {-20, 20, 40, 60, 80, 100}
    # 100 ties with the copies at 5.0; the smaller ids come first
    assert got[80] == [*range(1, 21)] and got[1 * 20] == [*range(1, 20), 21]
    few = neighbours.search(vectors(spark, rows[-3:]), F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(-20, 80), (-20, 100), (80, -20), (80, 100), (100, -20), (100, 80)]


def test_balanced_parts():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((512, 8)) + 4 * rng.standard_normal((8, 8))[rng.integers(0, 8, 512)]
    graph = neighbours.neighbour_graph(x)
    part = neighbours.balanced_parts(graph, x, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.max() <= np.ceil(512 / 8 * 1.05) and sizes.min() > 0
    inside = (part[graph] == part[:, None]).mean()
    shuffled = (rng.permutation(part)[graph] == part[:, None]).mean()
    assert inside > 2 * shuffled
