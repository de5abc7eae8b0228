"""Nearest items: exact on awkward tables, and what a search writes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from access_spark.operators import spatial, travel


def _exact(queries, targets, k):
    want = {}
    for g, q, x, y in queries:
        near = sorted(((x - tx) * (x - tx) + (y - ty) * (y - ty), seq) for h, seq, tx, ty in targets if h == g)
        if near:
            want[(g, q)] = [(seq, d2) for d2, seq in near[:k]]
    return want


def _tables(spark, queries, targets):
    return (
        spark.createDataFrame(queries, "g string, q long, x double, y double"),
        spark.createDataFrame(targets, "g string, seq long, tx double, ty double"),
    )


def _search(spark, queries, targets, k):
    got = {}
    for r in spatial.k_nearest_points(*_tables(spark, queries, targets), k, "g", "q", [], "seq").collect():
        got.setdefault((r.g, r.q), []).append((r["rank"], r.seq, r.d2))
    assert all([rank for rank, *_ in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())
    return {key: [(seq, d2) for _, seq, d2 in sorted(v)] for key, v in got.items()}


def _awkward():
    """A crowded spot, points on a lattice (many equal distances), far queries, a group on one side only."""
    draw = random.Random(3)
    targets = [("a", i, draw.random() * 0.4, 10 + draw.random() * 0.3) for i in range(900)]
    targets += [("a", 900 + i, 0.2, 10.1) for i in range(120)]
    targets += [("b", i, float(i % 20), float(i // 20)) for i in range(400)] + [("c", 1, 0.0, 0.0), ("b", 999, float("nan"), 1.0)]
    queries = [("a", i, i % 10 * 0.04, 10 + i // 10 * 0.5) for i in range(300)] + [("a", 300, 0.2, 10.1)]
    queries += [("b", i, i % 15 * 0.5, i // 15 * 0.5) for i in range(150)] + [("d", 1, 0.0, 0.0), ("b", 999, None, 1.0)]
    return queries, targets


@pytest.mark.parametrize(("k", "wide"), [(1, None), (7, None), (50, None), (7, 100)])
def test_search_is_exact(spark, monkeypatch, k, wide):
    if wide:  # blocks are cut down to single queries
        monkeypatch.setattr(spatial, "WIDE", wide)
        monkeypatch.setattr(spatial, "MATRIX", 500)
    queries, targets = _awkward()
    want = _exact([q for q in queries if q[2] is not None], [t for t in targets if t[2] == t[2]], k)
    assert _search(spark, queries, targets, k) == want


def test_far_queries_write_little(spark, monkeypatch):
    """Many queries far from a crowd: what is written between steps is no more than both tables."""
    written, cut = [], spatial.cut_lineage

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(spatial, "cut_lineage", counted)
    draw = random.Random(5)
    targets = [("a", i, draw.random() * 0.4, 10 + draw.random() * 0.3) for i in range(3000)]
    queries = [("a", i, i % 5 * 0.08, 10 + i // 5 * 0.1) for i in range(2000)]
    found = spatial.k_nearest_points(*_tables(spark, queries, targets), 5, "g", "q", [], "seq")
    assert found.count() == 10_000
    assert sum(written) <= 1.5 * (len(queries) + len(targets))


def test_on_foot_is_the_nearest_of_the_candidates(spark):
    """As `nearest_all_combos` on candidates costed apart."""
    draw = random.Random(7)
    targets = [(g, i, str(i), draw.random() * 0.1, 10 + draw.random() * 0.1) for g in "ab" for i in range(200)]
    cells = [(g, i, i % 10 * 0.02, 10 + i // 10 * 0.02) for g in "ab" for i in range(200)]
    schools = spark.createDataFrame(targets, "g string, school_seq long, school_id string, tx double, ty double")
    grid = spark.createDataFrame(cells, "g string, cell_id long, x double, y double")
    got = travel.nearest_on_foot(grid, schools, 20, "g")
    near = spatial.k_nearest_points(grid, schools, 20, "g", "cell_id", ["school_id"], "school_seq")
    priced = near.join(schools, ["g", "school_id", "school_seq"]).join(grid, ["g", "cell_id"]).withColumn(
        "seconds", travel.walking_seconds(*(F.col(c) for c in ("y", "x", "ty", "tx")))
    )
    want = travel.nearest_school(priced, ["g", "cell_id"])
    rows = lambda df: sorted((r.g, r.cell_id, r.n_schools_in_range, r.nearest_school_id, r.time_to_nearest_min) for r in df.collect())
    assert [r[:4] for r in rows(got)] == [r[:4] for r in rows(want)]
    assert all(a[4] == b[4] or abs(a[4] - b[4]) < 1e-4 for a, b in zip(rows(got), rows(want)))
    assert {r[2] == 0 for r in rows(got)} == {True, False}
