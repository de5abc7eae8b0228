"""The interval from vectors of weights against one that copies rows, with groups cut into slices."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd

from access_spark.operators import bootstrap
from access_spark.operators.bootstrap import _summed_places, _weigher, _weights, bootstrap_interval, poisson_borders
from access_spark.operators.keyed import ordered_slices


def by_hand(rows, draws, seed):
    """Interval of (unit, x, y) rows: every draw copies rows and ranks them."""
    borders, found = poisson_borders(), []
    for draw in range(1, draws + 1):
        bits = [int(hashlib.md5("|".join([*([] if u is None else [str(u)]), str(draw), str(seed)]).encode()).hexdigest()[:10], 16) for u, _, _ in rows]
        copies = [sum(b <= v for b in borders) for v in bits]
        x, y = (np.repeat([r[i] for r in rows], copies) for i in (1, 2))
        a, b = pd.Series(x).rank().to_numpy(), pd.Series(y).rank().to_numpy()
        if len(set(x)) > 1 and len(set(y)) > 1:
            found.append(np.corrcoef(a, b)[0, 1])
    return (np.percentile(found, 2.5), np.percentile(found, 97.5)) if found else (None, None)


def test_slices_ties_and_blocks_against_copies(spark):
    rng = np.random.default_rng(3)
    large = [(i, 7.0 if i % 3 == 0 else float(rng.integers(0, 40)), float(rng.integers(0, 25)) + (i % 5)) for i in range(160)]
    small = [(i, float(i % 4), float(-(i % 3))) for i in range(7)] + [(None, 2.0, 5.0), (None, 2.0, 5.0)]
    flat = [(i, 1.0, float(i)) for i in range(6)]
    rows = [(g, None if u is None else f"u{u}", x, y) for g, part in (("large", large), ("small", small), ("flat", flat)) for u, x, y in part]
    ignored = [("small", "n", None, 1.0), ("small", "m", 1.0, math.nan), (None, "k", 1.0, 2.0)]
    df = spark.createDataFrame(rows + ignored, "g string, unit_id string, wealth double, rate double").withColumnRenamed("rate", "poverty")
    draws = 270  # more than one block
    want = {g: by_hand([r[1:] for r in rows if r[0] == g], draws, 9) for g in ("large", "small", "flat")}
    for slice_rows in (20_000, 8):
        out = bootstrap_interval(df, ["g"], "wealth", "poverty", draws, 9, slice_rows).collect()
        got = {r.g: (r.spearman_ci_lo, r.spearman_ci_hi) for r in out}
        assert set(got) == set(want)
        assert got["flat"] == want["flat"] == (None, None)
        assert all(abs(got[g][i] - want[g][i]) < 1e-9 for g in ("large", "small") for i in (0, 1))
    assert bootstrap_interval(df.limit(0), ["g"], "wealth", "poverty", draws).count() == 0


def test_pieces_follow_the_cuts_not_their_square(spark):
    df = spark.range(4000).selectExpr("'g' AS g", "cast(id % 20 AS double) AS v", "xxhash64(id) AS tie")
    cut = ordered_slices(df, ["g"], "v", "tie", 100)
    pieces = cut.groupBy("_slice", "_part").count().collect()
    assert sum(r["count"] for r in pieces) == 4000 and len(pieces) <= 200
    assert max(r["count"] for r in pieces) <= 4000 // 20


def test_hashes_of_many_rows_at_once():
    units = [None, "", "7", "12345", "Ué-9", "x" * 44, "x" * 70, "7"]
    frame = pd.DataFrame({"_unit": units, "_block": [0, 1, 2, 3, 0, 1, 3, 3]})
    borders = poisson_borders()
    for unit, block, w in zip(units, frame["_block"], next(_weigher(990, 42)(iter([frame])))["w"]):
        head = "" if unit is None else f"{unit}|"
        digests = [hashlib.md5(f"{head}{draw}|42".encode()).digest() for draw in range(block * 250 + 1, min(990, block * 250 + 250) + 1)]
        assert list(w) == [sum(b <= int.from_bytes(d[:5], "big") for b in borders) for d in digests]


def test_rows_with_the_same_values_leave_the_hashing_as_one():
    frame = pd.DataFrame({"g": "a", "_block": [0] * 900 + [1] * 700, "_x": 1.0, "_y": [0.0] * 500 + [1.0] * 400 + [0.0] * 699 + [2.0], "_unit": [str(i) for i in range(1600)]})
    apart = next(_weigher(260, 9)(iter([frame])))
    got = next(_summed_places(260, 9, ["g", "_block", "_x", "_y"])(iter([frame])))
    assert got[["_block", "_y"]].to_numpy().tolist() == [[0, 0], [0, 1], [1, 0], [1, 2]]
    for i, (start, end) in enumerate(((0, 500), (500, 900), (900, 1599), (1599, 1600))):
        want = np.stack([np.frombuffer(w, np.uint8) for w in apart["w"][start:end]]).sum(axis=0, dtype=int)
        assert want.max() > 255 or i == 3
        assert _weights(got.iloc[i : i + 1], 260)[0].tolist() == want.tolist()
    both = _weights(got.iloc[2:], 260)
    assert both.shape == (2, 10) and both[1].max() < 10


def test_places_with_many_rows_against_copies(spark, monkeypatch):
    monkeypatch.setattr(bootstrap, "PLACE_ROWS", 100)
    monkeypatch.setattr(bootstrap, "TASK_ROWS", 50)
    rows = [("g", f"u{i}", -0.0 if i % 2 else 0.0, float(i % 3 // 2)) for i in range(600)] + [("g", "v", 1.0, 1.0), ("g", None, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "g string, unit_id string, wealth double, poverty double")
    want = by_hand([r[1:] for r in rows], 20, 9)
    for slice_rows in (20_000, 2):
        got = bootstrap_interval(df, ["g"], "wealth", "poverty", 20, 9, slice_rows).first()
        assert abs(got.spearman_ci_lo - want[0]) < 1e-9 and abs(got.spearman_ci_hi - want[1]) < 1e-9
