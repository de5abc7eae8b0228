"""Resampled intervals of the rank correlation: draws as vectors of weights along two sorts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from access_spark.functions.numeric import finite
from access_spark.operators.keyed import ordered_slices
from access_spark.session import cut_lineage, parallelism

BLOCK = 250  # draws that a row carries at once: bounds a vector of ranks to 2 KB
SLICE_ROWS = 20_000  # groups up to this size are not cut into slices
HASHED = 64  # rows whose draws are hashed together
TASK_ROWS = 50_000  # rows, once per block, that a task hashes: some seconds
PLACE_ROWS = 10_000  # rows with the same pair of values that stay together
MD5_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)
MD5_TURNS = np.array([t for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in turns * 4], np.uint32)
MD5_ADDS = np.array([int(abs(math.sin(i + 1)) * 2**32) for i in range(64)], np.uint32)
SUMS = ("sw", "sa", "sb", "sab", "saa", "sbb")


def poisson_borders(bits: int = 40) -> list[int]:
    """Borders of the Poisson(1) counts among whole numbers of so many bits: a number has as
    many copies as there are borders at or below it. They go on until the bits cannot tell."""
    borders, cumulative, p, k = [], 0.0, 0.36787944117144233, 0
    while True:
        cumulative += p
        border = round(cumulative * (1 << bits))
        if border >= 1 << bits:
            return borders
        borders.append(border)
        k += 1
        p /= k


def _first_bits(words: np.ndarray) -> np.ndarray:
    """First 40 bits of the md5 of messages of one block each, column by column: their sixteen
    words in `words` (16, n), padding and length included."""
    a, b, c, d = (np.full(words.shape[1], v, np.uint32) for v in MD5_START)
    mixed, held = np.empty_like(a), np.empty_like(a)
    used = words.any(axis=1)  # messages are short: most of their words are zero
    for i, (turn, add) in enumerate(zip(MD5_TURNS, MD5_ADDS)):
        if i < 16:  # d ^ (b & (c ^ d))
            np.bitwise_xor(c, d, out=mixed)
            mixed &= b
            mixed ^= d
            at = i
        elif i < 32:  # c ^ (d & (b ^ c))
            np.bitwise_xor(b, c, out=mixed)
            mixed &= d
            mixed ^= c
            at = (5 * i + 1) % 16
        elif i < 48:  # b ^ c ^ d
            np.bitwise_xor(b, c, out=mixed)
            mixed ^= d
            at = (3 * i + 5) % 16
        else:  # c ^ (b | ~d)
            np.invert(d, out=mixed)
            mixed |= b
            mixed ^= c
            at = 7 * i % 16
        mixed += a
        mixed += add
        if used[at]:
            mixed += words[at]
        np.left_shift(mixed, turn, out=held)
        mixed >>= np.uint32(32) - turn
        mixed |= held
        mixed += b
        a, d, c, b, mixed = d, c, b, mixed, a
    first, fifth = a + MD5_START[0], (b + MD5_START[1]) & np.uint32(255)
    return first.byteswap().astype(np.int64) << 8 | fifth


def _bits(heads: list[bytes], tails: list[bytes]) -> np.ndarray:
    """First 40 bits of the md5 of every head (of one length) with every tail (by rising length)."""
    size, longest = len(heads[0]), len(tails[-1])
    if size + longest > 55:  # more than one block
        digests = b"".join(b"\0\0\0" + hashlib.md5(h + t).digest()[:5] for h in heads for t in tails)
        return np.frombuffer(digests, dtype=">i8").astype(np.int64).reshape(len(heads), len(tails))
    text = np.zeros((len(heads), len(tails), 64), np.uint8)
    text[:, :, :size] = np.frombuffer(b"".join(heads), np.uint8).reshape(len(heads), 1, size)
    ended = b"".join((t + b"\x80").ljust(longest + 1, b"\0") for t in tails)
    text[:, :, size : size + longest + 1] = np.frombuffer(ended, np.uint8).reshape(len(tails), longest + 1)
    length = np.array([8 * (size + len(t)) for t in tails], "<u2")
    text[:, :, 56:58] = length.view(np.uint8).reshape(len(tails), 2)
    by_message, words = text.reshape(-1, 64).view("<u4"), np.zeros((16, len(heads) * len(tails)), np.uint32)
    for i in (*range((size + longest) // 4 + 1), 14):
        words[i] = by_message[:, i]
    return _first_bits(words).reshape(len(heads), len(tails))


def _weigher(draws: int, seed: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Adds `w`, one byte a draw of the row's block: its copies in that draw."""
    borders = np.array(poisson_borders(), dtype=np.int64)

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            heads = [b"" if unit is None else f"{unit}|".encode() for unit in frame["_unit"]]
            alike: dict[tuple[int, int], list[int]] = {}
            for i, (head, block) in enumerate(zip(heads, frame["_block"])):
                alike.setdefault((block, len(head)), []).append(i)
            weights: list[bytes] = [b""] * len(heads)
            for (block, _), rows in alike.items():
                tails = [f"{draw}|{seed}".encode() for draw in range(block * BLOCK + 1, min(draws, (block + 1) * BLOCK) + 1)]
                for k in range(0, len(rows), HASHED):
                    some = rows[k : k + HASHED]
                    bits = _bits([heads[i] for i in some], tails)
                    for i, copies in zip(some, np.searchsorted(borders, bits, side="right").astype(np.uint8)):
                        weights[i] = copies.tobytes()
            yield frame.assign(w=weights).drop(columns="_unit")

    return weigh


def _summed_places(draws: int, seed: int, by: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows that lie together and agree in `by`, a block and both values among them, as one row
    with the sum of their weights, in bytes as wide as it needs."""
    weigh = _weigher(draws, seed)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in weigh(frames):
            if frame.empty:
                continue
            named = frame[list(by)]
            first = np.flatnonzero((named != named.shift()).any(axis=1).to_numpy())
            sums: list[bytes] = []
            block = frame["_block"].to_numpy()
            starts = np.append(first, len(frame))
            turns = np.flatnonzero(np.diff(block[first], prepend=-1))
            for k, end in zip(turns, np.append(turns[1:], len(first))):
                some = frame["w"].iloc[starts[k] : starts[end]]
                weights = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), -1)
                for total in np.add.reduceat(weights, starts[k:end] - starts[k], axis=0, dtype=np.uint32):
                    sums.append(total.astype(np.min_scalar_type(total.max())).tobytes())
            yield frame.iloc[first].assign(w=sums)

    return add


def _weights(part: pd.DataFrame, draws: int) -> np.ndarray:
    """Weights of rows of one block as whole numbers; their bytes tell how wide they are."""
    n = min(draws - int(part["_block"].iloc[0]) * BLOCK, BLOCK)
    widths = part["w"].str.len().to_numpy() // n
    out = np.empty((len(part), n), np.int64)
    for width in np.unique(widths):
        of = widths == width
        out[of] = np.frombuffer(b"".join(part["w"][of]), f"<u{width}").reshape(-1, n)
    return out


def _summed(column: str, draws: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One row of a group with the sum of its vectors, bytes or whole numbers."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = _weights(frame, draws) if column == "w" else np.stack(frame[column].to_numpy())
        return frame.iloc[:1].drop(columns=column).assign(_sums=[vectors.sum(axis=0)])

    return add


def _running(part: pd.DataFrame) -> pd.DataFrame:
    """Per slice of a group, in order, the weight of the slices before it, and its own."""
    part = part.sort_values("_slice", ignore_index=True)
    sums = np.stack(part["_sums"].to_numpy())
    return part.drop(columns="_sums").assign(_before=list(np.cumsum(sums, axis=0) - sums), _own=list(sums))


def _doubled_ranks(rows: pd.DataFrame, value: str, weights: np.ndarray, slices: pd.DataFrame) -> np.ndarray:
    """Twice the rank of each row in each draw; equal values share the middle of their ranks.

    A slice that is one repeated value is marked by an odd number: its rows may lie in
    several parts, and the value's whole weight is that of the slice.
    """
    before, own = slices["_before"].iloc[0], slices["_own"].iloc[0]
    if slices["_slice"].iloc[0] % 2 == 1:
        return np.broadcast_to(2 * before + own + 1, (len(rows), len(own)))
    values, place = np.unique(rows[value].to_numpy(), return_inverse=True)
    order = np.argsort(place, kind="stable")
    per_value = np.add.reduceat(weights[order], np.searchsorted(place[order], np.arange(len(values))), axis=0)
    upto = 2 * (before + np.cumsum(per_value, axis=0)) - per_value + 1
    return upto[place]


def bootstrap_interval(
    df: DataFrame, group: Sequence[str], x: str, y: str, draws: int = 1000, seed: int = 42, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Percentile interval of the Spearman correlation from resampled rows (with `unit_id`).

    Each row's number of copies in a draw is a Poisson(1) count, the large-sample limit of
    drawing with replacement: rows are weighted instead of copied. The uniform number behind
    it is the first 40 bits of the md5 of (row, draw, seed), so any engine can repeat it.

    No row stands for a draw: a row carries a vector of weights per block of draws. Rows of a
    group with the same pair of values, a place, have the same ranks in every draw, so they
    meet in one task and leave it as the sum of their weights; what follows works on places.
    Groups are cut into ordered slices by `x` and by `y`, large ones into several; ranks are
    prefix sums of vectors inside a slice on top of the sums of the slices before it. A place
    is shuffled once for either order, its ranks by `x` beside its weights. Rows whose group is
    null, or with a value that is missing or not finite, take no part; a draw without spread
    has no correlation.
    """
    keys = list(group)
    rows = df.select(*keys, F.col("unit_id").cast("string").alias("_unit"), finite(F.col(x)).alias("_x"), finite(F.col(y)).alias("_y"))
    # a sum with zero has no sign of its own
    rows = rows.filter("_x IS NOT NULL AND _y IS NOT NULL").withColumns({"_x": F.col("_x") + 0.0, "_y": F.col("_y") + 0.0})
    place = [*keys, "_x", "_y"]
    places = cut_lineage(rows.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_tie", F.xxhash64("_x", "_y")))
    sizes = places.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows"))
    largest, held = (v or 0 for v in sizes.agg(F.max("n"), F.sum("rows")).first())
    # pieces follow the places, not the machines: one costs the same whatever it holds
    slices = max(2, math.ceil(largest / slice_rows))
    for value, name in (("_x", "_xs"), ("_y", "_ys")):
        whole = F.col("_group_rows") <= slice_rows
        places = ordered_slices(places, keys, value, "_tie", slices).withColumn(
            name, F.struct(F.when(whole, 0).otherwise(F.col("_slice")).alias("s"), F.when(whole, 0).otherwise(F.col("_part")).alias("p"))
        ).drop("_slice", "_part", "_group_rows")
    places = places.select(
        *place, "_rows", F.col("_xs.s").alias("_xs"), F.col("_xs.p").alias("_xp"), F.col("_ys.s").alias("_ys"), F.col("_ys.p").alias("_yp")
    )
    blocks = F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // BLOCK))).alias("_block")
    # a place with very many rows is several
    share = F.pmod(F.xxhash64("_unit"), F.ceil(F.col("_rows") / PLACE_ROWS)).alias("_share")
    flat = rows.join(places, place).select(*place, "_xs", "_xp", "_ys", "_yp", share, "_unit", blocks)
    types = {f.name: f for f in flat.schema}
    weighted = StructType([f for f in flat.schema if f.name != "_unit"] + [StructField("w", BinaryType())])
    # a block of a row is some hundred hashes but few bytes: tasks follow the rows, not their bytes
    tasks = max(parallelism(df.sparkSession), math.ceil(held * math.ceil(draws / BLOCK) / TASK_ROWS))
    by = [*keys, "_block"]
    apart = [*by, "_x", "_y", "_share"]
    dealt = flat.repartition(tasks, *apart).sortWithinPartitions(*apart)
    rows = cut_lineage(dealt.mapInPandas(_summed_places(draws, seed, apart), weighted))
    vector = ArrayType(LongType())

    def parts_of(slice_name: str, part_name: str) -> DataFrame:
        """Every part of every slice with the weights before its slice and in its slice."""
        names = [*by, "_slice", "_part"]
        placed = rows.select(*by, F.col(slice_name).alias("_slice"), F.col(part_name).alias("_part"), "w")
        fields = [types.get(c) or placed.schema[c] for c in names]
        parts = cut_lineage(placed.groupBy(*names).applyInPandas(_summed("w", draws), StructType([*fields, StructField("_sums", vector)])))
        sums = parts.drop("_part").groupBy(*by, "_slice").applyInPandas(_summed("_sums", draws), StructType([*fields[:-1], StructField("_sums", vector)]))
        running = StructType([*fields[:-1], StructField("_before", vector), StructField("_own", vector)])
        return parts.drop("_sums").join(sums.groupBy(*by).applyInPandas(_running, running), [*by, "_slice"])

    def ranked(part: pd.DataFrame, slices: pd.DataFrame) -> pd.DataFrame:
        if part.empty or slices.empty:
            return pd.DataFrame(columns=rank_fields.names)
        ranks = _doubled_ranks(part, "_x", _weights(part, draws), slices)
        kind = np.uint32 if ranks.max() < 1 << 32 else np.int64
        return part[[*by, "_y", "_ys", "_yp", "w"]].assign(a=[r.astype(kind).tobytes() for r in ranks])

    def products(part: pd.DataFrame, slices: pd.DataFrame) -> pd.DataFrame:
        if part.empty or slices.empty:
            return pd.DataFrame(columns=sum_fields.names)
        weights = _weights(part, draws)
        w = weights.astype(float)
        a = np.stack([np.frombuffer(r, np.uint32 if len(r) == 4 * w.shape[1] else np.int64) for r in part["a"]]) / 2.0
        b = _doubled_ranks(part, "_y", weights, slices) / 2.0
        sums = [v.sum(axis=0) for v in (w, w * a, w * b, w * a * b, w * a * a, w * b * b)]
        return part[by].iloc[:1].assign(**{name: [total] for name, total in zip(SUMS, sums)})

    rank_fields = StructType([*[types[c] for c in (*by, "_y", "_ys", "_yp")], StructField("w", BinaryType()), StructField("a", BinaryType())])
    sum_fields = StructType([*[types[c] for c in by], *[StructField(name, ArrayType(DoubleType())) for name in SUMS]])
    sides = [[*by, "_xs", "_xp"], [*by, "_ys", "_yp"]]
    placed = [parts_of(*side[-2:]) for side in sides]
    names = [*by, "_slice", "_part"]
    with_x = rows.groupBy(*sides[0]).cogroup(placed[0].groupBy(*names)).applyInPandas(ranked, rank_fields)
    totals = with_x.groupBy(*sides[1]).cogroup(placed[1].groupBy(*names)).applyInPandas(products, sum_fields)
    drawn = totals.select(*by, F.posexplode(F.arrays_zip(*SUMS)).alias("draw", "s"))
    sums = drawn.groupBy(*by, "draw").agg(*[F.sum(f"s.{name}").alias(name) for name in SUMS]).filter("sw > 0")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("sw")
    va, vb = F.col("saa") - F.col("sa") * F.col("sa") / F.col("sw"), F.col("sbb") - F.col("sb") * F.col("sb") / F.col("sw")
    rho = F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb))
    return sums.select(*keys, rho.alias("rho")).groupBy(*keys).agg(
        F.percentile("rho", 0.025).alias("spearman_ci_lo"), F.percentile("rho", 0.975).alias("spearman_ci_hi")
    )
