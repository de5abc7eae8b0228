"""Removal of byte passages that occur more than once, by distributed prefix doubling.

Of every window of `length` bytes one position stands for it: that of its smallest hashed
gram. Spark ranks these positions by their grams. Positions whose rank is unique are dropped
with all their windows; those whose windows all agree are settled. Only the others are read
again and ranked at the whole length. Where very many different surroundings share a gram,
Spark sorts (rank, rank further on) pairs of positions at growing offsets and ranks again
until a position is unique or the length is reached.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from access_spark.session import tune

#: Bytes of a first rank. Shorter grams leave fewer positions and more to decide later.
GRAM = 64
#: Surroundings of one gram that one task compares; beyond it pairs are sorted by Spark.
TOGETHER = 20_000
#: Windows whose hashes a task holds at once.
CHUNK = 1 << 20

#: Base of the hashes, its inverse modulo 2^64, and the factors of the last mixing.
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)
MIX, MIX_LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MIX_LAST
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of any substring of a text, from sums over its prefixes modulo 2^64."""

    def __init__(self, most: int) -> None:
        self.letters = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * MIX)
        powers = np.full(most + 1, BASE, np.uint64)
        back = np.full(most + 1, INVERSE, np.uint64)
        powers[0] = back[0] = 1
        self.powers, self.back = np.cumprod(powers, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def of(self, prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((prefixes[end] - prefixes[start]) * self.back[start])


def windows_by_gram(hashes: Hashes, data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(hash of the gram, hash of all bytes, first window, windows) of each run of windows with
    the same smallest gram; of equal grams the leftmost. `data` has `length` bytes at least."""
    sums = hashes.prefixes(data)
    grams = hashes.of(sums, np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1))
    low = np.uint64(CHUNK.bit_length() + 1)
    smallest = grams >> low << low | np.arange(len(grams), dtype=np.uint64)
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:
        smallest = np.minimum(smallest[:-reach], smallest[reach:])
        reach *= 2
    count = len(data) - length + 1
    place = (np.minimum(smallest[:count], smallest[width - reach :][:count]) & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    after = np.append(first[1:], count)
    return grams[place[first]].view(np.int64), hashes.of(sums, first, after + length - 1).view(np.int64), first, after - first


def _bytes_of(column: pa.Array) -> list[np.ndarray]:
    """Every value of a binary column as an array; the bytes are not copied."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [whole[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _ranked(length: int, gram: int):
    """Positions that stand for the windows of distinct texts (a, h, text, copies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(CHUNK + length)

        def handed(rows: list) -> pa.RecordBatch:
            grams, wholes, first, counts = (np.concatenate(c) for c in zip(*(r[2:] for r in rows)))
            each = [len(r[2]) for r in rows]
            a = np.repeat(np.array([r[0] for r in rows], np.int64), each)
            h = np.repeat(np.array([r[1] for r in rows], np.int32), each)
            return pa.record_batch([pa.array(a), pa.array(h), pa.array(first.astype(np.int32)), pa.array(counts.astype(np.int32)), pa.array(grams), pa.array(wholes)], ["a", "h", "first", "n", "gram", "whole"])

        held, size = [], 0
        for batch in batches:
            a, h = batch.column("a").to_pylist(), batch.column("h").to_pylist()
            for i, data in enumerate(_bytes_of(batch.column("text"))):
                for at in range(0, len(data) - length + 1, CHUNK):
                    found = windows_by_gram(hashes, data[at : at + CHUNK + length - 1], length, gram)
                    held.append((a[i], h[i], found[0], found[1], found[2] + at, found[3]))
                    size += len(found[0])
                    if size >= CHUNK >> 4:
                        yield handed(held)
                        held, size = [], 0
        if held:
            yield handed(held)

    return run


def _surroundings(length: int):
    """The bytes of every undecided position: rows of (a, h, text, copies, undecided)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "h", "first", "n", "gram", "many", "bytes"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
        for batch in batches:
            texts = _bytes_of(batch.column("text"))
            columns = [batch.column(c).to_pylist() for c in ("a", "h", "undecided")]
            rows, size = [], 0
            for text, a, h, undecided in zip(texts, *columns):
                for u in undecided:
                    own = text[u["first"] : u["first"] + u["n"] + length - 1].tobytes()
                    rows.append((a, h, u["first"], u["n"], u["gram"], u["many"], own))
                    size += len(own)
                    if size >= 16 << 20:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def _compared(length: int):
    """Repeated windows among rows that come sorted by gram; equal windows share their gram."""

    def repeated(hashes: Hashes, rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.combine_chunks()
        n = rows["n"].to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        found = []
        for data, count in zip(_bytes_of(rows["bytes"].chunk(0)), n.tolist()):
            start = np.arange(count)
            found.append(hashes.of(hashes.prefixes(data), start, start + length))
        found = np.concatenate(found)
        gram, many = rows["gram"].to_numpy()[owner], rows["many"].to_numpy(zero_copy_only=False)[owner]
        order = np.lexsort((found, gram))
        new = np.concatenate([[True], (found[order][1:] != found[order][:-1]) | (gram[order][1:] != gram[order][:-1])])
        name = np.cumsum(new) - 1
        times = np.bincount(name, weights=1 + many[order])
        hit = np.zeros(len(owner), bool)
        hit[order] = times[name] > 1
        hit &= ~many  # windows with more than one copy are settled before
        edge = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (owner[1:] == owner[:-1])]))
        if not len(edge):
            return None
        last = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (owner[1:] == owner[:-1]), [False]]))
        own = owner[edge]
        first = (rows["first"].to_numpy()[own] + inside[edge]).astype(np.int32)
        return pa.record_batch([rows["a"].to_numpy()[own], rows["h"].to_numpy()[own], first, (last - edge + 1).astype(np.int32)], ["a", "h", "first", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(2 * length + 8)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column("gram").to_numpy()
            if held and sum(b.num_rows for b in held) >= 4_000:
                cut = int(np.searchsorted(grams, held[-1].column("gram")[-1].as_py(), "right"))
                done = repeated(hashes, pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, batch = [], batch.slice(cut)
                if done is not None:
                    yield done
            if batch.num_rows:
                held.append(batch)
        if held:
            done = repeated(hashes, pa.Table.from_batches(held))
            if done is not None:
                yield done

    return run


def ranks_by_doubling(rows: DataFrame, length: int) -> DataFrame:
    """(a, h, first, n = 1) of the windows of `rows` whose bytes occur again.

    A rank is the smallest position with the same bytes, so equal ranks are equal bytes.
    Ranks start at an odd part of the length; Spark pairs each with the rank further on, sorts
    the pairs and drops unique ones, whose longer substrings are unique as well.
    """
    start = length
    while start % 2 == 0 and start >= 100:
        start //= 2
    at = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - start))
    ranks = rows.select("a", "h", "first", "many", "bytes", at.alias("i"))
    ranks = ranks.withColumn("bytes", F.substring("bytes", F.col("i") + 1, start))

    def again(pairs: DataFrame, *keys: str) -> DataFrame:
        groups = pairs.groupBy(*keys).agg(F.min(F.struct("a", "h", "first", "i")).alias("new"), F.sum(F.lit(1) + F.col("many").cast("int")).alias("times"))
        return pairs.join(groups.filter("times > 1"), list(keys)).select("a", "h", "first", "many", "i", F.col("new").alias("rank"))

    ranks, size = again(ranks, "bytes"), start
    while size < length:
        # a position has at most one rank `size` further on; its surroundings bound the window
        further = Window.partitionBy("a", "h", "first").orderBy("i").rangeBetween(size, size)
        pairs = ranks.withColumn("next", F.max("rank").over(further)).filter("next IS NOT NULL")
        ranks, size = again(pairs, "rank", "next"), 2 * size
    return ranks.filter("NOT many").select("a", "h", (F.col("first") + F.col("i")).alias("first"), F.lit(1).alias("n"))


def _kept(length: int, texts: bool):
    """What is left of each distinct text: rows of (a, h, text, copies, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, copies, spans in zip(_bytes_of(batch.column("text")), batch.column("copies").to_pylist(), batch.column("spans")):
                size = len(data)
                if copies > 1 and size >= length:
                    cuts = np.array([[0, size]])
                elif spans.is_valid:
                    own = np.sort(spans.values.to_numpy(zero_copy_only=False))
                    first, last = own >> 32, (own >> 32) + (own & 0xFFFFFFFF) + length - 1
                    last = np.maximum.accumulate(last)
                    new = np.concatenate([[True], first[1:] > last[:-1]])
                    cuts = np.stack([first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(own) - 1)]], axis=1)
                else:
                    cuts = np.zeros((0, 2), np.int64)
                sha, at, parts = hashlib.sha256(), 0, []
                for a, b in [*cuts.tolist(), [size, size]]:
                    sha.update(data[at:a])
                    if texts:
                        parts.append(data[at:a].tobytes())
                    at = b
                row = (size, int((cuts[:, 1] - cuts[:, 0]).sum()), len(cuts), sha.hexdigest())
                out.append(row + ((b"".join(parts), cuts.ravel()) if texts else ()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary(), pa.list_(pa.int64())] * texts
            columns = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * len(kinds), kinds)]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "cuts"] * texts
            yield pa.record_batch([batch.column("a"), batch.column("h"), *columns], ["a", "h", *names])

    return run


def remove_repeats(
    docs: DataFrame, keep: list[str] | None = None, length: int = 200, gram: int = GRAM, together: int = TOGETHER, texts: bool = False
) -> DataFrame:
    """The columns `keep` of `docs` (all but text if not given) and n_bytes, n_removed, n_spans
    and kept_sha256 of every whole text as UTF-8 bytes: each byte that a substring of `length`
    bytes covers which starts at another place as well, in this text or any other, is removed.
    With `texts` also kept (the bytes that are left) and cuts (start and end of each removed
    run, one after the other).

    Repeated rows are copies of each other, so all their bytes are removed once they have
    `length`. Null and empty texts have no bytes and keep the digest of none. Other columns
    pass untouched, also null ids, unless they have the name of one that is added, which
    replaces it. No rows give none. Texts count as equal if two hashes of 96 bits together
    are; surroundings of an equal gram if a hash of 64 bits is.
    """
    tune(docs.sparkSession)  # adaptive joins split a gram of very many positions
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "cuts"] * texts
    kept = [c for c in (keep if keep is not None else docs.columns) if c != "text" and c not in added]
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.xxhash64(text).alias("a"), F.hash(text).alias("h"), text.alias("text"))
    distinct = keyed.groupBy("a", "h").agg(F.min("text").cast("binary").alias("text"), F.count(F.lit(1)).alias("copies"))
    # Texts are shuffled once. What is used more than once below asks for the same columns of
    # `distinct` and `places` each time, so that Spark reads the same shuffle again.
    span = "a long, h int, first int, n int"
    places = distinct.mapInArrow(_ranked(length, gram), f"{span}, gram long, whole long")
    places = places.filter("a IS NOT NULL AND h IS NOT NULL AND gram IS NOT NULL AND whole IS NOT NULL")  # always; said for all uses alike

    shared = places.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("whole").alias("low"), F.max("whole").alias("high"))
    repeated = places.join(shared.filter("m > 1").select("gram", "low", "high"), "gram").filter("whole <= high")
    settled = repeated.filter("low = high").select("a", "h", "first", "n")
    open_ = repeated.filter("low < high").select("gram", "whole", F.struct("a", "h", "first", "n").alias("at"))
    classes = open_.groupBy("gram", "whole").agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("least"))
    copies = open_.join(classes.filter("m > 1"), ["gram", "whole"]).filter("least <= at").select("at.*")
    sizes = classes.groupBy("gram").agg((F.count(F.when(F.col("m") > 0, F.col("least"))) > together).alias("hot"))
    undecided = classes.join(sizes, "gram").select("least.a", "least.h", F.struct("least.first", "least.n", "gram", (F.col("m") > 1).alias("many")).alias("u"), "hot")

    def around(rows: DataFrame) -> DataFrame:
        of_text = rows.groupBy("a", "h").agg(F.collect_list("u").alias("undecided"))  # bounded by the text
        return distinct.join(of_text, ["a", "h"]).mapInArrow(_surroundings(length), f"{span}, gram long, many boolean, bytes binary")

    few = around(undecided.filter("NOT hot")).repartition("gram").sortWithinPartitions("gram").mapInArrow(_compared(length), span)
    hot = ranks_by_doubling(around(undecided.filter("hot")), length)
    found = settled.union(copies).union(few).union(hot)
    spans = found.select("a", "h", (F.shiftleft(F.col("first").cast("bigint"), 32) + F.col("n")).alias("s"))
    spans = spans.groupBy("a", "h").agg(F.collect_list("s").alias("spans"))  # bounded by the text

    schema = "a long, h int, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, cuts array<long>" * texts
    left = distinct.join(spans, ["a", "h"], "left").mapInArrow(_kept(length, texts), schema)
    return keyed.select("row", "a", "h").join(left, ["a", "h"]).select("row.*", *added)
