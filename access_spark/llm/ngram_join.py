"""N-gram Jaccard join with token-combination prefixes.

The shingles of a document are ordered rare classes first. Two sets of Jaccard similarity t
or more differ in at most s - ceil(t s) of the s shingles of either, so a prefix with one
shingle more must hold a common one. Rare shingles are indexed one by one. Where a prefix
has to reach into frequent classes it is extended, and only combinations of k shingles of
one class are indexed: a class with n shingles in the prefix counts n - k + 1, the number
that must differ before no combination is left. Each candidate pair is verified on the
whole sets.

A shingle's class comes from a table of counts of fixed size, so it may be wrong about a
shingle, but it is the same for every document, which is all that completeness needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from access_spark.llm.common import connected_components, whole_row
from access_spark.llm.words import mix64, shingle_sets
from access_spark.session import cut_lineage

#: Buckets of the count table, as a power of two, and the pieces in which tasks send it.
BUCKET_BITS, CHUNKS = 23, 64
#: Levels below this are those of rare shingles.
RARE = 200
#: Shingles in a very frequent class occur this many times as often as frequent ones must.
VERY_FREQUENT = 16
#: Sets of bands with fewer shingles than this index single shingles only.
LEAST_COMBINED = 16
#: Sets in a list from which on it is compared in blocks, and sets of a block.
HOT_LIST, BLOCK = 32, 512
#: Size of the bit map of documents whose sets are compared, as a power of two.
WANTED_BITS = 26
_MASK = (1 << 64) - 1


def _count_shingles(width: int):
    size = 1 << BUCKET_BITS
    shift = np.uint64(64 - BUCKET_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(size, np.uint32), 0
        for batch in batches:
            sets = shingle_sets(batch.column(0).to_pylist(), width)
            if sets:
                tokens = np.concatenate(sets)
                np.add.at(counts, (tokens >> shift).astype(np.int64), np.uint32(1))
                total += len(tokens)
        if total:
            pieces = [zlib.compress(c.tobytes(), 1) for c in np.minimum(counts, 65535).astype(np.uint16).reshape(CHUNKS, -1)]
            sums = [total] + [0] * (CHUNKS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array(sums, pa.int64()), pa.array(pieces, pa.binary())], ["chunk", "total", "counts"])

    return run


def _levels(mean: float):
    limit, unit = mean + 4 * mean**0.5 + 8, (mean**0.5 + 1) / 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(piece), np.uint16)
                sums[chunk] = sums[chunk] + part if chunk in sums else part.astype(np.int64)
        for chunk, counts in sums.items():
            level = np.clip((counts - mean) / unit + 80, 0, RARE - 1)
            level = np.where(counts > limit, np.where(counts > VERY_FREQUENT * limit, RARE + 1, RARE), level)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([level.astype(np.uint8).tobytes()], pa.binary())], ["chunk", "levels"])

    return run


def token_levels(docs: DataFrame, width: int = 5) -> np.ndarray:
    """Level of each bucket of shingle hashes: how often its shingles occur, rarest first.

    Levels below RARE are one class, RARE is the frequent and RARE + 1 the very frequent one.
    A bucket is frequent that counts clearly more occurrences than chance puts there. All
    documents are counted. Tasks send their part of a table of 2**23 counts, compressed;
    the driver gets one byte per bucket, whatever the number of documents.
    """
    counted = cut_lineage(docs.select("text").mapInArrow(_count_shingles(width), "chunk int, total long, counts binary"))
    total = counted.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    merged = counted.select("chunk", "counts").repartition(CHUNKS, "chunk")
    levels = np.zeros((CHUNKS, (1 << BUCKET_BITS) // CHUNKS), np.uint8)
    for row in merged.mapInArrow(_levels(total / (1 << BUCKET_BITS)), "chunk int, levels binary").collect():
        levels[row.chunk] = np.frombuffer(row.levels, np.uint8)
    return levels.reshape(-1)


def band_edges(percent: int, most: int = 1 << 40) -> np.ndarray:
    """Smallest set size of each band; sizes of two sets that can link lie in the same band
    or in neighbouring ones."""
    edges, at, step = [1], Fraction(1), Fraction(100, percent)
    while edges[-1] < most:
        at *= step
        edges.append(-(-at.numerator // at.denominator))
    return np.array(edges, np.int64)


def combined_prefix(rest: np.ndarray, classes: np.ndarray, need: int, band: int, least: int) -> list[int]:
    """Signatures of frequent shingles, in prefix order, that count `need` or more.

    `least` is the smallest size of a set that is compared within the band; it sets how many
    groups a class is dealt into, so that a group holds a few shingles of the prefix. Groups
    that hold too few to count cost at most least / 4 and 2 least / 6 of at least `least`
    shingles, which leaves more than a prefix has to count.
    """
    small = least < LEAST_COMBINED
    groups: dict[tuple[int, int], list[int]] = {}
    for token, kind in zip(rest.tolist(), classes.tolist()):
        k = 1 if small else kind + 1
        members = groups.setdefault((k, token % max(1, least // (2 + 2 * kind))), [])
        members.append(token)
        need -= len(members) >= k
        if need <= 0:
            break
    found = []
    for (k, _), members in groups.items():
        for chosen in combinations(members, k):
            value = band + 1
            for token in chosen:
                value = (value * 0x9E3779B97F4A7C15 + token) & _MASK
            found.append(value)
    return found


def prefix_signatures(tokens: np.ndarray, levels: np.ndarray, percent: int, edges: np.ndarray) -> tuple[bool, np.ndarray]:
    """(whether rare shingles alone fill the prefix, signatures) of a sorted set of shingles."""
    size = len(tokens)
    need = size - (percent * size + 99) // 100 + 1
    order = np.argsort(levels, kind="stable")  # by level, then by shingle
    rare = int((levels < RARE).sum())
    if rare >= need:
        return True, tokens[order[:need]]
    rest = order[rare:]
    band = int(np.searchsorted(edges, size, side="right")) - 1
    found: list[int] = []
    for b in (band, band + 1):
        found += combined_prefix(tokens[rest], levels[rest] - (RARE - 1), need - rare, b, int(edges[max(0, b - 1)]))
    return False, np.concatenate([tokens[order[:rare]], mix64(np.array(found, np.uint64))])


def set_key(tokens: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    return int(mix64(np.array([mix64(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _longs(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.uint64).view(np.int64)))


def _sign(width: int, percent: int, held):
    edges = band_edges(percent)
    shift = np.uint64(64 - BUCKET_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(held.value), np.uint8)
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            levels = [table[(s >> shift).astype(np.int64)] for s in sets]
            signed = [prefix_signatures(s, x, percent, edges) if len(s) else (True, s) for s, x in zip(sets, levels)]
            keys = [set_key(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
                 pa.array([x for x, _ in signed], pa.bool_()), _longs([x for _, x in signed])],
                ["doc_id", "n_shingles", "key", "simple", "signatures"],
            )

    return run


def _sets(width: int, held):
    """Sets of the documents whose id may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1))
            sets = [s for s in shingle_sets(batch.column(1).to_pylist(), width) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), _longs(sets)], ["key", "tokens"])

    return run


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << WANTED_BITS))


def wanted_sets(docs: DataFrame, ids: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """(key, tokens) of the sets named by `keys`, read from the texts once more.

    A bit map of fixed size, 8 MB, tells tasks which documents to look at, so that texts are
    not shuffled. It may let others pass; the join on the key drops those.
    """
    named = keys.join(ids, "key").select(_slot(F.col("doc_id")).alias("slot"))
    words = named.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("bits")).toArrow()
    bits = np.zeros(1 << (WANTED_BITS - 6), np.uint64)
    bits[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    held = docs.sparkSession.sparkContext.broadcast(bits)
    rows = docs.filter("doc_id IS NOT NULL").select(_slot(F.col("doc_id").cast("bigint")), "text")
    sets = rows.mapInArrow(_sets(width, held), "key long, tokens array<long>")
    return cut_lineage(sets.join(keys, "key", "left_semi").dropDuplicates(["key"]))


def verified(docs: DataFrame, ids: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set keys whose Jaccard similarity is percent / 100 or more."""
    pairs = cut_lineage(pairs)
    sets = wanted_sets(docs, ids, pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), width)
    one, two = (sets.select(F.col("key").alias(k), F.col("tokens").alias(f"{k}_tokens")) for k in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    union = F.size("a_tokens") + F.size("b_tokens") - F.col("_common")
    both = both.withColumn("_common", common).filter(F.col("_common") * 100 >= union * percent)
    return cut_lineage(both.select("a", "b"))


def _need(size: Column, percent: int) -> Column:
    return size - F.floor((size * percent + 99) / 100).cast("bigint") + 1


def possible(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, a_size, b_size) with their number of common signatures, `shared`,
    those that can reach the threshold.

    Sizes are doubled, plus 1 where the prefix has rare shingles alone. For two of these,
    common shingles are those counted and at most what lies behind the shorter prefix.
    """
    a, b = F.floor(F.col("a_size") / 2), F.floor(F.col("b_size") / 2)
    overlap = F.ceil((a + b) * percent / (100 + percent))
    bound = overlap - F.greatest(a - _need(a, percent), b - _need(b, percent))
    simple = (F.col("a_size") % 2 == 1) & (F.col("b_size") % 2 == 1)
    alike = F.least(a, b) * 100 >= F.greatest(a, b) * percent
    return pairs.filter(alike & (~simple | (F.col("shared") >= bound))).select("a", "b")


def _compare_sets(percent: int):
    """A few links that join the linked sets of a unit, one block or two."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        keys, block = table["key"].to_numpy(), table["block"].to_numpy()
        root = np.unique(table["root"].to_numpy(), return_inverse=True)[1]
        lists = table["tokens"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        names, place, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        rows, n = np.repeat(np.arange(len(keys)), sizes), len(keys)
        column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[place]
        common = np.zeros((n, n), np.float32)
        for at in range(0, int(column.max(initial=-1)) + 1, 4096):
            inside = (column >= at) & (column < at + 4096)
            marks = np.zeros((n, 4096), np.float32)
            marks[rows[inside], column[inside] - at] = 1
            common += marks @ marks.T
        alike = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        if low != high:
            alike &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(alike & (root[:, None] != root[None, :]), 1))
        found: list[tuple[int, int]] = []
        for x, y in zip(a.tolist(), b.tolist()):
            if root[x] != root[y]:
                found.append((keys[x], keys[y]))
                root[root == root[y]] = root[x]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def block_links(docs: DataFrame, ids: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links that join the components of all similar sets which share a list of `rows`.

    The lists of one first set are one group: two sets that share a list are in the group of
    its first. A group is dealt into blocks by a hash, and every two blocks are compared in
    one task, on the whole sets; equal roots are joined already and passed over.
    """
    group = rows.select("pivot", "key", "root").union(rows.select("pivot", F.col("pivot").alias("key"), F.col("pivot_root").alias("root")))
    group = cut_lineage(group.distinct())
    blocks = group.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = group.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = placed.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    sets = wanted_sets(docs, ids, group.select("key").distinct(), width)
    units = units.join(sets, "key").select("pivot", "low", "high", "key", "block", "root", "tokens")
    return cut_lineage(units.groupBy("pivot", "low", "high").applyInArrow(_compare_sets(percent), "a long, b long"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles and component_id.

    Two documents link when 100 * intersection >= percent * union of their sets of
    `width`-word shingles; component_id is the smallest doc_id reachable by links. Texts that
    are null, empty or without words have no shingles and link with nothing; texts of fewer
    than `width` words are one shingle. Rows with a null doc_id keep their count, link with
    nothing and get a null component. Repeated rows give repeated rows. Equal sets are one
    node. Other columns are ignored; no rows give none.

    Candidates are found in two steps, and no step emits all pairs of a group. First every
    set in the list of a signature is paired with the first of the list. Copies of one text,
    however many, are mostly joined then. What is left are lists with sets of different
    components. In short lists pairs across components are counted; pairs of long lists are
    compared in blocks, where tasks keep the pairs to themselves. A pair that shares a long
    list need not be counted, so a bound on the number of common signatures holds for the
    others: it drops those that cannot reach the threshold. All that stay are verified on the
    whole sets.
    """
    levels = token_levels(docs, width)
    held = docs.sparkSession.sparkContext.broadcast(zlib.compress(levels.tobytes(), 1))  # a byte per bucket: 8 MB at most
    schema = "doc_id long, n_shingles long, key long, simple boolean, signatures array<long>"
    signed = cut_lineage(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_sign(width, percent, held), schema))
    named = signed.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    ids = cut_lineage(named.groupBy("key").agg(F.min("doc_id").alias("doc_id")))
    sets = named.groupBy("key").agg(F.first(F.col("n_shingles") * 2 + F.col("simple").cast("int")).alias("size"), F.first("signatures").alias("signatures"))
    listed = sets.select("key", "size", F.explode("signatures").alias("sig"))
    # a frame that only grows: Spark passes over the rows of a list and holds none of them
    along = Window.partitionBy("sig").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first(F.struct(F.col("key").alias("pivot"), F.col("size").alias("pivot_size"))).over(along)
    stars = cut_lineage(listed.withColumn("_p", first).select("sig", "key", "size", "_p.*").filter("key <> pivot"))

    counted = stars.groupBy(F.col("key").alias("a"), F.col("pivot").alias("b"), F.col("size").alias("a_size"), F.col("pivot_size").alias("b_size"))
    tried = possible(counted.agg(F.count(F.lit(1)).alias("shared")), percent)
    links = verified(docs, ids, tried, width, percent)
    groups = cut_lineage(connected_components(links))

    mine, theirs = groups.select(F.col("node").alias("key"), "root"), groups.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    rooted = stars.join(mine, "key", "left").join(theirs, "pivot", "left").withColumns(
        {"root": F.coalesce("root", "key"), "pivot_root": F.coalesce("pivot_root", "pivot")}
    )
    apart = F.max(F.col("root") != F.col("pivot_root")).alias("apart")
    lengths = rooted.groupBy("sig").agg((F.count(F.lit(1)) + 1).alias("length"), apart).filter("apart").select("sig", "length")
    rooted = cut_lineage(rooted.join(lengths, "sig"))
    short, hot = rooted.filter(F.col("length") <= HOT_LIST), rooted.filter(F.col("length") > HOT_LIST)

    found = []
    if not short.isEmpty():
        members = short.select("sig", "key", "size", "root").union(short.select("sig", "pivot", "pivot_size", "pivot_root").distinct())
        left, right = (members.select("sig", F.col("key").alias(k), F.col("size").alias(f"{k}_size"), F.col("root").alias(f"{k}_root")) for k in "ab")
        across = left.join(right, "sig").filter((F.col("a") > F.col("b")) & (F.col("a_root") != F.col("b_root")))
        shared = across.groupBy("a", "b", "a_size", "b_size").agg(F.count(F.lit(1)).alias("shared"))
        found.append(verified(docs, ids, possible(shared, percent), width, percent))
    if not hot.isEmpty():
        found.append(block_links(docs, ids, hot, width, percent))
    if found:
        groups = connected_components(reduce(DataFrame.union, found, links))

    nodes = cut_lineage(ids.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")))
    smallest = nodes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labelled = nodes.join(smallest, "root").select("key", "component_id")
    out = signed.select("doc_id", "n_shingles", "key").join(labelled, "key", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """One row of every component of similar texts, the one with the smallest doc_id, all
    columns as they were.

    Components are those of rows, so texts under a repeated doc_id are told apart. Of rows
    that have the same id and text one stays. Rows with a null doc_id, and rows whose text
    has no words and so links with nothing, stay.
    """
    row = F.xxhash64("doc_id", "text").alias("row")
    named = docs.filter("doc_id IS NOT NULL")
    groups = jaccard_components(named.select(row.alias("doc_id"), "text"), width, percent).select(F.col("doc_id").alias("row"), "component_id").distinct()
    ids = named.select(row, F.col("doc_id").cast("bigint").alias("id")).distinct().join(groups, "row")
    first = ids.groupBy("component_id").agg(F.min(F.struct("id", "row")).alias("first")).select("first.row").distinct()
    # the id, the length and a second hash beside the first: rows that differ are not taken for copies
    keyed = named.select(whole_row(docs), row, F.col("doc_id").alias("id"), F.octet_length("text").alias("size"), F.hash("text").alias("check"))
    kept = keyed.join(first, "row", "left_semi").dropDuplicates(["row", "id", "size", "check"]).select("doc.*")
    return kept.union(docs.filter("doc_id IS NULL"))
