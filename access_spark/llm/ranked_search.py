"""Ranked lexical search of all documents for a set of items, sharing work between the items.

Sets of terms that several items share are mined once. A document's partial score of such a
set is computed once and handed on along a graph of sums, whose ends are the items' scores.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes to the same byte, capital letters to small ones, what separates terms to a space.
LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
#: Items of one pass over the documents, and documents whose scores are held at once.
ITEMS, DOCUMENTS = 2_000, 256
#: Candidates that a task holds before it cuts them to the best of each item.
HELD = 1 << 18
#: Place of a null id: behind every other of equal scores.
LAST = (1 << 63) - 1


def terms(text: str | bytes) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters; A to Z are lower-cased."""
    data = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return data.translate(LETTERS).split()


@dataclass
class SharedSums:
    """A graph of sums over leaves. Row i of the table is a leaf for i < len(leaf_terms), else
    the sum of two earlier rows; `levels` holds (rows, left, right) that can be summed together.
    An item is the sum of its `parts`."""

    leaf_terms: list[int]
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    parts: list[np.ndarray]
    rows: int


def shared_sums(items: list[list[int]]) -> SharedSums:
    """Mine pairs that occur together in two or more items, the most frequent first, and make
    each a row of its own; pairs of such rows are mined in the same way.

    A term that an item repeats counts as so many different leaves of the same value.
    """
    leaves: dict[tuple[int, int], int] = {}
    held: list[set[int]] = []
    for item in items:
        seen: Counter = Counter()
        own = set()
        for t in item:
            own.add(leaves.setdefault((t, seen[t]), len(leaves)))
            seen[t] += 1
        held.append(own)
    inside: dict[int, set[int]] = {}
    for i, own in enumerate(held):
        for s in own:
            inside.setdefault(s, set()).add(i)
    pairs: dict[tuple[int, int], int] = Counter(p for own in held for p in itertools.combinations(sorted(own), 2))
    buckets: dict[int, set[tuple[int, int]]] = {}
    for p, n in pairs.items():
        if n > 1:
            buckets.setdefault(n, set()).add(p)

    def change(p: tuple[int, int], by: int) -> None:
        n = pairs.get(p, 0)
        if n > 1:
            buckets[n].discard(p)
        pairs[p] = n + by
        if n + by > 1:
            buckets.setdefault(n + by, set()).add(p)

    sums: list[tuple[int, int]] = []
    top = max(buckets, default=0)
    while top > 1:
        if not buckets.get(top):
            top -= 1
            continue
        a, b = min(buckets[top])
        row = len(leaves) + len(sums)
        sums.append((a, b))
        inside[row] = inside[a] & inside[b]
        for i in inside[row]:
            own = held[i]
            own -= {a, b}
            for s in own:
                change((min(a, s), max(a, s)), -1)
                change((min(b, s), max(b, s)), -1)
                change((s, row), 1)
            change((a, b), -1)
            own.add(row)
        inside[a] = inside[a] - inside[row]
        inside[b] = inside[b] - inside[row]
        # a sum occurs no more often than its parts, so no pair is more frequent than this one
    depth = [0] * (len(leaves) + len(sums))
    by_depth: dict[int, list[tuple[int, int, int]]] = {}
    for k, (a, b) in enumerate(sums):
        row = len(leaves) + k
        depth[row] = 1 + max(depth[a], depth[b])
        by_depth.setdefault(depth[row], []).append((row, a, b))
    levels = [tuple(np.array(c, np.int64) for c in zip(*by_depth[d])) for d in sorted(by_depth)]
    return SharedSums([t for t, _ in leaves], levels, [np.array(sorted(own), np.int64) for own in held], len(depth))


def _counted(held):
    """Documents and terms of all, and documents of each term asked for: rows (term, n).
    Term -1 stands for the documents, -2 for all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {t: i for i, t in enumerate(held.value)}
        found, documents, size = np.zeros(len(wanted), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0):
                own = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                if own:
                    documents += 1
                    size += len(own)
                    found[[wanted[t] for t in set(own) if t in wanted]] += 1
        some = np.flatnonzero(found)
        yield pa.record_batch([np.append(some, [-1, -2]), np.append(found[some], [documents, size])], ["term", "n"])

    return run


class Best:
    """The k highest scores of each item, equal scores by the smaller id."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: items x documents. What lies below an item's k-th score is passed over."""
        item, doc = np.nonzero((scores >= self.floor[:, None]) & (scores > 0))
        self.parts.append((item, scores[item, doc], ids[doc]))
        self.size += len(item)
        if self.size >= HELD:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        item, score, ids = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        start = np.searchsorted(item, np.arange(len(self.floor)))
        rank = np.arange(len(item)) - start[item]
        last = rank == self.k - 1
        self.floor[item[last]] = score[last]
        keep = rank < self.k
        self.parts = [(item[keep], score[keep], ids[keep])]
        self.size = int(keep.sum())
        return self.parts[0]


def _scored(held, k: int):
    """The k best documents of a task for each item: rows (item, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, graph, documents, size = held.value
        wanted = {t: i for i, t in enumerate(words)}
        leaf_terms = np.array(graph.leaf_terms, np.int64)
        best = Best(len(graph.parts), k)

        def score(rows: list[tuple[int, int, list[int], list[int]]]) -> None:
            ids = np.array([r[0] for r in rows], np.int64)
            m = np.array([75 + 25 * r[1] * documents // size for r in rows], np.int64)
            each = [len(r[2]) for r in rows]
            doc = np.repeat(np.arange(len(rows)), each)
            term = np.fromiter(itertools.chain.from_iterable(r[2] for r in rows), np.int64, len(doc))
            tf = np.fromiter(itertools.chain.from_iterable(r[3] for r in rows), np.int64, len(doc))
            own = np.zeros((len(words), len(rows)), np.int64)
            own[term, doc] = weights[term] * ((1_000_000_000 * tf) // (1_000 * tf + 12 * m[doc]))
            sums = np.empty((graph.rows, len(rows)), np.int64)
            sums[: len(leaf_terms)] = own[leaf_terms]
            for row, left, right in graph.levels:
                sums[row] = sums[left] + sums[right]
            best.add(np.stack([sums[p].sum(axis=0) for p in graph.parts]), ids)

        rows = []
        for batch in batches:
            for text, doc_id in zip(batch.column(0), batch.column(1).to_pylist()):
                own = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                found = Counter(own)
                hit = [t for t in found.keys() & wanted.keys()]
                if hit:
                    rows.append((LAST if doc_id is None else doc_id, len(own), [wanted[t] for t in hit], [found[t] for t in hit]))
                    if len(rows) == DOCUMENTS:
                        score(rows)
                        rows = []
        if rows:
            score(rows)
        item, scores, ids = best.cut()
        yield pa.record_batch([pa.array(item), pa.array(ids, mask=ids == LAST), pa.array(scores)], ["item", "doc_id", "score"])

    return run


def _block(spark: SparkSession, docs: DataFrame, items: list, k: int) -> DataFrame:
    """The k best documents of each of a bounded number of items (item_id, text)."""
    asked = [terms(r.text or "") for r in items]
    words = sorted({t for own in asked for t in own})
    numbers = {t: i for i, t in enumerate(words)}
    context = spark.sparkContext
    rows = docs.select(F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"))
    # one row for each term of the items comes back, never one for a document
    counts = rows.select("text").mapInArrow(_counted(context.broadcast(words)), "term long, n long")
    found = {r.term: r.n for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents, size = found.get(-1, 0), max(found.get(-2, 0), 1)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(i, 0) + 1))) for i in range(len(words))], np.int64)
    graph = shared_sums([[numbers[t] for t in own] for own in asked])
    held = context.broadcast((words, weights, graph, documents, size))
    some = rows.mapInArrow(_scored(held, k), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(items)], "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, at_once: int = ITEMS) -> DataFrame:
    """The k documents (doc_id, text) with the highest score above 0 for each row of `items`
    (item_id, text), all if there are fewer: item_id, rank (from 1), doc_id and score.

    A term's weight is floor(1000 * ln((2 N + 2) / (2 df + 1))); N documents have a term, L is
    the sum of their terms, n a document's, m = 75 + 25 n N div L. A score sums weight *
    (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included. Equal scores are
    ranked by doc_id, a null one last. A repeated row of `docs` is a document of its own, a
    repeated row of `items` an item of its own. Null texts and texts without terms find
    nothing and are not found. Other columns are ignored; no rows on either side give none.

    The items are the stated query set: blocks of `at_once` are brought to the tasks, each
    with two passes over all documents. A task returns its k best of each item.
    """
    spark, out = docs.sparkSession, None
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").toLocalIterator()
    while block := list(itertools.islice(rows, at_once)):
        found = _block(spark, docs, block, k)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
