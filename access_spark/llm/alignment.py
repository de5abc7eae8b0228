"""Alignment of two tokenizers over the same bytes.

The ends of the tokens of both are sorted lists of byte offsets. The shorter list drives an
exponential and then binary search into the longer; ends that both have cut groups, and the
differences of neighbouring ranks are the ranges of overlapping tokens. How often two ids
overlap is counted over all documents and brought back to the documents.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_spark.llm.piece_model import BYTE, SPACE, parse
from access_spark.session import cut_lineage, shared_dir

#: Bytes of text whose tokens a task aligns at once; a longer text stands alone.
TOGETHER = 1 << 20
#: Pairs of ids with their counts that may be broadcast; more are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
#: Driving ends that are searched first, each from the one before it; the others follow.
STRIDE = 16


class ByteLevel:
    """Encoder of a byte-level BPE file (JSON), special tokens read as plain text.

    `tiktoken` encodes it three times as fast as the library that the format comes from. The
    two agree if ids follow the order of the merges and the file splits words by the usual
    pattern without normalising, which is checked here; other files are refused.
    """

    # fixed value: the pattern of byte-level pre-tokenizers with use_regex
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, data: bytes) -> None:
        import tiktoken

        spec = json.loads(data)
        own, split = spec["model"], spec["pre_tokenizer"]
        plain = split["type"] == "ByteLevel" and not split["add_prefix_space"] and split.get("use_regex", True)
        if not plain or spec["normalizer"] or own.get("dropout") or own.get("ignore_merges"):
            raise ValueError("not a plain byte-level model")
        letters, special = _letters(), {t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in own["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for i, t in names.items() if i not in special}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in own["merges"]]
        if [own["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("ids do not follow the merges")
        self.codec = tiktoken.Encoding("aligned", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        back = {i: b for b, i in ranks.items()}
        self.entries = [back.get(i, names[i].encode() if i in names else b"") for i in range(max(names) + 1)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.codec.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """Encoder of a sentencepiece model file, which adds the leading space itself."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self.codec = sentencepiece.SentencePieceProcessor(model_proto=data)
        model = parse(data)
        self.entries = [
            bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() for p, k in zip(model.pieces, model.kinds)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.codec.encode(texts, num_threads=1)


def _letters() -> dict[str, int]:
    """Characters that stand for bytes in the file: printable ones for themselves, the others
    for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    return out | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}


def gallop(ends: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Index of the first of `into` that is not below each of `ends`.

    Both ascend and the last of `into` is not below the last of `ends`. Every STRIDE-th end
    of a level is searched from the one found before it; all searches of a level step together.
    """
    found = np.zeros(len(ends), np.int64)
    stride = STRIDE ** max(0, int(np.log(max(len(ends), 1)) // np.log(STRIDE)))
    done = 0  # ends at multiples of this are found
    while stride >= 1:
        at = np.arange(0, len(ends), stride)
        if done:
            at = at[at % done != 0]
        low = found[at // done * done] - 1 if done else np.full(len(at), -1)
        high, reach = np.minimum(low + 1, len(into) - 1), 1
        open_ = np.arange(len(at))
        while len(open_):  # steps of 1, 2, 4, ... while the end lies further on
            open_ = open_[into[high[open_]] < ends[at[open_]]]
            low[open_] = high[open_]
            reach *= 2
            high[open_] = np.minimum(low[open_] + reach, len(into) - 1)
        while len(open_ := np.flatnonzero(high - low > 1)):
            middle = (low[open_] + high[open_]) >> 1
            less = into[middle] < ends[at[open_]]
            low[open_[less]] = middle[less]
            high[open_[~less]] = middle[~less]
        found[at] = high
        done, stride = stride, stride // STRIDE
    return found


class Aligner:
    def __init__(self, a, b) -> None:
        self.a, self.b = a, b
        self.lengths = [np.array([len(e) for e in t.entries], np.int64) for t in (a, b)]
        # decimals of each id with what follows it: A "," A "|" B "," B ";"
        texts = [f"{i}{s}".encode() for t, signs in ((a, ",|"), (b, ",;")) for s in signs for i in range(len(t.entries))]
        self.widths = np.array([len(t) for t in texts], np.int64)
        self.decimals = np.zeros((len(texts), int(self.widths.max())), np.uint8)
        for i, t in enumerate(texts):
            self.decimals[i, : len(t)] = np.frombuffer(t, np.uint8)

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        out = []
        for text, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts)):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            same = text and all(b"".join(map(t.entries.__getitem__, ids)) == whole for t, ids in ((self.a, a), (self.b, b)))
            out.append((a, b) if same else ([], []))
        return out

    def align(self, texts: list[str]) -> dict[str, list]:
        """Columns of a run of texts; offsets count from the leading space."""
        ids = self.tokens(texts)
        n = np.array([[len(a), len(b)] for a, b in ids], np.int64).reshape(-1, 2)
        a, b = (np.fromiter((i for own in ids for i in own[k]), np.int64, int(n[:, k].sum())) for k in (0, 1))
        ends = [np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])]
        flip = len(b) < len(a)
        short, long = (ends[1], ends[0]) if flip else (ends[0], ends[1])
        rank = gallop(short, long)
        common = long[rank] == short if len(long) else np.zeros(0, bool)
        of_doc = [np.repeat(np.arange(len(texts)), n[:, k]) for k in (0, 1)]
        own_doc = of_doc[int(flip)]
        cut = rank[common]
        groups = np.bincount(own_doc[common], minlength=len(texts))

        # a token overlaps those from the first that ends behind its start to the first that does not end before it
        before = np.concatenate([[0], rank[:-1] + common[:-1]]) if len(rank) else rank
        each = rank - before + 1
        links = np.zeros(len(texts), np.int64)
        np.add.at(links, own_doc, each)
        start = np.cumsum(each) - each
        here = np.repeat(np.arange(len(short)), each)
        there = np.arange(len(here)) - start[here] + before[here]
        first, second = (there, here) if flip else (here, there)
        pair = a[first] * len(self.b.entries) + b[second]
        span = len(self.a.entries) * len(self.b.entries)
        distinct, times = np.unique(own_doc[here] * span + pair, return_counts=True)
        bounds = np.searchsorted(distinct, np.arange(len(texts) + 1) * span)

        # the text of the groups: a group's A ids, then its B ids
        last = [np.zeros(len(x), bool) for x in ends]
        last[int(flip)][common], last[1 - int(flip)][cut] = True, True
        group = [np.cumsum(x) - x for x in last]
        sizes = [np.bincount(g, minlength=int(groups.sum())) for g in group]
        shift_a = np.cumsum(sizes[1]) - sizes[1]
        shift_b = np.cumsum(sizes[0])
        code = np.empty(len(a) + len(b), np.int64)
        at_a, at_b = len(self.a.entries), 2 * len(self.a.entries)
        code[np.arange(len(a)) + shift_a[group[0]]] = a + at_a * last[0]
        code[np.arange(len(b)) + shift_b[group[1]]] = b + at_b + len(self.b.entries) * last[1]
        letters = self.decimals[code].ravel()
        letters = letters[letters != 0].tobytes()
        stops = np.concatenate([[0], np.cumsum(self.widths[code])])[np.concatenate([[0], np.cumsum(n.sum(axis=1))])].tolist()
        digests = [hashlib.sha256(letters[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(stops, stops[1:])]
        out = {"n_a": n[:, 0], "n_b": n[:, 1], "n_groups": groups, "n_links": links, "groups_sha256": digests}
        out |= {"pairs": [distinct[s:e] - i * span for i, (s, e) in enumerate(zip(bounds, bounds[1:]))]}
        out |= {"times": [times[s:e] for s, e in zip(bounds, bounds[1:])]}
        edges = [np.concatenate([[0], np.cumsum(n[:, k])]) for k in (0, 1)]
        base = np.concatenate([[0], np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 if x else 0 for t, (x, _) in zip(texts, ids)])])
        cuts = np.split(short[common], np.cumsum(groups)[:-1])
        for k, name, own in ((0, "a", a), (1, "b", b)):
            out |= {f"{name}_ids": [own[s:e] for s, e in zip(edges[k], edges[k][1:])]}
            out |= {f"{name}_ends": [ends[k][s:e] - z for s, e, z in zip(edges[k], edges[k][1:], base)]}
        return out | {"cuts": [c - z for c, z in zip(cuts, base)]}


COUNTS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}
PAIRS = {"pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int32())}
SPANS = {"a_ids": pa.list_(pa.int32()), "a_ends": pa.list_(pa.int64()), "b_ids": pa.list_(pa.int32()), "b_ends": pa.list_(pa.int64()), "cuts": pa.list_(pa.int64())}
SQL = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>"}


def _aligned(held, spans: bool):
    kinds = COUNTS | PAIRS | (SPANS if spans else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = held.value
        aligner = Aligner(ByteLevel(files[0]), Pieces(files[1]))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= TOGETHER):
                    size += len(texts[to])
                    to += 1
                found = aligner.align(texts[at:to])
                columns = [pa.array(found[c], k) for c, k in kinds.items()]
                yield pa.record_batch([batch.column("row").slice(at, to - at), *columns], ["row", *kinds])
                at = to

    return run


def align_tokens(docs: DataFrame, a_file: bytes, b_file: bytes, keep: list[str] | None = None, spans: bool = False, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The columns `keep` of `docs` (all but text if not given) and, for every whole text, the
    tokens of space and text by a byte-level BPE (A) and of text by a sentencepiece model (B):
    n_a, n_b, n_groups (runs between offsets at which both have an end), n_links (pairs of an A
    and a B token whose bytes overlap), n_best (links whose pair of ids is linked as often over
    all documents as any pair with its B id), count_sum (those counts over the links) and
    groups_sha256, the digest of the ids of all groups. With `spans` also the ids, the byte
    offsets of their ends and those of the cuts.

    A text that is null or empty, or that one of the two does not give back byte by byte, has
    no tokens: its numbers are 0, its digest is empty. Repeated rows and null ids count and
    stay as they are. Other columns pass untouched, unless they have the name of one that is
    added, which replaces it. No rows give none.

    Encoding is the costly part, so its result is written once below the shared folder and
    read for the counts and for the documents.
    """
    kinds = COUNTS | PAIRS | (SPANS if spans else {})
    added = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + [*SPANS] * spans
    kept = [c for c in (keep if keep is not None else docs.columns) if c != "text" and c not in added]
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((a_file, b_file))  # two vocabulary files
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " if kept else "row struct<>, "
    found = rows.mapInArrow(_aligned(held, spans), schema + ", ".join(f"{c} {SQL[k]}" for c, k in kinds.items()))
    path = f"{shared_dir(spark)}/aligned-{uuid.uuid4().hex}"
    found.withColumn("number", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)

    linked = stored.select("number", F.explode(F.arrays_zip("pairs", "times")).alias("z")).select("number", "z.pairs", "z.times")
    counts = linked.groupBy("pairs").agg(F.sum("times").alias("count"))
    b_id = F.col("pairs") % F.lit(len(parse(b_file).pieces))
    counts = counts.withColumn("b", b_id)
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    rated = cut_lineage(counts.join(highest, "b").select("pairs", "count", (F.col("count") == F.col("highest")).alias("best")))
    if rated.count() <= broadcast_pairs:
        rated = F.broadcast(rated)
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    sums = linked.join(rated, "pairs").groupBy("number").agg(best, F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    out = stored.drop("pairs", "times").join(sums, "number", "left").fillna(0, ["n_best", "count_sum"])
    return out.select("row.*", *added) if kept else out.select(*added)
