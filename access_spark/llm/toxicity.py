"""Toxicity by a bidirectional gated recurrent network over words and characters.

The network is trained in numpy on the driver from a bounded sample of labelled documents
and scores every overlapping window of every text in the tasks. A document's score comes
from its worst window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark.llm.common import whole_row
from access_spark.llm.gru import CHAR_BUCKETS, Scorer, initial, sigmoid, train
from access_spark.llm.words import hash_spans, mix64, text_groups, word_spans
from access_spark.session import cut_lineage

WINDOW, STRIDE = 32, 16
#: Clean and toxic documents to train on at most, documents to calibrate on, windows of one
#: training document, and the training documents that make a word known.
TRAIN_DOCS, CALIBRATION_DOCS, DOC_WINDOWS, KNOWN_IN = (2500, 1500), 3000, 16, 12
#: Windows of a document that count in each round of training, and epochs of the rounds.
COUNTED, EPOCHS = 4, (3, 2, 3)
THRESHOLD = 0.3

# letters and digits; bytes of other scripts count as letters
_KEEP = np.zeros(256, bool)
_KEEP[48:58] = _KEEP[65:91] = _KEEP[97:123] = _KEEP[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)


def _bytes_at(data: np.ndarray, at: np.ndarray, from_: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Bucket of the four bytes at `at`, those outside [from_, until) taken as zero."""
    value = np.zeros(len(at), np.uint64)
    for k in range(4):
        place = at + k
        inside = (place >= from_) & (place < until)
        value = value * np.uint64(256) + np.where(inside, data[np.clip(place, 0, len(data) - 1)], 0).astype(np.uint64)
    return (mix64(value + np.uint64(1)) % np.uint64(CHAR_BUCKETS)).astype(np.int32)


def tokens(texts: list[str | None]):
    """(word hashes, head buckets, tail buckets, first word of each text and the end)."""
    data, starts, ends, firsts = word_spans(texts, _KEEP)
    words = hash_spans(data, starts, ends)
    low = _LOWER[data]
    return words, _bytes_at(low, starts, starts, ends), _bytes_at(low, ends - 4, starts, ends), firsts


def window_places(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, text) of all windows: every STRIDE words, the last one at the text's end."""
    counts = np.diff(firsts)
    extra = np.maximum(0, -(-(counts - WINDOW) // STRIDE))
    windows = np.where(counts > 0, 1 + extra, 0)
    text = np.repeat(np.arange(len(counts)), windows)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = firsts[:-1][text] + np.minimum(nth * STRIDE, np.maximum(0, counts[text] - WINDOW))
    return start, text


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each labelled document, spread evenly over its length."""
    for batch in batches:
        rows = []
        for text, label, doc in zip(*(c.to_pylist() for c in batch.columns)):
            words, heads, tails, firsts = tokens([text])
            start, _ = window_places(firsts)
            for i in np.unique(np.linspace(0, len(start) - 1, DOC_WINDOWS).astype(int)) if len(start) else []:
                part = slice(start[i], min(start[i] + WINDOW, len(words)))
                rows.append((label, doc, words[part].tobytes(), heads[part].tobytes(), tails[part].tobytes()))
        yield pa.RecordBatch.from_pylist([dict(zip(("label", "doc", "words", "heads", "tails"), r)) for r in rows], pa.schema([("label", pa.int32()), ("doc", pa.int64()), ("words", pa.binary()), ("heads", pa.binary()), ("tails", pa.binary())]))


@dataclass
class Model:
    """Parameters, the known words (sorted hashes) and the calibration of a logit."""

    params: dict | None
    known: np.ndarray
    slope: float = 1.0
    offset: float = 0.0


def _numbers(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all rows in one array, how many each row has) of a column of bytes."""
    held = pa.concat_arrays(column.chunks)
    _, ends, data = held.buffers()
    ends = np.frombuffer(ends, np.int32)[held.offset : held.offset + len(held) + 1] // np.dtype(kind).itemsize
    return np.frombuffer(data, kind)[ends[0] : ends[-1]], np.diff(ends)


def fit(rows: pa.Table) -> Model | None:
    """Train on collected windows, grouped by document; None if a class is missing.

    A label is about a document, so most windows of a toxic one may be harmless. The first
    round takes windows at random, each later one the windows of each document that the
    network finds worst: the likely offence of a toxic document, the likely mistake in a
    clean one. The windows stay in a few arrays, with no object for each on the driver.
    """
    labels = rows["label"].to_numpy().astype(np.float32)
    if not len(rows) or labels.min() == labels.max():
        return None
    rows = rows.sort_by([("doc", "ascending"), ("words", "ascending"), ("heads", "ascending")])
    labels = rows["label"].to_numpy().astype(np.float32)
    docs = np.unique(rows["doc"].to_numpy(), return_inverse=True)[1].astype(np.int32)
    own, lengths = _numbers(rows["words"], np.uint64)
    known = known_words(own, np.repeat(docs, lengths))
    size = (len(rows), WINDOW)
    mask = np.arange(WINDOW) < lengths[:, None]
    words, heads, tails = np.zeros(size, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32)
    words[mask] = word_ids(own, known)
    heads[mask], tails[mask] = _numbers(rows["heads"], np.int32)[0], _numbers(rows["tails"], np.int32)[0]
    del rows, own
    params = initial(len(known))
    rank = np.random.default_rng(5).random(len(labels))
    for epochs in EPOCHS:
        order = np.lexsort((-rank, docs))
        first = np.concatenate([[0], np.flatnonzero(np.diff(docs[order])) + 1])
        nth = np.arange(len(order)) - np.repeat(first, np.diff(np.concatenate([first, [len(order)]])))
        rows_now = order[nth < COUNTED]
        params = train(params, words[rows_now], heads[rows_now], tails[rows_now], mask[rows_now], labels[rows_now], epochs)
        scorer, flat = Scorer(params), np.arange(WINDOW)[:, None]
        for k in range(0, len(labels), 2048):
            part = slice(k, k + 2048)
            at = flat + np.arange(len(labels[part])) * WINDOW
            rank[part] = scorer.logits(words[part].reshape(-1), heads[part].reshape(-1), tails[part].reshape(-1), at, mask[part].T)
    return Model(params, known)


def known_words(words: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The words, sorted, that stand in KNOWN_IN documents or more."""
    order = np.lexsort((docs, words))
    words, docs = words[order], docs[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (docs[1:] != docs[:-1])
    seen, times = np.unique(words[new], return_counts=True)
    return seen[times >= KNOWN_IN]


def word_ids(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """1 and on for known words, 0 for the others."""
    if not len(known):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, at + 1, 0)


def worst_logits(texts: list[str | None], model: Model, scorer: Scorer, rows: int = 2048) -> np.ndarray:
    """Largest logit among the windows of each text; minus infinity without words."""
    out = []
    for group in text_groups(texts, 1 << 18):
        words, heads, tails, firsts = tokens(group)
        ids = word_ids(words, model.known)
        start, text = window_places(firsts)
        worst = np.full(len(group), -np.inf)
        short = np.diff(firsts)[text] < WINDOW
        for some in (np.flatnonzero(~short), np.flatnonzero(short)):
            for k in range(0, len(some), rows):
                own = some[k : k + rows]
                at = start[own] + np.arange(WINDOW)[:, None]
                mask = None
                if short[own[0]]:
                    mask = at < firsts[1:][text[own]]
                    at = np.minimum(at, len(words) - 1)
                np.maximum.at(worst, text[own], scorer.logits(ids, heads, tails, at, mask))
        out.append(worst)
    return np.concatenate(out) if out else np.zeros(0)


def _score(held, key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        scorer = Scorer(model.params)
        for batch in batches:
            logits = worst_logits(batch.column(1).to_pylist(), model, scorer)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(key_type), pa.array(logits, pa.float64())], ["key", "logit"])

    return run


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit by damped Newton steps, with smoothed targets."""
    good = np.isfinite(logits)
    x, y = logits[good], labels[good]
    hits, misses = (y == 1).sum(), (y == 0).sum()
    if not hits or not misses:
        return 1.0, 0.0
    target = np.where(y == 1, (hits + 1) / (hits + 2), 1 / (misses + 2))
    middle, spread = x.mean(), x.std() + 1e-6
    rows = np.stack([(x - middle) / spread, np.ones_like(x)], axis=1)

    def loss(b):
        return np.sum(np.logaddexp(0, rows @ b) - target * (rows @ b)) + 5e-4 * b @ b

    beta = np.array([0.0, np.log(hits / misses)])
    for _ in range(100):
        prob = sigmoid(rows @ beta)
        slope = rows.T @ (target - prob) - 1e-3 * beta
        step = np.linalg.solve((rows * (prob * (1 - prob))[:, None]).T @ rows + 1e-3 * np.eye(2), slope)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    scale = max(beta[0], 1e-3) / spread
    return float(scale), float(beta[1] - scale * middle)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def train_model(docs: DataFrame, labels: DataFrame, held_out: int = 2) -> Model | None:
    """Learn from labelled rows outside the held-out fold.

    The sample is bounded by TRAIN_DOCS and CALIBRATION_DOCS at their natural
    mix, drawn by a hash of the id; its ids are the only broadcast. Null ids and null labels
    are left out, and of several labels of one id the larger counts.
    """
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_label"))
    marks = marks.filter(fold(F.col("doc_id")) != held_out).withColumn("_draw", F.xxhash64("doc_id", F.lit("toxic")))
    setting = fold(F.col("doc_id")) == (held_out + 1) % 4
    parts = [marks.filter(~setting & (F.col("_label") == c)).orderBy("_draw", "doc_id").limit(TRAIN_DOCS[c]).withColumn("_use", F.lit("train")) for c in (0, 1)]
    parts.append(marks.filter(setting).orderBy("_draw", "doc_id").limit(CALIBRATION_DOCS).withColumn("_use", F.lit("calibrate")))
    sample = parts[0].union(parts[1]).union(parts[2]).select(F.col("doc_id").alias("_id"), "_label", "_use")
    chosen = cut_lineage(docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("text", "_label", F.xxhash64("_id").alias("_doc"), "_use"))
    windows = chosen.filter("_use = 'train'").select("text", "_label", "_doc").mapInArrow(_window_rows, "label int, doc long, words binary, heads binary, tails binary")
    model = fit(windows.toArrow())
    if model is None:
        return None
    held = docs.sparkSession.sparkContext.broadcast(model)
    graded = chosen.filter("_use = 'calibrate'").select("_label", "text").mapInArrow(_score(held, pa.int64()), "key long, logit double").collect()
    model.slope, model.offset = calibrate(np.array([r.logit for r in graded]), np.array([r.key for r in graded]))
    return model


def _score_column(docs: DataFrame, labels: DataFrame, held_out: int) -> Column:
    model = train_model(docs, labels, held_out)
    if model is None:
        return F.lit(0.0)
    return _scores(docs.sparkSession.sparkContext.broadcast(model), F.col("text"))


def score_documents(docs: DataFrame, labels: DataFrame, held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of `docs` with held_out (boolean), score (0 to 1) and predicted (0 or 1).

    Only the text is an input of the score. Null, empty and wordless texts score as low as
    anything can (0.0). A null doc_id is scored like any other. Without labels of both
    classes every score is 0.0. Repeated rows are scored alike; columns named as those added
    are replaced. No rows give none.
    """
    scored = docs.withColumn("score", _score_column(docs, labels, held_out))
    return scored.withColumns({"held_out": fold(F.col("doc_id")) == held_out, "predicted": (F.col("score") >= threshold).cast("int")})


def clean_documents(docs: DataFrame, labels: DataFrame, held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, all columns as they were."""
    score = _score_column(docs, labels, held_out).alias("score")
    return docs.select(whole_row(docs), score).filter(F.col("score") < threshold).select("doc.*")


def _scores(held, text: Column) -> Column:
    state: dict = {}

    def score(batches):
        model = held.value
        scorer = state.setdefault("scorer", Scorer(model.params))
        for texts in batches:
            logits = worst_logits(texts.to_pylist(), model, scorer)
            value = sigmoid(model.slope * np.maximum(logits, -1e6) + model.offset)
            yield pa.array(np.where(np.isfinite(logits), value, 0.0), pa.float64())

    from collections.abc import Iterator as It

    score.__annotations__ = {"batches": It[pa.Array], "return": It[pa.Array]}
    return F.arrow_udf(score, "double")(text)
