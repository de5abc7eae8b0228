"""Token counts of texts by a unigram vocabulary, with work shared along a trie.

The best segmentation of a pre-token is a forward pass: the best score that reaches each of
its characters. Two pre-tokens with a common beginning have the same scores there, so the
distinct pre-tokens of a batch form a trie, and a depth-first walk computes each of its
nodes once. At the nodes where a pre-token ends, its number of tokens is stored; the count of
a text is the sum over its pre-tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from access_spark.llm.piece_model import NORMAL, SPACE, USER_DEFINED, PieceModel, CharacterMap, normalise, parse

#: Pre-tokens whose counts a task remembers.
REMEMBERED = 400_000
#: An unknown character scores this much less than the worst piece (fixed value of the library).
UNKNOWN_PENALTY = 10.0


class TrieCounter:
    """Counts of tokens in pre-tokens by the best sum of piece scores.

    Of segmentations with equal scores the one with fewer tokens counts. A character that no
    piece is made of counts one token for each of its bytes if the model falls back on bytes,
    else one.
    """

    def __init__(self, model: PieceModel) -> None:
        usable = [i for i, k in enumerate(model.kinds) if k in (NORMAL, USER_DEFINED)]
        self.scores = {model.pieces[i]: model.scores[i] for i in usable}
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min((model.scores[i] for i in usable), default=0.0) - UNKNOWN_PENALTY
        self.by_bytes = model.byte_fallback

    def count_all(self, pretokens: Iterable[str]) -> dict[str, int]:
        """Tokens of each of some distinct pre-tokens.

        In sorted order a pre-token shares its path with the one before it up to their
        common beginning, which is how a depth-first walk comes to it in the trie: the
        nodes of the current path are the stack, and only new nodes are computed.
        """
        get, longest = self.scores.get, self.longest
        best: list[tuple[float, int]] = [(0.0, 0)]  # per node of the path: score, minus tokens
        before, counts = "", {}
        for word in sorted(pretokens):
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del best[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                top = None
                for start in range(end - 1, max(-1, end - longest - 1), -1):
                    score = get(word[start:end])
                    if score is None:
                        if start == end - 1:
                            bytes_ = len(word[start].encode("utf-8", "surrogatepass")) if self.by_bytes else 1
                            top = (best[start][0] + self.unknown, best[start][1] - bytes_)
                        continue
                    reached = (best[start][0] + score, best[start][1] - 1)
                    if top is None or reached > top:
                        top = reached
                best.append(top)
            counts[word] = -best[len(word)][1]
            before = word
        return counts


def _count(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = parse(held.value)
        counter, charmap = TrieCounter(model), CharacterMap(model.charmap)
        stretches = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        known: dict[str, int] = {}
        for batch in batches:
            tokens, pretokens = [], []
            for part in _parts(batch.column(0).to_pylist()):
                split = [stretches.findall(normalise(t or "", model, charmap)[0]) for t in part]
                new = {w for words in split for w in words if w not in known}
                if len(known) + len(new) > REMEMBERED:
                    known = {}
                    new = {w for words in split for w in words}
                known.update(counter.count_all(new))
                tokens += [sum(map(known.__getitem__, words)) for words in split]
                pretokens += [len(words) for words in split]
            added = pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.array(pretokens, pa.int64())], ["n_tokens", "n_pretokens"])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], added], [*batch.schema.names[1:], "_counts"])

    return run


def _parts(texts: list[str | None], most: int = 1 << 22) -> Iterator[list[str | None]]:
    """Texts in lists of about `most` characters."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t or "")
        if held > most:
            yield part
            part, held = [], 0
    if part:
        yield part


def count_tokens(docs: DataFrame, model: bytes, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all but text if not given) with n_tokens and n_pretokens.

    Pre-tokens are the runs of the normalised text that begin with spaces. Null and empty
    texts have none and count 0. Repeated rows and null ids stay; columns with the names of
    those added are replaced; no rows give none. `model` is a SentencePiece model file whose
    scores are taken as log-probabilities.
    """
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in ("text", "n_tokens", "n_pretokens")]
    rows = docs.select("text", *kept)
    held = docs.sparkSession.sparkContext.broadcast(model)  # the model file, half a megabyte
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    out = rows.mapInArrow(_count(held), ", ".join([*fields, "_counts struct<n_tokens: long, n_pretokens: long>"]))
    return out.select(*[f"`{c}`" for c in kept], "_counts.*")
