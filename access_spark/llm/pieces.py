"""SentencePiece encoding and decoding that keeps the place of every piece.

Normalisation walks the compiled character map by the longest prefix and notes where each
character came from; merges work on stretches of the normalised text; every piece is then
projected on the bytes of the original.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from access_spark.llm.piece_model import BYTE, CONTROL, SPACE, UNUSED, CharacterMap, PieceModel, normalise, parse

#: Stretches whose merges a task remembers.
REMEMBERED = 400_000
#: Characters up to which a stretch is merged by looking at all its pairs.
SCANNED = 60
#: Bits of an id in the value of a pair.
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1


@dataclass(slots=True)
class Stretch:
    """Pieces of a stretch: ids, their decimals, characters of each, and the decoded text."""

    ids: tuple[int, ...]
    decimals: bytes
    widths: bytes
    text: str


_DECIMALS, _WIDTHS, _TEXT = map(attrgetter, ("decimals", "widths", "text"))


class Remembered(dict):
    """Stretches met so far; too many are forgotten together."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, text: str) -> Stretch:
        found = self.encode(text)
        if len(self) >= REMEMBERED:
            self.clear()
        self[text] = found
        return found


class Codec:
    """Encoder and decoder of a BPE model."""

    def __init__(self, data: bytes) -> None:
        self.model = parse(data)
        self.charmap = CharacterMap(self.model.charmap)
        m = self.model
        self.rank = {p: -m.scores[i] for p, i in m.ids.items()}
        self.unused = {p for p, i in m.ids.items() if m.kinds[i] == UNUSED}
        usable = [p for p in m.ids if len(p) > 1]
        # stretches begin with a run of spaces if no piece has a space behind something else
        apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in usable)
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in usable))
        gaps = re.escape(alone)
        if not apart:
            self.stretches = re.compile(r".+", re.S)
        elif alone:
            self.stretches = re.compile(f"{SPACE}+[^{SPACE}{gaps}]*|[{gaps}]|[^{SPACE}{gaps}]+")
        else:
            self.stretches = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.decimals = [b"%d" % i for i in range(len(m.pieces))]
        self.sizes = list(map(len, m.pieces))
        self.pairs = self._pairs()
        self.known = Remembered(self.encoded)

    def _pairs(self) -> list[dict[int, int]] | None:
        """For each piece, as the left of two neighbours, what it merges to with which right
        one; the last entry stands for characters that are no pieces. None if some pieces are
        only used on the way to others or hold such a character. Pieces of equal scores, which
        only their place orders, are left to the other ways: `tied` finds texts that may hold
        one.

        A value orders by score and holds the id in its lower bits.
        """
        m = self.model
        times = Counter(self.rank.values())
        starts = {p[:2] for p, r in self.rank.items() if times[r] > 1 and len(p) > 1}
        self.tied = re.compile("|".join(map(re.escape, sorted(starts))) or "(?!)").search
        letters = {c: i for c, i in m.ids.items() if len(c) == 1}
        if self.unused or any(c not in letters for p in m.ids for c in p):
            return None
        nothing: dict[int, int] = {}
        pairs = [nothing] * (len(m.pieces) + 1)
        for k, p in enumerate(sorted(self.rank, key=self.rank.get)):
            for cut in range(1, len(p)):
                a, b = m.ids.get(p[:cut]), m.ids.get(p[cut:])
                if a is not None and b is not None:
                    if pairs[a] is nothing:
                        pairs[a] = {}
                    pairs[a][b] = k << ID_BITS | m.ids[p]
        self.letters, self.other = letters, len(m.pieces)
        return pairs

    def _merged_ids(self, text: str) -> list[int]:
        """As `_merged_scan`, on ids; characters that are no pieces are all `other`."""
        pairs, none, other = self.pairs, 1 << 62, self.other
        letter = self.letters.get
        codes = [letter(c, other) for c in text]
        values = [pairs[a].get(b, none) for a, b in zip(codes, codes[1:])]
        while values:
            best = min(values)
            if best == none:
                break
            at = values.index(best)
            new = codes[at] = best & ID_MASK
            del codes[at + 1], values[at]
            if at:
                values[at - 1] = pairs[codes[at - 1]].get(new, none)
            if at < len(values):
                values[at] = pairs[new].get(codes[at + 1], none)
        return codes

    def merged(self, text: str) -> list[str]:
        """Symbols of a stretch after all merges: the best pair first, of equals the leftmost."""
        split: dict[str, tuple[str, str]] = {}
        symbols = self._merged_scan(text, split) if len(text) <= SCANNED else self._merged_heap(text, split)
        if split:
            done: list[str] = []
            stack = symbols[::-1]
            while stack:
                s = stack.pop()
                if s in split and s in self.unused:
                    stack += split[s][::-1]
                else:
                    done.append(s)
            symbols = done
        return symbols

    def _merged_scan(self, text: str, split: dict[str, tuple[str, str]]) -> list[str]:
        """For short stretches: every merge looks at all pairs, which is quick while they are few."""
        symbols, rank, none = list(text), self.rank.get, math.inf
        scores = [rank(a + b, none) for a, b in zip(text, text[1:])]
        while scores:
            best = min(scores)
            if best == none:
                break
            at = scores.index(best)
            joined = symbols[at] + symbols[at + 1]
            if joined in self.unused:
                split[joined] = (symbols[at], symbols[at + 1])
            symbols[at : at + 2] = [joined]
            del scores[at]
            if at:
                scores[at - 1] = rank(symbols[at - 1] + joined, none)
            if at < len(scores):
                scores[at] = rank(joined + symbols[at + 1], none)
        return symbols

    def _merged_heap(self, text: str, split: dict[str, tuple[str, str]]) -> list[str]:
        """For long stretches: linked symbols and a heap of pairs, n log n in the length."""
        symbols, rank, n = list(text), self.rank.get, len(text)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, i + 1, 2) for i in range(n - 1) if (r := rank(text[i] + text[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            # either side has been merged since if the sizes differ
            if after[i] != j or len(symbols[i]) + len(symbols[j]) != size:
                continue
            joined = symbols[i] + symbols[j]
            if joined in self.unused:
                split[joined] = (symbols[i], symbols[j])
            symbols[i], symbols[j] = joined, ""
            after[i] = k = after[j]
            after[j] = -2
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0:
                    r = rank(symbols[left] + symbols[right])
                    if r is not None:
                        heapq.heappush(heap, (r, left, right, len(symbols[left]) + len(symbols[right])))
            if k >= 0:
                before[k] = i
        return [s for s in symbols if s]

    def stretch(self, text: str) -> Stretch:
        return self.known[text]

    def encoded(self, text: str) -> Stretch:
        """Pieces of a stretch that is not remembered."""
        m = self.model
        if self.pairs is not None and len(text) <= SCANNED and not self.tied(text):
            ids = self._merged_ids(text)
            if self.other not in ids:
                return Stretch(tuple(ids), b" ".join(map(self.decimals.__getitem__, ids)), bytes(map(self.sizes.__getitem__, ids)), text.replace(SPACE, " "))
        symbols = self.merged(text)
        ids = list(map(m.ids.get, symbols))
        widths = list(map(len, symbols))
        shown = text.replace(SPACE, " ")  # pieces and the bytes of characters give back their text
        if None in ids:
            found, ids, sizes, widths = list(zip(ids, symbols)), [], widths, []
            for (i, s), size in zip(found, sizes):
                if i is None and m.byte_fallback:
                    own = s.encode()
                    ids += [m.byte_ids[b] for b in own]
                    # the bytes of a character share its place; the last one ends it
                    widths += [0] * (len(own) - 1) + [size]
                else:
                    ids.append(m.unknown_id if i is None else i)
                    widths.append(size)
            if not m.byte_fallback:
                shown = self.joined(ids)
        return Stretch(tuple(ids), b" ".join(map(self.decimals.__getitem__, ids)), bytes(widths), shown)

    def joined(self, ids: list[int] | tuple[int, ...]) -> str:
        """Text of a run of pieces, spaces in place of their sign, before the first is cut.

        Bytes next to each other are read as UTF-8; each that cannot be is a replacement
        character.
        """
        m, out, held = self.model, [], bytearray()
        for i in ids:
            if m.kinds[i] == BYTE:
                held.append(int(m.pieces[i][3:5], 16))
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i == m.unknown_id:
                out.append(m.unknown_surface)
            elif m.kinds[i] != CONTROL:
                out.append(m.pieces[i].replace(SPACE, " "))
        if held:
            out.append(_utf8(bytes(held)))
        return "".join(out)

    def encode(self, text: str) -> tuple[list[Stretch], np.ndarray]:
        """(stretches in order, end byte in the original of every piece)."""
        normal, origin = normalise(text, self.model, self.charmap)
        own = list(map(self.known.__getitem__, self.stretches.findall(normal)))
        ends = np.cumsum(np.frombuffer(b"".join(map(_WIDTHS, own)), np.uint8), dtype=np.int64)
        if origin is not None:
            places = np.array(origin, np.int64)
        elif text.isascii():
            return own, np.maximum(ends - int(self.model.dummy_prefix), 0)
        else:
            lead = np.frombuffer(text.encode(), np.uint8)
            starts = np.flatnonzero((lead & 0xC0) != 0x80)
            places = np.concatenate([[0] * int(self.model.dummy_prefix and bool(text)), starts, [len(lead)]]).astype(np.int64)
        return own, places[ends]

    def ids(self, text: str, end: bool = True) -> list[int]:
        return [i for s in self.encode(text)[0] for i in s.ids] + [self.model.end_id] * end

    def decode(self, ids: list[int]) -> str:
        """Text of any ids. The space of the dummy prefix is cut; so are leading spaces where
        the model trims them."""
        return self._cut(self.joined(ids))

    def decode_stretches(self, own: list[Stretch]) -> str:
        """As `decode` of their ids. No run of bytes goes over from one stretch to the next:
        they end with whole characters."""
        return self._cut("".join(map(_TEXT, own)))

    def _cut(self, text: str) -> str:
        if self.model.trim_spaces:
            return text.lstrip(" ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def _utf8(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at : at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


#: Ids and ends that a task holds before it hands them on; a longer text stands alone.
HELD_IDS = 1 << 18
#: Texts of a batch that a task takes out at once.
HELD_TEXTS = 128


def _encode(held, spans: bool):
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"] + ["ids", "ends"] * spans
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.list_(pa.int32()), pa.list_(pa.int64())] * spans

    def batch_of(batch: pa.RecordBatch, rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(names)
        added = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        return pa.RecordBatch.from_arrays([*batch.columns[1:], added], [*batch.schema.names[1:], "_pieces"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(held.value)
        for batch in batches:
            rows, first, n_held = [], 0, 0
            texts = (batch.column(0).slice(i, HELD_TEXTS).to_pylist() for i in range(0, len(batch), HELD_TEXTS))
            for text in chain.from_iterable(texts):
                own, ends = codec.encode(text or "")
                decimals = b" ".join([*map(_DECIMALS, own), b"%d" % codec.model.end_id])
                decoded = codec.decode_stretches(own).encode("utf-8", "surrogatepass")
                row = [len(ends) + 1, hashlib.sha256(decimals).hexdigest(), hashlib.sha256(decoded).hexdigest(), int(ends[-1]) if len(ends) else 0]
                if spans:
                    ids = np.fromiter((i for s in own for i in s.ids), np.int32, len(ends))
                    row += [np.append(ids, np.int32(codec.model.end_id)), np.append(ends, row[3]).astype(np.int64)]
                    n_held += row[0]
                rows.append(row)
                if n_held >= HELD_IDS:
                    yield batch_of(batch.slice(first, len(rows)), rows)
                    rows, first, n_held = [], first + len(rows), 0
            if rows or not first:
                yield batch_of(batch.slice(first), rows)

    return run


def encode_documents(docs: DataFrame, model: bytes, keep: list[str] | None = None, spans: bool = False) -> DataFrame:
    """Pieces of every whole text: the columns `keep` of `docs` (all but text if not given),
    n_tokens (the end id counts), ids_sha256, decoded_sha256 and n_bytes, the byte of the
    original at which the last piece ends. With `spans` also ids and ends: piece i covers the
    original bytes from ends[i - 1] (0 for the first) to ends[i]; the end id covers none.

    A null text is an empty one: its only id is the end id, and it decodes to an empty text.
    Repeated rows and null ids stay as they are; other columns pass untouched unless they
    have the name of one that is added, which replaces it. No rows give none.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"] + ["ids", "ends"] * spans
    kept = [c for c in (keep if keep is not None else docs.columns) if c != "text" and c not in added]
    rows = docs.select("text", *kept)
    held = docs.sparkSession.sparkContext.broadcast(model)  # the model file, half a megabyte
    kinds = "n_tokens: long, ids_sha256: string, decoded_sha256: string, n_bytes: long" + ", ids: array<int>, ends: array<long>" * spans
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    out = rows.mapInArrow(_encode(held, spans), ", ".join([*fields, f"_pieces struct<{kinds}>"]))
    return out.select(*[f"`{c}`" for c in kept], "_pieces.*")
