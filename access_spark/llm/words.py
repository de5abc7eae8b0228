"""Words of texts as numpy arrays of 64-bit hashes, a whole batch of texts at a time.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return; A-Z count as a-z. Runs inside tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SEED = 20240817
# a random value for each byte, and odd multipliers modulo 2**64
_RNG = np.random.default_rng(_SEED)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = 1 << 16


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, _STEP)
_DOWN = _powers(pow(_BASE, -1, 2**64), _STEP)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, by prefix sums of a polynomial taken modulo 2**64.

    Prefix sums restart every 65,536 bytes, so only two tables of powers are needed; a span
    over a border is the sum of its two parts, and longer spans are folded byte by byte.
    """
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    pad = -len(data) % _STEP
    value = _BYTE[data]
    blocks = np.concatenate([value, np.zeros(pad, np.uint64)]).reshape(-1, _STEP) * _UP
    sums = np.zeros((blocks.shape[0], _STEP + 1), np.uint64)
    np.cumsum(blocks, axis=1, dtype=np.uint64, out=sums[:, 1:])
    row, at = starts // _STEP, starts % _STEP
    length = ends - starts
    last = at + length
    near = last <= _STEP
    first_end = np.minimum(last, _STEP)
    out = (sums[row, first_end] - sums[row, at]) * _DOWN[at]
    over = ~near & (last <= 2 * _STEP)
    if over.any():
        r, rest, shift = row[over] + 1, last[over] - _STEP, _STEP - at[over]
        out[over] += sums[r, rest] * _UP[np.minimum(shift, _STEP - 1)] * np.where(shift == _STEP, np.uint64(_BASE), np.uint64(1))
    for i in np.flatnonzero(last > 2 * _STEP):
        h = 0
        for v in value[starts[i] : ends[i]][::-1].tolist():
            h = (h * _BASE + v) & (2**64 - 1)
        out[i] = h
    return mix64(out ^ (length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def word_spans(texts: list[str | None], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, first word of each text and the end) of a batch.

    `keep` tells which bytes make words, all but the six white ones if it is not given.
    Texts are joined by a space, so no word crosses two of them.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    inside = keep[data] if keep is not None else ~_SPACE[data]
    if len(data):
        inside[-1] = False
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    text_ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
    firsts = np.concatenate([[0], np.searchsorted(starts, text_ends)]).astype(np.int64)
    return data, starts, ends, firsts


def word_hashes(texts: list[str | None], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text and the end)."""
    data, starts, ends, firsts = word_spans(texts, keep)
    return hash_spans(data, starts, ends), firsts


def text_groups(texts: list[str | None], most: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about `most` characters; a longer text stands alone."""
    group, held = [], 0
    for t in texts:
        if group and held + len(t or "") > most:
            yield group
            group, held = [], 0
        group.append(t)
        held += len(t or "")
    if group:
        yield group


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashes of the runs of `width` words of each text.

    A text with fewer words is one run; one without words has none.
    """
    return [s for group in text_groups(texts) for s in _group_sets(group, width)]


def _group_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    words, firsts = word_hashes(texts)
    n = len(words)
    if not n:
        return [np.zeros(0, np.uint64)] * len(texts)
    runs = np.zeros(n, np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    reach = max(0, n - width + 1)
    for k in range(width):
        runs[:reach] = runs[:reach] * factor + words[k : k + reach]
    runs = mix64(runs)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = short * factor + words[k : k + 1]
            out.append(mix64(short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
