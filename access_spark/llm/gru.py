"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Each position of a window has a word input and two character inputs (its first and last
bytes, hashed). Their vectors are added and read by a recurrent layer in either direction;
attention weighs the positions, and a linear unit scores the weighted mean.
"""

from __future__ import annotations

import numpy as np

CHAR_BUCKETS = 8192
DIM, HIDDEN = 12, 8


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(vocabulary: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters; row 0 of `word` stands for words outside the vocabulary."""
    rng = np.random.default_rng(seed)

    def small(*shape, scale=0.1):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": small(vocabulary + 1, DIM), "head": small(CHAR_BUCKETS, DIM), "tail": small(CHAR_BUCKETS, DIM)}
    for d in "fb":
        p |= {f"w{d}": small(DIM, 3 * HIDDEN, scale=0.3), f"u{d}": small(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
    return p | {"attend": small(2 * HIDDEN, scale=0.3), "out": small(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}


def _layer(gates: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
    """States (time, row, hidden) of one direction. gates: inputs of the three gates."""
    steps, rows = gates.shape[:2]
    h = np.zeros((rows, HIDDEN), np.float32)
    out = np.empty((steps, rows, HIDDEN), np.float32)
    for t in range(steps):
        g = gates[t]
        s = h @ u
        zr = sigmoid(g[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(g[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if keep is not None:
            keep.append((h, z, r, n, s[:, 2 * HIDDEN :]))
        h = out[t] = new
    return out


def _layer_back(d_out: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
    steps = len(keep)
    d_gates = np.zeros((steps, d_out.shape[1], 3 * HIDDEN), np.float32)
    d_u = np.zeros_like(u)
    carry = np.zeros_like(d_out[0])
    for t in range(steps - 1, -1, -1):
        h, z, r, n, sn = keep[t]
        m = mask[t][:, None]
        d = d_out[t] + carry
        dn = d * (1 - z) * m
        dz = d * (h - n) * m * z * (1 - z)
        dn = dn * (1 - n * n)
        dr = dn * sn * r * (1 - r)
        d_gates[t] = np.concatenate([dz, dr, dn], axis=1)
        ds = np.concatenate([dz, dr, dn * r], axis=1)
        d_u += h.T @ ds
        carry = ds @ u.T + d * np.where(m, z, 1)
    return d_gates, d_u


def _pool(states: np.ndarray, p: dict, mask: np.ndarray | None):
    e = states @ p["attend"]
    if mask is not None:
        e = np.where(mask, e, np.float32(-1e9))
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", a, states, optimize=True)
    return a, pooled, pooled @ p["out"] + p["bias"][0]


def loss_and_gradients(p: dict, words, heads, tails, mask, labels) -> tuple[float, dict]:
    """Mean cross-entropy of a batch (time, row) and its gradients."""
    x = p["word"][words] + p["head"][heads] + p["tail"][tails]
    kept: dict[str, list] = {"f": [], "b": []}
    order = {"f": slice(None), "b": slice(None, None, -1)}
    states = [
        _layer((x @ p[f"w{d}"] + p[f"c{d}"])[order[d]], p[f"u{d}"], mask[order[d]], kept[d])[order[d]] for d in "fb"
    ]
    both = np.concatenate(states, axis=2)
    a, pooled, logit = _pool(both, p, mask)
    prob = sigmoid(logit)
    loss = float(-np.mean(labels * np.log(prob + 1e-9) + (1 - labels) * np.log(1 - prob + 1e-9)))
    d_logit = ((prob - labels) / len(labels)).astype(np.float32)
    g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["out"]
    d_a = np.einsum("tnh,nh->tn", both, d_pooled, optimize=True)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    g["attend"] = np.einsum("tn,tnh->h", d_e, both, optimize=True)
    d_both = a[:, :, None] * d_pooled + d_e[:, :, None] * p["attend"]
    d_x = np.zeros_like(x)
    for i, d in enumerate("fb"):
        part = d_both[:, :, i * HIDDEN : (i + 1) * HIDDEN]
        d_gates, g[f"u{d}"] = _layer_back(part[order[d]], p[f"u{d}"], mask[order[d]], kept[d])
        d_gates = d_gates[order[d]]
        g[f"c{d}"] = d_gates.sum(axis=(0, 1))
        g[f"w{d}"] = np.einsum("tne,tng->eg", x, d_gates, optimize=True)
        d_x += d_gates @ p[f"w{d}"].T
    d_x *= mask[:, :, None]
    for name, ids in (("word", words), ("head", heads), ("tail", tails)):
        g[name] = np.zeros_like(p[name])
        np.add.at(g[name], ids.reshape(-1), d_x.reshape(-1, DIM))
    return loss, g


def train(p: dict, words, heads, tails, mask, labels, epochs: int, batch: int = 128, rate: float = 0.01, decay: float = 1e-3) -> dict:
    """Go on from parameters by Adam over rows of windows. Embeddings decay a little, which
    keeps rare words and bytes near zero."""
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    rng, step = np.random.default_rng(11), 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            _, g = loss_and_gradients(p, words[rows].T, heads[rows].T, tails[rows].T, mask[rows].T, labels[rows])
            step += 1
            now = rate * (1 - epoch / epochs)
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] * g[k]
                move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                p[k] = (p[k] - now * move - (decay * now * 10 * p[k] if k in ("word", "head", "tail") else 0)).astype(np.float32)
    return p


class Scorer:
    """Scores windows. Embeddings are multiplied into the gates once, so a position costs
    three row look-ups per direction and one small product."""

    def __init__(self, p: dict) -> None:
        self.p = p
        gates = np.concatenate([p["wf"], p["wb"]], axis=1)
        bias = np.concatenate([p["cf"], p["cb"]])
        self.tables = [p["word"] @ gates + bias, p["head"] @ gates, p["tail"] @ gates]

    def logits(self, words, heads, tails, at: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """words, heads, tails: ids of the tokens of many texts; at: (time, row) places of
        the windows among them; mask: which of these are filled (None: all)."""
        gates = self.tables[0][words] + self.tables[1][heads]
        gates += self.tables[2][tails]
        ahead = gates[at, : 3 * HIDDEN]
        back = gates[at[::-1], 3 * HIDDEN :]
        f = _layer(ahead, self.p["uf"], mask, None)
        b = _layer(back, self.p["ub"], None if mask is None else mask[::-1], None)[::-1]
        return _pool(np.concatenate([f, b], axis=2), self.p, mask)[2]
