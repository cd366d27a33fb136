"""A bidirectional gated recurrent network with attention pooling, in numpy.

Each word of a window enters as two vectors side by side: its own, if the word was frequent
in training, and the scaled sum of the vectors of its frequent character n-grams. So words
never seen are judged by their spelling. The states of both directions are pooled with
attention weights and give one logit for each window.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

WORD_DIM, CHAR_DIM, HIDDEN = 8, 8, 8
GRAMS = (3, 4)
_SLOTS_BITS = 16


def gram_codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the byte n-grams of all words, and the word of each; words get an end mark on either side."""
    data = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(w) + 2 for w in words]) if words else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    codes, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.zeros(len(data) - n + 1, np.uint32)
        for j in range(n):
            code = code << np.uint32(8) | data[j : len(data) - n + 1 + j]
        inside = owner[n - 1 :] == owner[: len(data) - n + 1]
        codes.append(code[inside])
        owners.append(owner[: len(data) - n + 1][inside])
    code, at = np.concatenate(codes), np.concatenate(owners)
    order = np.argsort(at, kind="stable")
    return code[order], at[order]


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS_BITS)


class Vocabulary:
    """The words and n-grams that have vectors of their own; index 0 stands for all others."""

    def __init__(self, docs: list[set[bytes]], least: int = 3, most_words: int = 4000, most_grams: int = 10_000):
        used = Counter(w for doc in docs for w in doc)
        ranked = sorted((w for w, n in used.items() if n >= least), key=lambda w: (-used[w], w))
        self.words = {w: i + 1 for i, w in enumerate(ranked[:most_words])}
        distinct = sorted(used)
        codes, owner = gram_codes(distinct)
        weight = np.array([used[w] for w in distinct], np.int64)
        found, inverse = np.unique(codes, return_inverse=True)
        total = np.bincount(inverse, weight[owner], minlength=len(found)) if len(found) else np.zeros(0)
        best = np.argsort(-total, kind="stable")[:most_grams]
        self.code_at = np.zeros(1 << _SLOTS_BITS, np.uint32)
        self.gram_at = np.zeros(1 << _SLOTS_BITS, np.int32)
        self.grams = 0
        for code in found[best]:
            slot = int(_slot(np.array([code], np.uint32))[0])
            if not self.gram_at[slot]:  # a slot has one n-gram, the more frequent one
                self.grams += 1
                self.code_at[slot], self.gram_at[slot] = code, self.grams

    def lookup(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word index of each word; known n-grams and the word of each."""
        own = np.fromiter((self.words.get(w, 0) for w in words), np.int64, len(words))
        codes, owner = gram_codes(words)
        slot = _slot(codes)
        known = (self.code_at[slot] == codes) & (self.gram_at[slot] > 0)
        return own, self.gram_at[slot[known]].astype(np.int64), owner[known]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Network:
    """Parameters and both passes. ``ids`` of a window index its words; -1 is padding."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 5):
        rng = np.random.default_rng(seed)

        def drawn(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.vocabulary = vocabulary
        self.curve = (1.0, 0.0)  # from largest logits to probabilities
        inputs = WORD_DIM + CHAR_DIM
        self.p = {
            "word": (0.1 * rng.standard_normal((len(vocabulary.words) + 1, WORD_DIM))).astype(np.float32),
            "char": (0.1 * rng.standard_normal((vocabulary.grams + 1, CHAR_DIM))).astype(np.float32),
            "attention": drawn(2 * HIDDEN),
            "out": drawn(2 * HIDDEN),
            "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p |= {f"W{side}": drawn(inputs, 3 * HIDDEN), f"U{side}": drawn(HIDDEN, 3 * HIDDEN)}
            self.p[f"c{side}"] = np.zeros(3 * HIDDEN, np.float32)

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """The input vector of each word, and what its gradient needs."""
        own, grams, owner = self.vocabulary.lookup(words)
        count = np.bincount(owner, minlength=len(words))
        scale = (1 / np.sqrt(np.maximum(count, 1))).astype(np.float32)
        spelled = np.zeros((len(words), CHAR_DIM), np.float32)
        if len(owner):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            spelled[owner[first]] = np.add.reduceat(self.p["char"][grams], first, axis=0)
        return np.concatenate([self.p["word"][own], spelled * scale[:, None]], axis=1), (own, grams, owner, scale)

    def _states(self, side: str, projected: np.ndarray, ids: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction at each step; ``projected`` has a last row for padding."""
        steps, rows = ids.shape[1], len(ids)
        h = np.zeros((rows, HIDDEN), np.float32)
        states = np.empty((steps, rows, HIDDEN), np.float32)
        recurrent = self.p[f"U{side}"]
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            x, inside = projected[ids[:, t]], (ids[:, t] >= 0)[:, None]
            u = h @ recurrent
            gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            new = np.where(inside, n + z * (h - n), h)
            if keep is not None:
                keep.append((t, h, z, r, n, u, inside))
            states[t] = h = new
        return states

    def forward(self, vectors: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``vectors`` are the inputs of the words that ids point to."""
        sides = []
        for side in "fb":
            projected = np.concatenate([vectors @ self.p[f"W{side}"] + self.p[f"c{side}"], np.zeros((1, 3 * HIDDEN), np.float32)])
            steps = None
            if keep is not None:
                steps = keep[side] = []
            sides.append(self._states(side, projected, ids, steps))
        energy = sides[0] @ self.p["attention"][:HIDDEN] + sides[1] @ self.p["attention"][HIDDEN:]
        inside = (ids >= 0).T
        energy = np.where(inside, energy, np.float32(-1e9))
        share = np.exp(energy - energy.max(axis=0)) * inside
        share /= np.maximum(share.sum(axis=0), np.float32(1e-9))
        pooled = np.concatenate([(share[:, :, None] * s).sum(axis=0) for s in sides], axis=1)
        if keep is not None:
            keep |= {"states": sides, "share": share, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"]

    def gradients(self, words: list[bytes], ids: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the weighted logistic loss of windows with the given 0/1 targets."""
        vectors, (own, grams, owner, scale) = self.inputs(words)
        keep: dict = {}
        logit = self.forward(vectors, ids, keep)
        slope = (_sigmoid(logit) - target) * weight / max(1e-9, float(weight.sum()))
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = keep["pooled"].T @ slope, np.array([slope.sum()], np.float32)
        pooled = slope[:, None] * self.p["out"][None]
        share = keep["share"]
        parts = [pooled[:, :HIDDEN], pooled[:, HIDDEN:]]
        by_share = sum((s * p[None]).sum(axis=2) for s, p in zip(keep["states"], parts))
        energy = share * (by_share - (share * by_share).sum(axis=0))
        of_vectors = np.zeros_like(vectors)
        for k, side in enumerate("fb"):
            attention = self.p["attention"][k * HIDDEN : (k + 1) * HIDDEN]
            g["attention"][k * HIDDEN : (k + 1) * HIDDEN] = np.einsum("tn,tnh->h", energy, keep["states"][k])
            of_states = share[:, :, None] * parts[k][None] + energy[:, :, None] * attention
            of_projected = np.zeros((len(vectors) + 1, 3 * HIDDEN), np.float32)
            recurrent, carried = self.p[f"U{side}"], np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, n, u, inside in reversed(keep[side]):
                total = carried + of_states[t]
                d = np.where(inside, total, 0)
                dn = d * (1 - z) * (1 - n * n)
                dz = d * (h - n) * z * (1 - z)
                dr = dn * u[:, 2 * HIDDEN :] * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                g[f"U{side}"] += h.T @ du
                np.add.at(of_projected, ids[:, t], np.concatenate([dz, dr, dn], axis=1))
                carried = np.where(inside, d * z, total) + du @ recurrent.T
            of_projected = of_projected[:-1]
            g[f"W{side}"], g[f"c{side}"] = vectors.T @ of_projected, of_projected.sum(axis=0)
            of_vectors += of_projected @ self.p[f"W{side}"].T
        np.add.at(g["word"], own, of_vectors[:, :WORD_DIM])
        np.add.at(g["char"], grams, (of_vectors[:, WORD_DIM:] * scale[:, None])[owner])
        return g


def train_epochs(network: Network, windows: list[list[bytes]], target: np.ndarray, weight: np.ndarray, epochs: int, rate: float, seed: int) -> None:
    """Adam over shuffled batches of windows."""
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), 256):
            rows = order[start : start + 256]
            words, ids = indexed([windows[i] for i in rows])
            g = network.gradients(words, ids, target[rows], weight[rows])
            step += 1
            for k, v in network.p.items():
                first[k] += np.float32(0.1) * (g[k] - first[k])
                second[k] += np.float32(0.01) * (g[k] * g[k] - second[k])
                v -= np.float32(rate / (1 - 0.9**step)) * first[k] / (np.sqrt(second[k] / (1 - 0.99**step)) + np.float32(1e-6))


def indexed(windows: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and a matrix of their indices, padded with -1."""
    known: dict[bytes, int] = {}
    ids = np.full((len(windows), max([1, *map(len, windows)])), -1, np.int64)
    for i, window in enumerate(windows):
        ids[i, : len(window)] = [known.setdefault(w, len(known)) for w in window]
    return list(known), ids


def scores(network: Network, windows: list[list[bytes]]) -> np.ndarray:
    found = []
    for start in range(0, len(windows), 4096):
        words, ids = indexed(windows[start : start + 4096])
        found.append(_sigmoid(network.forward(network.inputs(words)[0], ids)))
    return np.concatenate([np.zeros(0, np.float32), *found])
