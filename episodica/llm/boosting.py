"""Gradient-boosted trees for binary labels: histogram splits, logistic loss, rows sampled for each tree, numpy only."""

from __future__ import annotations

import io

import numpy as np


class Trees:
    """Complete binary trees of `depth` levels over binned features."""

    def __init__(self, rounds: int = 60, depth: int = 4, bins: int = 32, rate: float = 0.2, l2: float = 1.0, share: float = 1.0) -> None:
        self.rounds, self.depth, self.bins, self.rate, self.l2, self.share = rounds, depth, bins, rate, l2, share

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T, strict=True)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        b = self._binned(x)
        n, d = b.shape
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        f, self.trees = np.full(n, self.base), []
        every, offset, rng = b, np.arange(d) * self.bins, np.random.default_rng(0)
        for _ in range(self.rounds):
            some = rng.permutation(n)[: max(1, int(self.share * n))] if self.share < 1 else np.arange(n)
            b = every[some]
            flat, p = b + offset, 1 / (1 + np.exp(-f[some]))
            g, h = y[some] - p, p * (1 - p)
            node = np.zeros(len(some), np.int64)
            feature, cut = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, self.bins, np.int64)
            for level in range(self.depth):
                k, first = 1 << level, (1 << level) - 1
                at = ((node - first)[:, None] * (d * self.bins) + flat).ravel()
                gs, hs = (np.bincount(at, np.repeat(w, d), minlength=k * d * self.bins).reshape(k, d, self.bins).cumsum(axis=2) for w in (g, h))
                gt, ht = gs[:, :1, -1:], hs[:, :1, -1:]
                gain = gs**2 / (hs + self.l2) + (gt - gs) ** 2 / (ht - hs + self.l2) - gt**2 / (ht + self.l2)
                gain[(hs < 1) | (ht - hs < 1)] = 0
                best = gain.reshape(k, -1).argmax(axis=1)
                good = gain.reshape(k, -1)[np.arange(k), best] > 1e-6
                feature[first : first + k] = best // self.bins
                cut[first : first + k] = np.where(good, best % self.bins, self.bins)
                node = 2 * node + 1 + (b[np.arange(len(some)), feature[node]] > cut[node])
            leaf = node - ((1 << self.depth) - 1)
            gs, hs = (np.bincount(leaf, w, minlength=1 << self.depth) for w in (g, h))
            value = self.rate * gs / (hs + self.l2)
            self.trees.append((feature, cut, value))
            f = f + (value[leaf] if len(some) == n else self._values(every, self.trees[-1]))
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        f = np.full(len(b), self.base)
        for tree in self.trees:
            f += self._values(b, tree)
        return f

    def saved(self) -> bytes:
        """The trees as an array archive, which `loaded` reads."""
        out = io.BytesIO()
        parts = {f"{n}{k}": a for k, t in enumerate(self.trees) for n, a in zip("fcv", t, strict=True)} | {f"e{k}": e for k, e in enumerate(self.edges)}
        np.savez_compressed(out, base=self.base, depth=self.depth, **parts)
        return out.getvalue()

    @classmethod
    def loaded(cls, data: bytes) -> Trees:
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            n = sum(k.startswith("f") for k in z.files)
            out = cls(n, int(z["depth"]))
            out.base, out.edges = float(z["base"]), [z[f"e{k}"] for k in range(sum(x[:1] == "e" for x in z.files))]
            out.trees = [(z[f"f{k}"], z[f"c{k}"], z[f"v{k}"]) for k in range(n)]
        return out

    def _values(self, b: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.zeros(len(b), np.int64), np.arange(len(b))
        for _ in range(self.depth):
            node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        return value[node - ((1 << self.depth) - 1)]
