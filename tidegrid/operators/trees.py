"""Regression models small enough to fit one sensor's rows inside a Python worker: boosted trees, forests, nearest rows.

Trees are grown level by level on binned features: one count of (node, feature, bin) gives all gains of a level. A tree is
stored as a full heap, so that prediction takes ``depth`` steps for all rows and trees at once.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

K = 5


@dataclass(frozen=True)
class Setting:
    """How an ensemble grows: boosted if ``rate`` is set, else a forest of bootstrap samples."""

    rounds: int = 100
    depth: int = 5
    rate: float | None = 0.05
    rows: float = 0.8
    columns: float = 0.8
    penalty: float = 1.0
    least: int = 1
    bins: int = 128


#: Names as in a profile's models. Rounds, depth, rate and shares are fixed values.
SETTINGS = {
    "xgb": Setting(),
    "lgbm": Setting(rows=1.0, columns=0.8, penalty=0.0, least=20, bins=255),
    "rf": Setting(depth=10, rate=None, rows=1.0, columns=1.0, penalty=0.0, bins=64),
}


def _grow(b: np.ndarray, y: np.ndarray, s: Setting, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, last bin that goes left, value) of the nodes of one tree on binned rows b; a node without a split sends all rows left."""
    n, width = b.shape
    size = 2 ** (s.depth + 1) - 1
    feature, cut, value = np.zeros(size, np.int16), np.full(size, s.bins, np.int16), np.zeros(size)
    node = np.zeros(n, np.int64)
    offset = np.arange(width) * s.bins
    for level in range(s.depth + 1):
        ids, at = np.unique(node, return_inverse=True)
        count, total = np.bincount(at), np.bincount(at, y)
        value[ids] = total / (count + s.penalty)
        if level == s.depth:
            break
        cell = (at[:, None] * (width * s.bins) + offset + b).ravel()
        shape = (len(ids), width, s.bins)
        left = np.bincount(cell, minlength=len(ids) * width * s.bins).reshape(shape).cumsum(axis=2)
        below = np.bincount(cell, np.repeat(y, width), minlength=len(ids) * width * s.bins).reshape(shape).cumsum(axis=2)
        right, above = count[:, None, None] - left, total[:, None, None] - below
        gain = below**2 / np.maximum(left + s.penalty, 1e-9) + above**2 / np.maximum(right + s.penalty, 1e-9)
        gain[(left < s.least) | (right < s.least)] = -1.0
        gain[:, ~columns] = -1.0
        gain = gain.reshape(len(ids), -1)
        best = gain.argmax(axis=1)
        better = gain[np.arange(len(ids)), best] > (total**2 / (count + s.penalty)) * (1 + 1e-9) + 1e-12
        f, k = best // s.bins, best % s.bins
        feature[ids[better]], cut[ids[better]] = f[better], k[better]
        goes = better[at] & (b[np.arange(n), f[at]] > k[at])
        node = 2 * node + 1 + goes
    return feature, cut, value


class Trees:
    """A fitted ensemble."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, base: float):
        self.feature, self.threshold, self.value, self.base = feature, threshold, value, base
        self.depth = (feature.shape[1] + 1).bit_length() - 2

    def predict(self, q: np.ndarray) -> np.ndarray:
        out, tree = np.empty(len(q)), np.arange(len(self.feature))
        for s in range(0, len(q), 1024):
            x = q[s : s + 1024].astype(np.float32)
            at, rows = np.zeros((len(x), len(tree)), np.int64), np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.threshold[tree, at])
            out[s : s + 1024] = self.value[tree, at].sum(axis=1) + self.base
        return out

    def arrays(self) -> dict:
        return {"feature": self.feature, "threshold": self.threshold, "value": self.value, "base": np.array(self.base)}


def fit_trees(x: np.ndarray, y: np.ndarray, s: Setting, seed: int = 42) -> Trees:
    rng, x = np.random.default_rng(seed), x.astype(np.float32)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, s.bins + 1)[1:-1], method="lower")) for c in x.T]
    b = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    wide = np.full((x.shape[1], s.bins + 1), np.inf, np.float32)  # past the last edge all goes left
    for k, e in enumerate(edges):
        wide[k, : len(e)] = e
    n, width = x.shape
    base = float(y.mean()) if s.rate else 0.0
    score, out = np.full(n, base), []
    for _ in range(s.rounds):
        columns = np.zeros(width, bool)
        columns[rng.choice(width, max(1, round(s.columns * width)), replace=False)] = True
        if s.rate is None:
            rows = rng.integers(0, n, n)
        else:
            rows = np.sort(rng.choice(n, max(1, round(s.rows * n)), replace=False)) if s.rows < 1 else np.arange(n)
        feature, cut, value = _grow(b[rows], y[rows] - score[rows] if s.rate else y[rows], s, columns)
        threshold = wide[feature, cut]
        one = Trees(feature[None], threshold[None], (value * (s.rate or 1 / s.rounds))[None].astype(np.float32), 0.0)
        out.append(one)
        if s.rate:
            score = score + one.predict(x)
    return Trees(*(np.concatenate([getattr(t, k) for t in out]) for k in ("feature", "threshold", "value")), base)


class Nearest:
    """Mean of the k nearest training rows by plain Euclidean distance; equal distances go to the earlier row."""

    def __init__(self, x: np.ndarray, y: np.ndarray, k: int = K):
        self.x, self.y, self.k = x, y, k

    def predict(self, q: np.ndarray) -> np.ndarray:
        out, k = np.empty(len(q)), min(self.k, len(self.x))
        for s in range(0, len(q), 256):
            d = np.zeros((len(q[s : s + 256]), len(self.x)))
            for c in range(self.x.shape[1]):
                d += (q[s : s + 256, c][:, None] - self.x[None, :, c]) ** 2
            near = d <= np.partition(d, k - 1, axis=1)[:, k - 1 : k]
            for i in np.flatnonzero(near.sum(axis=1) > k).tolist():  # ties at the last place
                near[i] = False
                near[i, np.argsort(d[i], kind="stable")[:k]] = True
            out[s : s + 256] = self.y[np.nonzero(near)[1]].reshape(len(near), k).mean(axis=1)
        return out

    def arrays(self) -> dict:
        return {"x": self.x, "y": self.y, "k": np.array(self.k)}


def fit(name: str, x: np.ndarray, y: np.ndarray, rounds: int | None = None):
    """The model of a name (xgb, lgbm, rf, knn) on rows x; ``rounds`` replaces the setting's."""
    if name == "knn":
        return Nearest(x, y)
    s = SETTINGS[name]
    return fit_trees(x, y, s if rounds is None else Setting(**{**s.__dict__, "rounds": rounds}))


def to_bytes(model: Trees | Nearest) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **model.arrays())
    return out.getvalue()


def from_bytes(blob: bytes) -> Trees | Nearest:
    with np.load(io.BytesIO(blob)) as a:
        return Nearest(a["x"], a["y"], int(a["k"])) if "x" in a else Trees(a["feature"], a["threshold"], a["value"], float(a["base"]))
