"""Small gradient-boosted trees for two classes: binned features, trees of one depth, Newton leaves."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """edges[f]: bin borders of a feature. feature and cut: per tree, its inner nodes in heap order; a row goes right if its
    bin is larger than the cut. leaf: per tree, what each leaf adds to the log-odds."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(self.edges)], 1).astype(np.uint8)

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        bins, out, every = self.binned(rows), np.full(len(rows), self.start), np.arange(len(rows))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (bins[every, feature[at]] > cut[at])
            out += leaf[at - len(feature)]
        return out


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, held: float = 5.0) -> Trees:
    """Fit to `rows` (floats, one column a feature) and 0/1 `labels`. `held` pulls leaves towards 0."""
    quantiles = np.linspace(0, 1, BINS)[1:-1]
    edges = [np.unique(np.quantile(rows[:, f], quantiles)) for f in range(rows.shape[1])]
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    model = Trees(edges, np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth)), float(np.log(share / (1 - share))))
    bins, odds = model.binned(rows).astype(np.int64), np.full(len(rows), model.start)
    features, cuts, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        slope, bend = labels - p, p * (1 - p)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, BINS, np.int64)
        at = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-9)
            for f in range(rows.shape[1]):
                place = (at - first) * BINS + bins[:, f]
                g = np.bincount(place, slope, count * BINS).reshape(count, BINS)
                h = np.bincount(place, bend, count * BINS).reshape(count, BINS)
                left_g, left_h = g.cumsum(1), h.cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = left_g**2 / (left_h + held) + (all_g - left_g) ** 2 / (all_h - left_h + held) - all_g**2 / (all_h + held)
                top = gain.argmax(1)
                better = np.flatnonzero(gain[np.arange(count), top] > best)
                best[better] = gain[better, top[better]]
                feature[first + better], cut[first + better] = f, top[better]
            at = 2 * at + 1 + (bins[np.arange(len(rows)), feature[at]] > cut[at])
        place = at - (2**depth - 1)
        leaf = rate * np.bincount(place, slope, 2**depth) / (np.bincount(place, bend, 2**depth) + held)
        odds += leaf[place]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    model.feature, model.cut, model.leaf = np.stack(features), np.stack(cuts), np.stack(leaves)
    return model
