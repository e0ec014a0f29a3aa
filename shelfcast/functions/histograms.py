"""One regularised boosted-tree fit on binned columns, for the rows of one task.

A column is a byte per row, the number of its quantile bin. A node's rows become a histogram of gradient
sums and counts per bin; every cut between bins is scored from its running sums, with an L2 penalty on
leaf weights and an L1 threshold on gradient sums. Of two children only the smaller one's histogram is
summed, the other is the difference. Squared error: a gradient is forecast minus actual, a second
derivative is 1, so the weight of a node is its number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np

from shelfcast.functions.shipping import ship_by_value

ship_by_value(__name__)

LEAST_GAIN = 1e-6
TINY = 1e-300  # no rows and no penalty


@dataclass(frozen=True)
class Settings:
    rounds: int = 500
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    least_weight: float = 5.0
    l2: float = 1.0
    l1: float = 0.1
    bins: int = 256
    seed: int = 42


@dataclass(frozen=True)
class Forest:
    """Trees as complete binary trees, one row each: the children of node i are 2i + 1 and 2i + 2. A node
    with feature -1 is a leaf; rows whose bin is above ``cut`` go right."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray


def shrunk(gradient: np.ndarray, l1: float) -> np.ndarray:
    return gradient - np.clip(gradient, -l1, l1)


def score(gradient: np.ndarray, weight: np.ndarray, settings: Settings) -> np.ndarray:
    return shrunk(gradient, settings.l1) ** 2 / np.maximum(weight + settings.l2, TINY)


def _histograms(columns, chosen, rows, slot, gradient, slots: int, bins: int) -> np.ndarray:
    """(2, slots, columns, bins): gradient sums and counts of the rows, which belong to ``slot``."""
    out = np.empty((2, slots, len(chosen), bins))
    at = slot * bins
    for i, c in enumerate(chosen):
        place = at + columns[c][rows]
        out[0, :, i] = np.bincount(place, gradient, slots * bins).reshape(slots, bins)
        out[1, :, i] = np.bincount(place, None, slots * bins).reshape(slots, bins)
    return out


def best_cuts(histograms: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, column, bin) of the best cut of every node: rows up to that bin go left."""
    left, counts = np.cumsum(histograms, axis=3)
    gradient, weight = left[:, :1, -1:], counts[:, :1, -1:]
    left, counts = left[:, :, :-1], counts[:, :, :-1]
    gain = score(left, counts, settings)
    gain += score(gradient - left, weight - counts, settings)
    gain -= score(gradient, weight, settings)
    gain[(counts < settings.least_weight) | (weight - counts < settings.least_weight)] = -np.inf
    gain = gain.reshape(len(gain), -1)
    best = gain.argmax(axis=1)
    column, cut = np.divmod(best, left.shape[2])
    return gain[np.arange(len(best)), best], column, cut


def _tree(columns, chosen, rows, gradient, settings: Settings):
    """(feature, cut, value, gain) of one tree on the given rows."""
    nodes = (2 << settings.depth) - 1
    feature, cut = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8)
    value, gains = np.zeros(nodes), np.zeros(nodes)
    slot = np.zeros(len(rows), np.int64)
    own = gradient[rows]
    histograms = _histograms(columns, chosen, rows, slot, own, 1, settings.bins)
    level = np.zeros(1, np.int64)  # tree node of each slot
    for depth in range(settings.depth + 1):
        gradients, weights = histograms[:, :, 0].sum(axis=2)
        value[level] = -settings.rate * shrunk(gradients, settings.l1) / np.maximum(weights + settings.l2, TINY)
        if depth == settings.depth:
            break
        gain, column, at = best_cuts(histograms, settings)
        split = gain > LEAST_GAIN
        if not split.any():
            break
        feature[level[split]] = chosen[column[split]]
        cut[level[split]], gains[level[split]] = at[split], gain[split]
        stays = split[slot]
        rows, slot, own = rows[stays], slot[stays], own[stays]
        right = np.empty(len(rows), bool)
        for c in np.unique(column[split]):
            here = column[slot] == c
            right[here] = columns[chosen[c]][rows[here]] > at[slot[here]]
        parent = np.flatnonzero(split)
        renamed = np.full(len(split), -1, np.int64)
        renamed[parent] = np.arange(len(parent))
        slot = 2 * renamed[slot] + right
        level = (2 * level[parent][:, None] + np.array([1, 2])).ravel()
        if depth + 1 == settings.depth:  # leaves need their sums alone
            histograms = np.empty((2, 2 * len(parent), 1, 1))
            histograms[0, :, 0, 0] = np.bincount(slot, own, 2 * len(parent))
            histograms[1, :, 0, 0] = np.bincount(slot, None, 2 * len(parent))
            continue
        count = np.bincount(slot, None, 2 * len(parent)).reshape(-1, 2)
        small = (count[:, 1] < count[:, 0]).astype(np.int64)
        summed = slot % 2 == small[slot // 2]
        before = histograms[:, parent]
        histograms = np.empty((2, 2 * len(parent), *before.shape[2:]))
        part = _histograms(columns, chosen, rows[summed], slot[summed] // 2, own[summed], len(parent), settings.bins)
        pairs = np.arange(len(parent))
        histograms[:, 2 * pairs + small] = part
        histograms[:, 2 * pairs + 1 - small] = np.subtract(before, part, out=before)
    return feature, cut, value, gains


def tree_outputs(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int):
    """The tree's value for every row of ``columns`` (columns x rows)."""
    node = np.zeros(columns.shape[1], np.int64)
    every = np.arange(columns.shape[1])
    for _ in range(depth):
        own = feature[node]
        inner = own >= 0
        right = columns[np.maximum(own, 0), every] > cut[node]
        node = np.where(inner, 2 * node + 1 + right, node)
    return value[node]


def boost(columns: np.ndarray, actual: np.ndarray, settings: Settings, stream: int = 0) -> Forest:
    """Fit on binned ``columns`` (columns x rows). The draws of rows and columns depend on the seed, the
    ``stream`` and the round alone."""
    base = float(actual.mean()) if len(actual) else 0.0
    settings = replace(settings, bins=min(settings.bins, max(2, int(columns.max(initial=0)) + 1)))
    forecast = np.full(len(actual), base)
    per_tree = max(1, int(round(settings.column_share * len(columns))))
    trees = []
    for turn in range(settings.rounds):
        draw = np.random.default_rng([settings.seed, stream, turn])
        rows = np.flatnonzero(draw.random(len(actual)) < settings.row_share)
        chosen = np.sort(draw.permutation(len(columns))[:per_tree])
        trees.append(_tree(columns, chosen, rows, forecast - actual, settings))
        forecast += tree_outputs(columns, *trees[-1][:3], settings.depth)
    nodes = (2 << settings.depth) - 1
    kinds = (np.int16, np.uint8, np.float64, np.float64)
    parts = [np.array([t[i] for t in trees], kind).reshape(-1, nodes) for i, kind in enumerate(kinds)]
    return Forest(base, *parts)
