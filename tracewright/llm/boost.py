"""Small gradient-boosted trees, fitted on a bounded sample and applied in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = tuple[int, float, "Tree | float", "Tree | float"]


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int, ridge: float) -> Tree | float:
    leaf = float(g.sum() / (h.sum() + ridge))
    if depth == 0 or len(g) < 20:
        return leaf
    base, best = g.sum() ** 2 / (h.sum() + ridge), None
    for j, edges in enumerate(cuts):
        if not len(edges):
            continue
        bins = np.searchsorted(edges, x[:, j], "right")
        gs, hs = np.cumsum(np.bincount(bins, g, len(edges) + 1)), np.cumsum(np.bincount(bins, h, len(edges) + 1))
        gl, hl = gs[:-1], hs[:-1]
        gain = gl**2 / (hl + ridge) + (gs[-1] - gl) ** 2 / (hs[-1] - hl + ridge) - base
        k = int(np.argmax(gain))
        if best is None or gain[k] > best[0]:
            best = (gain[k], j, float(edges[k]))
    if best is None or best[0] <= 1e-9:
        return leaf
    _, j, at = best
    low = x[:, j] < at
    if low.all() or not low.any():
        return leaf
    return (j, at, _split(x[low], g[low], h[low], cuts, depth - 1, ridge), _split(x[~low], g[~low], h[~low], cuts, depth - 1, ridge))


def _value(tree: Tree | float, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    j, at, a, b = tree
    low = x[:, j] < at
    out = np.empty(len(x))
    out[low], out[~low] = _value(a, x[low]), _value(b, x[~low])
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 2, rate: float = 0.3, ridge: float = 1.0) -> list[Tree | float]:
    """Trees of a logistic model; the first element is the constant. Needs both classes, else the constant decides."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    p = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model: list[Tree | float] = [float(np.log(p / (1 - p)))]
    if len(y) < 2 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.03, 0.97, 32))) for j in range(x.shape[1])]
    score = np.full(len(y), model[0])
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-score))
        tree = _split(x, y - prob, np.maximum(prob * (1 - prob), 1e-6), cuts, depth, ridge)
        step = _scaled(tree, rate)
        model.append(step)
        score += _value(step, x)
    return model


def _scaled(tree: Tree | float, rate: float) -> Tree | float:
    return tree * rate if isinstance(tree, float) else (tree[0], tree[1], _scaled(tree[2], rate), _scaled(tree[3], rate))


def score(model: list[Tree | float], x: np.ndarray) -> np.ndarray:
    """Log-odds of rows."""
    return sum(_value(t, np.asarray(x, float)) for t in model)


def column(model: list[Tree | float], features: Column) -> Column:
    """Log-odds of an array of features (Arrow batches); a model as a column expression would be a plan of thousands of nodes."""

    @F.pandas_udf("double")
    def run(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype="float64")
        return pd.Series(np.broadcast_to(score(model, np.stack(rows.to_numpy())), len(rows)))

    return run(features)
