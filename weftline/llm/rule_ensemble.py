"""Sparse rule ensemble: rules are the paths of boosted trees, weights come from a lasso logistic fit.

A rule is a conjunction of thresholds on statistics. The weighted rules are compiled into one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.llm.decision_list import Condition, covered

TREES = 60
DEPTH = 3
BINS = 40
LEARNING_RATE = 0.2
LEAF_ROWS = 5
STEPS = 400
#: Lasso penalty per row; larger keeps fewer rules.
PENALTY = 0.0015


@dataclass
class RuleEnsemble:
    bias: float
    rules: list[tuple[list[Condition], float]]

    def score(self, x: dict[str, Column]) -> Column:
        """Probability of label 1."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            fires = rule[0].column(x)
            for condition in rule[1:]:
                fires = fires & condition.column(x)
            total = total + F.when(fires, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: dict[str, np.ndarray]) -> np.ndarray:
        total = np.full(len(next(iter(x.values()))), self.bias)
        for rule, weight in self.rules:
            total += weight * covered(rule, x)
        return 1 / (1 + np.exp(-total))


def split(x: dict[str, np.ndarray], rest: np.ndarray, rows: np.ndarray, edges: dict[str, np.ndarray]) -> Condition | None:
    best, gain = None, 1e-9
    total, n = rest[rows].sum(), len(rows)
    for name, points in edges.items():
        at = np.searchsorted(points, x[name][rows], "left")  # v <= points[k] puts v in bins 0..k
        sums = np.cumsum(np.bincount(at, rest[rows], len(points) + 1))[:-1]
        counts = np.cumsum(np.bincount(at, minlength=len(points) + 1))[:-1]
        fine = (counts >= LEAF_ROWS) & (n - counts >= LEAF_ROWS)
        if fine.any():
            won = np.where(fine, sums**2 / np.maximum(counts, 1) + (total - sums)**2 / np.maximum(n - counts, 1), -1.0)
            k = int(won.argmax())
            if won[k] - total**2 / n > gain:
                best, gain = Condition(name, False, float(points[k])), won[k] - total**2 / n
    return best


def paths(x: dict[str, np.ndarray], rest: np.ndarray, prob: np.ndarray, edges: dict[str, np.ndarray]):
    """Grow one tree on the residuals; returns its paths below the root and the values of its leaves."""
    found, leaves = [], []
    todo = [(np.arange(len(rest)), [])]
    while todo:
        rows, path = todo.pop()
        cut = split(x, rest, rows, edges) if len(path) < DEPTH else None
        if cut is None:
            curve = (prob[rows] * (1 - prob[rows])).sum()
            leaves.append((rows, rest[rows].sum() / max(curve, 1e-3)))
            continue
        below = x[cut.name][rows] <= cut.threshold
        for side, above in ((rows[below], False), (rows[~below], True)):
            longer = [*path, Condition(cut.name, above, cut.threshold)]
            found.append(longer)
            todo.append((side, longer))
    return found, leaves


def lasso(hits: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Logistic loss with an L1 penalty on all weights but the bias, by accelerated proximal gradient steps."""
    n = len(y)
    share = hits.mean(axis=0)
    scale = np.sqrt(np.maximum(share * (1 - share), 1e-4)).astype(np.float32)
    z = ((hits - share) / scale).astype(np.float32)
    v = np.random.default_rng(5).normal(size=z.shape[1]).astype(np.float32)
    for _ in range(20):  # the largest eigenvalue of the curvature bounds the step
        v = z.T @ (z @ v)
        size = float(np.linalg.norm(v)) or 1.0
        v /= size
    step = 1.0 / (0.25 * (size / n + 1))
    bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    w = np.zeros(z.shape[1], np.float32)
    look_w, look_b, t = w.copy(), bias, 1.0
    for _ in range(STEPS):
        rest = 1 / (1 + np.exp(-(z @ look_w + look_b))) - y
        new = look_w - step * (z.T @ rest.astype(np.float32)) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = look_b - step * float(rest.mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w, look_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - bias)
        w, bias, t = new, new_b, t_new
    plain = w / scale
    return float(bias - (plain * share).sum()), plain


def learn(x: dict[str, np.ndarray], y: np.ndarray, penalty: float = PENALTY) -> RuleEnsemble:
    """Fit to labels 0/1. With no rows the score is 0.5 for all; with one class it is near that class for all."""
    if not len(y):
        return RuleEnsemble(0.0, [])
    p = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(p / (1 - p)))
    edges = {k: np.unique(np.quantile(v, np.linspace(0, 1, BINS)))[:-1] for k, v in sorted(x.items())}
    for k, v in x.items():  # thresholds lie between the values seen, with room on both sides
        values = np.unique(v)
        at = np.searchsorted(values, edges[k], "right").clip(max=len(values) - 1)
        edges[k] = np.unique((edges[k] + values[at]) / 2)
    margin = np.full(len(y), bias)
    rules: dict[tuple[Condition, ...], np.ndarray] = {}
    for _ in range(TREES):
        prob = 1 / (1 + np.exp(-margin))
        found, leaves = paths(x, y - prob, prob, edges)
        for rows, value in leaves:
            margin[rows] += LEARNING_RATE * np.clip(value, -4, 4)
        for path in found:
            rules.setdefault(tuple(path), covered(path, x))
    distinct: dict[bytes, tuple[Condition, ...]] = {}
    for rule, hit in rules.items():
        if 0 < hit.sum() < len(hit):
            distinct.setdefault(np.packbits(hit).tobytes(), rule)
    kept = list(distinct.values())
    if not kept:
        return RuleEnsemble(bias, [])
    hits = np.stack([rules[r] for r in kept], axis=1)
    bias, weights = lasso(hits, y.astype(np.float64), penalty)
    order = np.argsort(-np.abs(weights), kind="stable")
    return RuleEnsemble(bias, [(list(kept[i]), float(weights[i])) for i in order if abs(weights[i]) > 1e-6])
