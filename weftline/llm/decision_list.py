"""Learned decision lists: sequential covering of the low-quality rows by threshold conjunctions.

One rule is grown at a time on two thirds of the rows still uncovered (the condition with the largest gain is added until
no high-quality row is covered), then pruned on the last third, then put at the end of the list. Learning stops when a
pruned rule is no longer precise. The list is compiled to an ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_RULES = 24
MAX_CONDITIONS = 4
THRESHOLDS = 48
MIN_PRECISION = 0.8
MIN_COVER = 3


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.threshold if self.above else x[self.name] <= self.threshold

    def column(self, x: dict[str, Column]) -> Column:
        return x[self.name] > F.lit(self.threshold) if self.above else x[self.name] <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    rules: list[list[Condition]] = field(default_factory=list)
    precisions: list[float] = field(default_factory=list)

    def verdict(self, x: dict[str, Column]) -> Column:
        """False where a rule fires (the first one decides), else true."""
        chain = F
        for rule in self.rules:
            fires = rule[0].column(x)
            for condition in rule[1:]:
                fires = fires & condition.column(x)
            chain = chain.when(fires, F.lit(False))
        return chain.otherwise(F.lit(True)) if self.rules else F.lit(True)

    def rejects(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(next(iter(x.values()))), bool)
        for rule in self.rules:
            out |= covered(rule, x)
        return out

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}  # {p:.3f}"
                         for r, p in zip(self.rules, self.precisions, strict=True))


def covered(rule: list[Condition], x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def cuts(values: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Candidate thresholds: halfway between neighbouring quantiles of the rows and of the bad rows alone."""
    points = np.unique(np.concatenate([np.quantile(v, np.linspace(0, 1, THRESHOLDS)) for v in (values, bad) if len(v)]))
    return (points[1:] + points[:-1]) / 2


def best_condition(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Condition | None:
    p0, n0 = int(bad[rows].sum()), int((~bad[rows]).sum())
    if not p0 or not n0:
        return None
    best, gain = None, 0.0
    base = np.log2(p0 / (p0 + n0))
    for name in sorted(x):
        v = x[name][rows]
        order = np.argsort(v, kind="stable")
        ordered, ranks = v[order], np.concatenate([[0], np.cumsum(bad[rows][order])])
        for cut in cuts(v, v[bad[rows]]):
            below = int(np.searchsorted(ordered, cut, "right"))
            for above, total, p in ((False, below, ranks[below]), (True, len(v) - below, p0 - ranks[below])):
                if p >= MIN_COVER or p == p0:
                    won = p * (np.log2(max(p, 1e-9) / max(total, 1)) - base) if p else 0.0
                    if won > gain + 1e-12:
                        best, gain = Condition(name, above, float(cut)), won
    return best


def prune(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> list[Condition]:
    """The leading conditions that separate best on rows the rule was not grown on."""
    part = {k: v[rows] for k, v in x.items()}
    best, worth = rule, -2.0
    for size in range(len(rule), 0, -1):
        hit = covered(rule[:size], part)
        p, n = int((hit & bad[rows]).sum()), int((hit & ~bad[rows]).sum())
        value = (p - n) / (p + n) if p + n else -1.5
        if value >= worth:
            best, worth = rule[:size], value
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7) -> DecisionList:
    """Rows with ``bad`` true are to be rejected. Without rows, or with one class only, the list is empty."""
    out = DecisionList()
    if not len(bad) or bad.all():
        return out
    left = np.arange(len(bad))
    rng = np.random.default_rng(seed)
    while len(out.rules) < MAX_RULES and bad[left].sum() >= MIN_COVER:
        mixed = rng.permutation(left)
        grow_rows, prune_rows = mixed[len(mixed) // 3:], mixed[:len(mixed) // 3]
        rule: list[Condition] = []
        inside = grow_rows
        while len(rule) < MAX_CONDITIONS and (~bad[inside]).any():
            condition = best_condition(x, bad, inside)
            if condition is None:
                break
            rule.append(condition)
            inside = inside[condition.holds({k: v[inside] for k, v in x.items()})]
        if not rule:
            break
        rule = prune(rule, x, bad, prune_rows)
        hit = covered(rule, {k: v[left] for k, v in x.items()})
        p, n = int((hit & bad[left]).sum()), int((hit & ~bad[left]).sum())
        if p < MIN_COVER or p / (p + n) < MIN_PRECISION:
            break
        out.rules.append(rule)
        out.precisions.append(p / (p + n))
        left = left[~hit]
    return out
