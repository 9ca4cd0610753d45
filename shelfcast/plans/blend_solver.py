"""Continuous search of blend weights on the simplex, from many starts at once.

A step linearises the log error in the weights. One aggregate sums up, for every
start, the squared error, the products of the derivatives with each other and
with the error; the driver solves the small quadratic program of each start over
the simplex. A step that doesn't lower a start's error is halved and tried again,
so that no start ever gets worse. Starts are the best point of the grid, equal
weights, and seeded draws from a flat Dirichlet distribution.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STARTS, STEPS, TOLERANCE = 20, 15, 1e-9


def onto_simplex(w: np.ndarray) -> np.ndarray:
    """The nearest point with weights that are not negative and sum to 1."""
    ordered = np.sort(w)[::-1]
    over = np.cumsum(ordered) - 1
    last = np.flatnonzero(ordered - over / np.arange(1, len(w) + 1) > 0)[-1]
    return np.maximum(w - over[last] / (last + 1), 0.0)


def _best_on_simplex(gram: np.ndarray, slope: np.ndarray, w: np.ndarray, turns: int = 2000) -> np.ndarray:
    """Least of ``slope . d + d gram d / 2`` over points ``w + d`` of the simplex,
    by accelerated projected gradients."""
    reach = max(float(np.linalg.eigvalsh(gram)[-1]), 1e-12)
    at, ahead, pace = w, w, 1.0
    for _ in range(turns):
        new = onto_simplex(ahead - (slope + gram @ (ahead - w)) / reach)
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / faster * (new - at)
        if np.abs(new - at).max() < 1e-14:
            return new
        at, pace = new, faster
    return at


def drawn_starts(n: int, count: int = STARTS, seed: int = 42) -> list[list[float]]:
    """Equal weights and seeded Dirichlet(1, ..., 1) draws."""
    rng = random.Random(seed)
    out = [[1 / n] * n]
    for _ in range(count):
        x = [rng.expovariate(1.0) for _ in range(n)]
        out.append([v / sum(x) for v in x])
    return out


def _sums(df: DataFrame, label: str, preds: Sequence[str], weights: np.ndarray) -> dict[int, np.ndarray]:
    """Per start: mean squared log error, its derivatives' products with each
    other and with the error."""
    n = len(preds)
    starts = F.array(*[F.struct(F.lit(i).alias("start"), F.array(*map(F.lit, w)).alias("w"))
                       for i, w in enumerate(weights.tolist())])
    p = [F.greatest(F.col(c), F.lit(0.0)) for c in preds]
    rows = (df.select(F.col(label).alias("_y"), *[x.alias(f"_p{i}") for i, x in enumerate(p)], F.explode(starts).alias("_s"))
            .withColumn("_b", sum((F.col("_s.w")[i] * F.col(f"_p{i}") for i in range(1, n)), F.col("_s.w")[0] * F.col("_p0")))
            .withColumn("_e", F.log1p("_b") - F.log1p("_y")))
    d = [F.col(f"_p{i}") / (1 + F.col("_b")) for i in range(n)]
    aggs = [F.avg(F.col("_e") * F.col("_e"))]
    aggs += [F.avg(d[i] * F.col("_e")) for i in range(n)]
    aggs += [F.avg(d[i] * d[j]) for i in range(n) for j in range(i, n)]
    return {r[0]: np.array(r[1:], dtype=float) for r in rows.groupBy("_s.start").agg(*aggs).collect()}   # one row a start


def solve(df: DataFrame, label: str, preds: Sequence[str], starts: Sequence[Sequence[float]], steps: int = STEPS) -> list[tuple]:
    """``(rmsle, weights)`` reached from each start, in their order. Rows without
    a label are left out; a missing prediction counts as 0."""
    n = len(preds)
    df = df.filter(F.col(label).isNotNull()).fillna(0.0, list(preds))
    w = np.array([onto_simplex(np.array(s, dtype=float)) for s in starts])
    tried, size = w.copy(), np.ones(len(w))
    best = np.full(len(w), math.inf)
    aim = w.copy()
    corner = np.triu_indices(n)
    for _ in range(steps):
        going = np.flatnonzero(size > 1e-4)
        if not len(going):
            break
        sums = _sums(df, label, preds, tried[going])
        if not sums:
            return [(math.nan, x.tolist()) for x in w]
        for k, i in enumerate(going):
            error, slope = sums[k][0], sums[k][1:1 + n]
            if error < best[i]:
                done = best[i] - error < TOLERANCE * error
                gram = np.zeros((n, n))
                gram[corner] = sums[k][1 + n:]
                gram = gram + gram.T - np.diag(np.diag(gram))
                w[i], best[i] = tried[i], error
                aim[i] = _best_on_simplex(gram, slope, w[i])
                size[i] = 0.0 if done or np.abs(aim[i] - w[i]).max() < 1e-9 else 1.0
            else:
                size[i] /= 2
            tried[i] = w[i] + size[i] * (aim[i] - w[i])
    return [(math.sqrt(e), x.tolist()) for e, x in zip(best, w)]


def best_weights(df: DataFrame, label: str, preds: Sequence[str], first: Sequence[Sequence[float]] = (), count: int = STARTS,
                 seed: int = 42) -> tuple[float, list[float]]:
    """The best point reached from any start; ``first`` are tried besides the
    drawn ones. Of equal errors the earlier start's."""
    starts = [*first, *drawn_starts(len(preds), count, seed)]
    return min(solve(df, label, preds, starts), key=lambda r: r[0])
