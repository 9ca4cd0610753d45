"""Parameter search: proposals from past trials, and GLM fits in shared scans.

* ``Parzen``: tree-structured Parzen estimator. Past trials are split into the
  best and the rest; for each parameter, both get a density (normal kernels
  around their values and one as wide as the space). Candidates are drawn from
  the density of the best, and the one with the largest ratio of both densities
  is proposed. Proposals of a batch that have no score yet count among the rest,
  so that a batch doesn't repeat itself. Everything follows from the seed.
* ``shared_fits``: Tweedie GLMs with log link of many (trial, fold) pairs at
  once. A step of iteratively reweighted least squares needs, for each pair, the
  weighted Gram matrix of the features and the weighted sums with the working
  response. One scan adds them up for all pairs: tasks multiply blocks of rows,
  Spark adds the matrices up by pair, and the driver solves ``trials x folds``
  systems as wide as the features. A search costs as many scans as steps.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import map_arrow

STEPS, TOLERANCE = 15, 1e-6
ETA_LIMIT = 30.0           # of the linear predictor: exp() of more is no forecast


@dataclass(frozen=True)
class Uniform:
    """A parameter between two bounds, on a log scale if asked for."""
    low: float
    high: float
    log: bool = False
    whole: bool = False

    def inner(self, x: float) -> float:
        return math.log(x) if self.log else float(x)

    def outer(self, x: float) -> float:
        x = min(max(x, self.inner(self.low)), self.inner(self.high))
        x = math.exp(x) if self.log else x
        return int(min(max(round(x), self.low), self.high)) if self.whole else min(max(x, self.low), self.high)


def _kernels(centres: Sequence[float], low: float, high: float) -> list[tuple[float, float]]:
    """Centres and widths of normal kernels: as wide as the larger gap to their
    neighbours (the bounds are neighbours, too), and one over the whole space."""
    places = sorted(centres)
    least = (high - low) / min(100, 1 + len(places))
    out = [((low + high) / 2, high - low)]
    for i, c in enumerate(places):
        left = c - (places[i - 1] if i else low)
        right = (places[i + 1] if i + 1 < len(places) else high) - c
        out.append((c, min(max(left, right, least), high - low)))
    return out


def _density(x: float, kernels: list[tuple[float, float]], low: float, high: float) -> float:
    """Mean of the kernels' densities, each cut off at the bounds."""
    total = 0.0
    for c, wide in kernels:
        inside = 0.5 * (math.erf((high - c) / wide / math.sqrt(2)) - math.erf((low - c) / wide / math.sqrt(2)))
        total += math.exp(-0.5 * ((x - c) / wide) ** 2) / (wide * math.sqrt(2 * math.pi) * max(inside, 1e-12))
    return total / len(kernels)


@dataclass
class Parzen:
    """Seeded search: ``ask`` for parameters, ``tell`` their scores (less is better)."""
    space: dict[str, Uniform]
    seed: int
    start: int = 10            # random trials before any density is used
    candidates: int = 24
    best_share: float = 0.1
    told: list[tuple[dict, float]] = field(default_factory=list)
    asked: list[dict] = field(default_factory=list)

    def __post_init__(self):
        self.rng = random.Random(self.seed)

    def ask(self) -> dict:
        done = len(self.told) + len(self.asked)
        if done < self.start or not self.told:
            out = {k: u.outer(self.rng.uniform(u.inner(u.low), u.inner(u.high))) for k, u in self.space.items()}
        else:
            ranked = sorted(range(len(self.told)), key=lambda i: (self.told[i][1], i))
            n = max(1, math.ceil(self.best_share * len(ranked)))
            best = [self.told[i][0] for i in ranked[:n]]
            rest = [self.told[i][0] for i in ranked[n:]] + self.asked
            out = {k: self._drawn(k, u, best, rest) for k, u in self.space.items()}
        self.asked.append(out)
        return out

    def _drawn(self, name: str, u: Uniform, best: list[dict], rest: list[dict]) -> float:
        low, high = u.inner(u.low), u.inner(u.high)
        good, bad = (_kernels([u.inner(p[name]) for p in ps], low, high) for ps in (best, rest))
        found = None
        for _ in range(self.candidates):
            x = math.inf
            while not low <= x <= high:
                x = self.rng.gauss(*self.rng.choice(good))
            ratio = _density(x, good, low, high) / _density(x, bad, low, high)
            if found is None or ratio > found[0]:
                found = ratio, x
        return u.outer(found[1])

    def tell(self, params: dict, score: float) -> None:
        """A score that isn't a number counts as the worst."""
        self.asked.remove(params)
        self.told.append((params, score if math.isfinite(score) else math.inf))


def fold_flags(max_date: Column, folds: int, val_days: int = 16, gap: int = 16) -> list[Column]:
    """For each fold 1 (training row), 2 (validation row) or 0."""
    out = []
    for f in range(folds):
        end = F.date_sub(max_date, val_days * f)
        begin = F.date_sub(end, val_days - 1)
        out.append(F.when(F.col("date") <= F.date_sub(begin, gap), 1).when(F.col("date").between(begin, end), 2)
                   .otherwise(0).cast("int"))
    return out


def _block(batch: pa.RecordBatch, width: int, folds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, label and fold flags of a batch; what is missing is 0."""
    numbers = [np.nan_to_num(batch.column(i).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
               for i in range(width + 1)]
    flags = [batch.column(width + 1 + f).to_numpy(zero_copy_only=False) for f in range(folds)]
    return np.stack(numbers[:width], 1), numbers[width], np.stack(flags, 1)


def _scales(rows: DataFrame, features: Sequence[str], folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of the features over each fold's training rows."""
    aggs = []
    for f in range(folds):
        for c in features:
            x = F.when(F.col(f"_fold{f}") == 1, F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)))
            aggs += [F.avg(x), F.stddev_samp(x)]
    values = np.array([math.nan if v is None else v for v in rows.agg(*aggs).first()], dtype=float).reshape(folds, len(features), 2)
    values = np.nan_to_num(values)
    # a constant feature says nothing
    return values[..., 0], np.where(values[..., 1] > 0, values[..., 1], np.inf)


def _added(df: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Arrays added up by pair: in Spark, then one array a pair at the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for pair, row in zip(batch.column(0).to_pylist(), values):
                sums[pair] = sums[pair] + row if pair in sums else row.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()),
                                              pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["pair", "sums"])

    dealt = df.repartition(df.sparkSession.sparkContext.defaultParallelism, "pair")
    out = map_arrow(dealt, add, "pair long, sums array<double>")
    return {r[0]: np.array(r[1]) for r in out.collect()}


def shared_fits(rows: DataFrame, features: Sequence[str], params: Sequence[dict], folds: int, label: str = "sales",
                steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (intercept first, in terms of the standardised features of the
    fold) of every (trial, fold) and the RMSLE on the fold's validation rows.

    ``rows`` holds the features, the label and ``_fold0``...; ``params`` a
    ``power`` and a ``reg`` for each trial. A fit that diverges scores nan.
    """
    features = list(features)
    width, trials = len(features) + 1, len(params)
    power = np.array([p["power"] for p in params])
    reg = np.array([p["reg"] for p in params])
    slim = rows.select(*features, label, *[f"_fold{f}" for f in range(folds)])
    mean, scale = _scales(slim, features, folds)
    coef = np.zeros((trials, folds, width))
    going = np.ones((trials, folds), dtype=bool)
    failed = np.zeros((trials, folds), dtype=bool)
    first = True

    def design(x: np.ndarray, f: int) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), (x - mean[f]) / scale[f]], 1)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((trials, folds, width * width + width + 1))
        for batch in batches:
            x, y, flags = _block(batch, width - 1, folds)
            for f in range(folds):
                mine = flags[:, f] == 1
                if not mine.any() or not going[:, f].any():
                    continue
                d, own = design(x[mine], f), y[mine]
                for t in np.flatnonzero(going[:, f]):
                    if first:                       # from the labels, a little above 0
                        mu = np.maximum(own, 0.1)
                        eta = np.log(mu)
                    else:
                        eta = np.clip(d @ coef[t, f], -ETA_LIMIT, ETA_LIMIT)
                        mu = np.exp(eta)
                    w = mu ** (2 - power[t])
                    z = eta + (own - mu) / mu
                    weighted = d * w[:, None]
                    sums[t, f] += np.concatenate([(weighted.T @ d).reshape(-1), weighted.T @ z, [w.sum()]])
        pairs = np.flatnonzero(going.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(
            sums.reshape(trials * folds, -1)[pairs].tolist(), pa.list_(pa.float64()))], names=["pair", "sums"])

    for _ in range(steps):
        got = _added(map_arrow(slim, grams, "pair long, sums array<double>"), width * width + width + 1)
        for pair, total in got.items():
            t, f = divmod(pair, folds)
            weight = total[-1]
            new = None
            if np.isfinite(total).all() and weight > 0:
                gram = total[:width * width].reshape(width, width) / weight
                gram[np.arange(1, width), np.arange(1, width)] += reg[t]
                new = np.linalg.lstsq(gram, total[width * width:-1] / weight, rcond=None)[0]
            if new is None or not np.isfinite(new).all():
                failed[t, f], going[t, f] = True, False
                continue
            moved = np.abs(new - coef[t, f]).max() / max(1.0, np.abs(new).max())
            coef[t, f] = new
            going[t, f] = moved > TOLERANCE
        first = False
        if not going.any():
            break

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((trials, folds, 2))
        for batch in batches:
            x, y, flags = _block(batch, width - 1, folds)
            for f in range(folds):
                mine = flags[:, f] == 2
                if not mine.any():
                    continue
                p = np.exp(np.clip(design(x[mine], f) @ coef[:, f].T, -ETA_LIMIT, ETA_LIMIT))
                off = np.log1p(p) - np.log1p(y[mine])[:, None]
                sums[:, f, 0] += (off ** 2).sum(0)
                sums[:, f, 1] += mine.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trials * folds), pa.int64()), pa.array(
            sums.reshape(trials * folds, 2).tolist(), pa.list_(pa.float64()))], names=["pair", "sums"])

    got = _added(map_arrow(slim, errors, "pair long, sums array<double>"), 2)
    score = np.full((trials, folds), math.nan)
    for pair, (error, n) in got.items():
        t, f = divmod(pair, folds)
        if n > 0 and not failed[t, f]:
            score[t, f] = math.sqrt(error / n)
    return coef, score
