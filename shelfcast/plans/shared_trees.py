"""Boosted regression trees of many (trial, fold) pairs, grown together.

All pairs grow the same level of the same tree in one job. Rows of a fold are
dealt into blocks of their bins (one byte or two a feature); a task holds one
block and the scores of a group of trials on it. For each pair it adds up, over
the open nodes, how many rows each bin has and what their residuals sum to;
Spark brings the sums of a pair together, a task picks the best split of each
node, and only the splits reach the driver. After a tree, the scores move on.

The model is that of ``GBTRegressor`` with squared error: the first tree counts
fully, later ones by ``step``, and fit twice the residual; a tree learns from a
sample of the rows; a split is the largest fall of the variance that leaves
``min_instances`` rows on both sides; categories are ordered by their mean.
Samples follow from the rows' keys and the number of the tree.

A count and a sum are added up in one number: each row adds a power of two
larger than any sum, plus its residual, rounded so that no sum is rounded (to
about a 2 ** -18th of the largest residual of a block of 65,536 rows).
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage, map_arrow

BLOCK = 1 << 16            # rows of a block, about
LEAST_GAIN = 1e-12         # fall of the variance


@dataclass
class Layout:
    """Bins of a fold: thresholds of the numbers, sizes of the categories."""
    cuts: list[np.ndarray]
    sizes: list[int]

    @property
    def widths(self) -> list[int]:
        return [len(c) + 1 for c in self.cuts] + self.sizes


@dataclass
class Grown:
    """A tree by heap number (the root is 1): the feature (-1: a leaf), which bins
    go left, and the mean of the node's rows."""
    feature: np.ndarray
    left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int, bins: int) -> "Grown":
        return cls(np.full(2 << depth, -1, np.int32), np.zeros((1 << depth, bins), bool), np.zeros(2 << depth))

    def places(self, codes: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """Heap numbers of the nodes the rows are in after so many levels."""
        node = np.ones(len(rows), np.int64)
        flat, n, bins = codes.reshape(-1), codes.shape[1], self.left.shape[1]
        table = self.left.reshape(-1)
        for level in range(levels):
            feature = self.feature[node]
            if level and (feature < 0).any():
                go = np.flatnonzero(feature >= 0)
                at, f = node[go], feature[go].astype(np.int64)
                node[go] = 2 * at + ~table[at * bins + flat[f * n + rows[go]]]
            elif feature.size and feature[0] >= 0:
                node = 2 * node + ~table[node * bins + flat[feature.astype(np.int64) * n + rows]]
        return node


def cuts_of(values: Sequence[float] | None, quantiles: Sequence[float] | None, bins: int) -> np.ndarray:
    """Thresholds of a feature: between all its values if they are at most ``bins``, else its quantiles."""
    if values is not None:
        v = np.array(sorted(values), dtype=float)
        if len(v) <= bins:
            return (v[:-1] + v[1:]) / 2 if len(v) else v
        quantiles = v[[len(v) * i // bins for i in range(1, bins)]]
    return np.unique(np.array(quantiles, dtype=float))


def layout_of(train: DataFrame, numbers: Sequence[str], sizes: list[int], bins: int) -> Layout:
    """Thresholds over all training rows of a fold."""
    x = {c: F.col(c).cast("double") for c in numbers}
    about = train.agg(*[F.approx_count_distinct(x[c], 0.05) for c in numbers]).first()
    few = {c for c, n in zip(numbers, about) if n <= 1.5 * bins}
    shares = [i / bins for i in range(1, bins)]
    got = train.agg(*[F.collect_set(x[c]) if c in few else F.lit(None) for c in numbers],
                    *[F.lit(None) if c in few else F.percentile_approx(x[c], shares, 20 * bins) for c in numbers]).first()
    k = len(numbers)
    return Layout([cuts_of(got[i], got[k + i], bins) for i in range(k)], sizes)


def _coded(rows: DataFrame, layout: Layout, numbers: Sequence[str], indexed: Sequence[str], fold: int, parts: int) -> DataFrame:
    """Blocks of a fold's rows (``_role`` 1: training, 2: validation), one a partition."""
    kind = np.uint8 if max(layout.widths) <= 256 else np.uint16

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, rest = [], []
        for batch in batches:
            columns = [batch.column(i).cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
                       for i in range(len(numbers) + len(indexed))]
            if not all(np.isfinite(c).all() for c in columns):
                raise ValueError("features must be finite numbers")
            codes.append(np.stack([np.searchsorted(layout.cuts[i], c).astype(kind) if i < len(numbers) else c.astype(kind)
                                   for i, c in enumerate(columns)]))
            rest.append([batch.column(batch.num_columns - 3 + i).to_numpy(zero_copy_only=False) for i in range(3)])
        if codes:
            role, label, key = (np.concatenate(c) for c in zip(*rest))
            held = pickle.dumps((np.concatenate(codes, 1), role, label, key.view(np.uint64)), 5)
            yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([held], pa.binary())], names=["fold", "block"])

    slim = rows.select(*numbers, *indexed, "_role", "_label", "_key")
    return map_arrow(slim.repartition(parts), pack, "fold int, block binary")


def drawn(key: np.ndarray, seed: int, number: int) -> np.ndarray:
    """A number from 0 to 1 for each key and tree (splitmix64)."""
    z = key + np.uint64(((seed * 1_000_003 + number) * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53


def sums_of(codes: np.ndarray, widths: Sequence[int], slot: np.ndarray, slots: int, target: np.ndarray) -> tuple[float, np.ndarray]:
    """For each slot and bin, rows times the returned unit plus the sum of the
    target, over the first ``len(slot)`` rows. Rows of slot ``slots`` are left out."""
    m = len(slot)
    n = 1 << m.bit_length()
    top = float(np.abs(target).max(initial=1e-30))
    unit = 2.0 ** (math.ceil(math.log2(top)) + 1) * n
    fine = unit * n * 2.0 ** -53
    weight = np.rint(target / fine) * fine + unit
    out = np.empty((slots, sum(widths)))
    base, at, place = {}, 0, np.empty(m, np.int64)
    for f, w in enumerate(widths):
        if w not in base:
            base[w] = slot * w
        np.add(base[w], codes[f, :m], out=place)
        out[:, at:at + w] = np.bincount(place, weight, (slots + 1) * w)[:slots * w].reshape(slots, w)
        at += w
    return unit, out


def best_splits(count: np.ndarray, total: np.ndarray, widths: Sequence[int], numbers: int, least: int):
    """For each slot: the feature (-1: none), the bins to the left, and mean and rows of both sides."""
    widths = np.array(widths)
    begin = np.cumsum(widths) - widths
    c, t, orders = count.copy(), total.copy(), {}
    for f in range(numbers, len(widths)):
        own = slice(begin[f], begin[f] + widths[f])
        mean = np.where(c[:, own] > 0, t[:, own] / np.maximum(c[:, own], 1), np.inf)
        orders[f] = np.argsort(mean, 1, kind="stable")
        c[:, own], t[:, own] = (np.take_along_axis(a[:, own], orders[f], 1) for a in (c, t))
    rows, whole = (a[:, :widths[0]].sum(1) for a in (c, t))
    np.cumsum(c, 1, out=c)
    np.cumsum(t, 1, out=t)
    for a, all_ in ((c, rows), (t, whole)):                 # every feature adds up to the same
        a -= np.repeat(np.arange(len(widths)), widths) * all_[:, None]
    other = rows[:, None] - c
    rest = whole[:, None] - t
    rest *= rest
    rest /= np.maximum(other, 1)
    gain = t * t
    gain /= np.maximum(c, 1)
    gain += rest
    np.copyto(gain, -np.inf, where=(c < least) | (other < least))
    best, i = gain.argmax(1), np.arange(len(c))
    feature = np.searchsorted(begin, best, "right") - 1
    cut = best - begin[feature]
    none = np.maximum(rows, 1)
    found = (gain[i, best] - whole ** 2 / none) / none > LEAST_GAIN
    left = np.arange(widths.max()) <= cut[:, None]
    for k in np.flatnonzero(feature >= numbers):
        f = feature[k]
        chosen = orders[f][k, :cut[k] + 1]
        left[k] = False
        left[k, chosen[count[k, begin[f] + chosen] > 0]] = True
    n, s = c[i, best], t[i, best]
    sides = np.stack([s / np.maximum(n, 1), (whole - s) / np.maximum(rows - n, 1), n, rows - n], 1)
    return np.where(found, feature, -1), left, sides, whole / none


def shared_trees(rows: DataFrame, numbers: Sequence[str], categorical: Sequence[str], params: Sequence[dict], folds: int, *,
                 trees: int, bins: int, seed: int, label: str = "sales",
                 key: Sequence[str] = ("store_nbr", "family", "date"), block: int = BLOCK) -> np.ndarray:
    """RMSLE of every (trial, fold) on the fold's validation rows (nan: there are none), for boosted trees on log1p of the label.

    ``rows`` holds features, label, keys and ``_fold0``... (1: training, 2:
    validation); ``params`` the ``depth``, ``step``, ``subsample`` and
    ``min_instances`` of each trial. Raises if a fold has no
    training rows or a feature is missing, as ``GBTRegressor`` does.
    """
    numbers, spark = list(numbers), rows.sparkSession
    sizes = rows.agg(*[F.count(F.when(F.col(f"_fold{f}") > 0, 1)) for f in range(folds)],
                     *[F.count(F.when(F.col(f"_fold{f}") == 1, 1)) for f in range(folds)]).first()
    if not all(sizes[folds:]):
        raise ValueError("a fold has no training rows")
    indexed = [f"{c}_idx" for c in categorical]
    counts = [math.ceil(n / block) for n in sizes[:folds]]

    def prepared(f: int) -> tuple[Layout, DataFrame]:
        mine, kinds = rows.where(F.col(f"_fold{f}") > 0), []
        if indexed:
            fitted = StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                                   stringOrderType="alphabetAsc").fit(mine.where(F.col(f"_fold{f}") == 1))
            mine, kinds = fitted.transform(mine), [len(v) + 1 for v in fitted.labelsArray]
        layout = layout_of(mine.where(F.col(f"_fold{f}") == 1), numbers, kinds, bins)
        mine = mine.withColumns({"_role": F.col(f"_fold{f}"), "_label": F.log1p(F.col(label).cast("double")),
                                 "_key": F.xxhash64(*key)})
        return layout, mine

    with ThreadPoolExecutor(folds) as pool:
        layouts, of_fold = zip(*pool.map(prepared, range(folds)))
    blocks = [_coded(of_fold[f], layouts[f], numbers, indexed, f, counts[f]) for f in range(folds)]
    parts = sum(counts)
    # trials of a group differ in depth, so that tasks take about as long
    cores = spark.sparkContext.defaultParallelism
    groups = min(range(1, min(len(params), math.ceil(3 * cores / parts)) + 1),
                 key=lambda g: (math.ceil(parts * g / cores) / (parts * g), g))
    ranked = sorted(range(len(params)), key=lambda t: (-params[t]["depth"], t))
    group = [ranked[g::groups] for g in range(groups)]
    held = cut_lineage(functools.reduce(DataFrame.unionByName, blocks))
    units = parts * groups
    # one partition each: a block and the scores of a group of trials on its rows
    state = (held.rdd.zipWithIndex()
             .flatMap(lambda r: [(r[1] * groups + g, (r[0].fold, g, pickle.loads(r[0].block), None)) for g in range(groups)])
             .partitionBy(units, int).values().persist(StorageLevel.MEMORY_AND_DISK))
    deepest = max(p["depth"] for p in params)
    widest = [max(lay.widths) for lay in layouts]

    def target(label_, score, number):
        return label_.astype(np.float64) if number == 0 else 2 * (label_ - score)

    def added(number: int, level: int, grown: dict, open_: dict):
        def run(unit: tuple) -> Iterator[tuple]:
            fold, g, (codes, role, y, keys), scores = unit
            mine = [(i, t, open_[t, fold]) for i, t in enumerate(group[g]) if (t, fold) in open_]
            if not mine:
                return
            # by their draw: the sample of any trial is what comes first
            draw = np.where(role == 1, drawn(keys, seed, number), 2.0)
            order = np.argsort(draw)[:np.count_nonzero(role == 1)]
            codes, draw, y = np.take(codes, order, 1), draw[order], y[order]
            for i, t, nodes in mine:
                m = int(np.searchsorted(draw, params[t]["subsample"]))
                slot = np.full(2 << level, len(nodes), np.int64)
                slot[nodes] = np.arange(len(nodes))
                slot = slot[grown[t, fold].places(codes, np.arange(m), level)]
                goal = target(y[:m], None if scores is None else scores[i][order[:m]], number)
                yield t * folds + fold, sums_of(codes, layouts[fold].widths, slot, len(nodes), goal)
        return run

    def split(sums: Iterator[tuple]) -> Iterator[tuple]:
        whole: dict = {}
        for pair, (unit, both) in sums:
            count = np.rint(both / unit)
            total = both - count * unit
            if pair in whole:
                whole[pair][0] += count
                whole[pair][1] += total
            else:
                whole[pair] = [count, total]
        for pair, (count, total) in whole.items():
            t, f = divmod(pair, folds)
            yield pair, best_splits(count, total, layouts[f].widths, len(numbers), params[t]["min_instances"])

    def moved(number: int, grown: dict):
        def run(unit: tuple) -> tuple:
            fold, g, held_, scores = unit
            scores = np.zeros((len(group[g]), held_[0].shape[1]), np.float32) if scores is None else scores.copy()
            every = np.arange(scores.shape[1])
            for i, t in enumerate(group[g]):
                tree = grown[t, fold]
                add = tree.value[tree.places(held_[0], every, params[t]["depth"])]
                scores[i] += add if number == 0 else params[t]["step"] * add
            return fold, g, held_, scores
        return run

    pairs, before = [(t, f) for t in range(len(params)) for f in range(folds)], None
    for number in range(trees):
        grown = {(t, f): Grown.empty(params[t]["depth"], widest[f]) for t, f in pairs}
        open_ = {p: [1] for p in pairs}
        for level in range(deepest):
            if not open_:
                break
            sums = state.flatMap(added(number, level, grown, open_))
            got = sums.partitionBy(2 * cores, int).mapPartitions(split).collect()
            if level == 0 and before is not None:
                before.unpersist()
            following = {}
            for pair, value in got:
                t, f = divmod(pair, folds)
                tree, least = grown[t, f], params[t]["min_instances"]
                for node, feature, left, side, mean in zip(open_[t, f], *value):
                    if node == 1:
                        tree.value[1] = np.nan_to_num(mean)
                    if feature < 0:
                        continue
                    tree.feature[node], tree.left[node, :len(left)] = feature, left
                    tree.value[2 * node], tree.value[2 * node + 1] = side[0], side[1]
                    if level + 1 < params[t]["depth"]:
                        following.setdefault((t, f), []).extend(2 * node + i for i in (0, 1) if side[2 + i] >= 2 * least)
            open_ = {p: nodes for p, nodes in following.items() if nodes}
        before, state = state, state.map(moved(number, grown)).persist(StorageLevel.MEMORY_AND_DISK)

    def errors(unit: tuple) -> Iterator[tuple]:
        fold, g, (_, role, y, _), scores = unit
        mine = role == 2
        for i, t in enumerate(group[g]):
            off = np.maximum(scores[i][mine].astype(np.float64), 0.0) - y[mine]
            yield t * folds + fold, np.array([(off ** 2).sum(), mine.sum()])

    total = np.zeros((len(params) * folds, 2))
    for pair, value in state.flatMap(errors).reduceByKey(lambda a, b: a + b).collect():
        total[pair] = value
    state.unpersist()
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.sqrt(total[:, 0] / total[:, 1]).reshape(len(params), folds)
