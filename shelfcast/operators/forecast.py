"""Statistical forecasts, hurdle combinations and blend searches.

Blend searches are aggregate queries: a small weight grid (a parameter, not
data) is attached to the validation rows by a generator (``explode`` of the
grid array), squared log errors are summed per grid point, and the argmin is
an ordered ``limit 1`` with explicit tie-breaks. Where the error decomposes
(per segment), the grid is searched per segment and the sums combined.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import squared_log_error

RECENT_DAYS = 90
# Segment cut points on the mean daily target of a family.
SEGMENT_HIGH, SEGMENT_LOW = 100.0, 10.0
HURDLE_THRESHOLD = 0.5
F1_THRESHOLDS = [round(0.30 + 0.05 * i, 2) for i in range(10)]


def fallback_forecast(train: DataFrame, target_rows: DataFrame, as_of: Column,
                      recent_days: int = RECENT_DAYS, target: str = "sales") -> DataFrame:
    """Hierarchical mean over the last ``recent_days`` before ``as_of``:
    store×family×weekday → store×family → family×weekday → family → 0."""
    recent = (train.filter(F.col(target).isNotNull() & (F.col("date") <= as_of)
                           & (F.col("date") >= F.date_sub(as_of, recent_days)))
              .withColumn("_dow", F.weekday("date")))
    sfd = recent.groupBy("store_nbr", "family", "_dow").agg(F.avg(target).alias("pred_sfd"))
    sf = recent.groupBy("store_nbr", "family").agg(F.avg(target).alias("pred_sf"))
    fd = recent.groupBy("family", "_dow").agg(F.avg(target).alias("pred_fd"))
    fm = recent.groupBy("family").agg(F.avg(target).alias("pred_fm"))
    t = target_rows.withColumn("_dow", F.weekday("date"))
    out = (t.join(sfd, ["store_nbr", "family", "_dow"], "left")
            .join(sf, ["store_nbr", "family"], "left")
            .join(fd, ["family", "_dow"], "left")
            .join(fm, ["family"], "left"))
    pred = F.coalesce("pred_sfd", "pred_sf", "pred_fd", "pred_fm", F.lit(0.0))
    return out.withColumn("pred", pred).drop("_dow", "pred_sfd", "pred_sf", "pred_fd", "pred_fm")


def family_segments(train: DataFrame, target: str = "sales") -> DataFrame:
    """Family → mean target and segment HIGH (> 100) / MEDIUM (10..100) / LOW (<= 10)."""
    m = train.groupBy("family").agg(F.avg(target).alias("mean_sales"))
    seg = (F.when(F.col("mean_sales") > SEGMENT_HIGH, F.lit("HIGH"))
           .when(F.col("mean_sales") > SEGMENT_LOW, F.lit("MEDIUM"))
           .otherwise(F.lit("LOW")))
    return m.withColumn("segment", seg)


def series_segments(train: DataFrame, high_ratio: float = 1.25, low_ratio: float = 0.75,
                    target: str = "sales") -> DataFrame:
    """Series → segment by its mean relative to the overall mean (scale free):
    HIGH above ``high_ratio``, LOW at or below ``low_ratio``, else MEDIUM."""
    overall = train.select(F.avg(target)).scalar()
    m = train.groupBy("store_nbr", "family").agg(F.avg(target).alias("mean_sales"))
    r = F.col("mean_sales") / overall
    seg = (F.when(r > high_ratio, F.lit("HIGH")).when(r > low_ratio, F.lit("MEDIUM"))
           .otherwise(F.lit("LOW")))
    return m.withColumn("segment", seg)


def weighted_blend(preds: Sequence[str], weights: Sequence[float]) -> Column:
    """Σ wᵢ·pᵢ clipped at 0; lengths must match."""
    if len(preds) != len(weights):
        raise ValueError(f"{len(preds)} predictions but {len(weights)} weights")
    total = sum((F.lit(float(w)) * F.col(p) for p, w in zip(preds, weights)), F.lit(0.0))
    return F.greatest(total, F.lit(0.0))


def simplex_grid(n_models: int, steps: int) -> list[tuple[int, ...]]:
    """Integer weight vectors (k₁..kₙ) with Σk = steps (weights k/steps)."""
    if n_models == 1:
        return [(steps,)]
    return [(k,) + rest for k in range(steps + 1) for rest in simplex_grid(n_models - 1, steps - k)]


def explode_simplex(df: DataFrame, names: Sequence[str], steps: int) -> DataFrame:
    """Attach every integer weight vector with Σk = steps to each row, by
    nested ``explode(sequence(..))`` generators (no literal grid, no join)."""
    used = F.lit(0)
    for n in names[:-1]:
        df = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps) - used)).alias(n))
        used = used + F.col(n)
    return df.withColumn(names[-1], F.lit(steps) - used)


def explode_grid(df: DataFrame, names: Sequence[str], grid: Sequence[Sequence[int]]) -> DataFrame:
    """Attach an explicit (small) grid of integer weight vectors to each row."""
    arr = F.array(*[F.struct(*[F.lit(int(k)).alias(n) for k, n in zip(g, names)]) for g in grid])
    staged = df.select("*", F.explode(arr).alias("_g"))
    return staged.select(*df.columns, *[F.col(f"_g.{n}").alias(n) for n in names])


def grid_scores(rows: DataFrame, y: str, preds: Sequence[str], grid: Sequence[Sequence[int]] | None,
                steps: int, names: Sequence[str] | None = None) -> DataFrame:
    """RMSLE of every weight vector (weights k/steps, blend clipped at 0).

    ``grid`` None means the full simplex. The grid is attached per row by a
    generator, so rows × |grid| stay inside one stage and are summed per grid
    point with partial aggregation: only |grid| rows are shuffled.
    """
    names = list(names or [f"w{i + 1}" for i in range(len(preds))])
    base = rows.select(y, *preds)
    staged = explode_simplex(base, names, steps) if grid is None else explode_grid(base, names, grid)
    blend = sum((F.col(n).cast("double") / steps * F.col(p) for n, p in zip(names, preds)), F.lit(0.0))
    err = squared_log_error(F.col(y), F.greatest(blend, F.lit(0.0)))
    scored = staged.groupBy(*names).agg(F.sqrt(F.avg(err)).alias("rmsle"))
    return scored.select(*[(F.col(n) / steps).alias(n) for n in names], "rmsle")


def best_of(scores: DataFrame, order: Sequence[str]) -> DataFrame:
    """Argmin by rmsle with deterministic tie-breaks (columns ``order``)."""
    return scores.orderBy(F.col("rmsle").asc(), *[F.col(c).asc() for c in order]).limit(1)


def near_best(scores: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Grid points within ``tolerance`` (relative) of the best score."""
    best = scores.select(F.min("rmsle")).scalar()
    return scores.filter(F.col("rmsle") < best * (1.0 + tolerance))


def segment_alpha_grid(rows: DataFrame, y: str, p_a: str, p_b: str, segment: Column,
                       steps: int = 20) -> DataFrame:
    """α pair grid (α_high, α_rest) for pred = α·a + (1−α)·b by segment.

    The squared error is additive over rows, so it is summed per (is_high, α)
    — 2·(steps+1) sums — and the (steps+1)² pairs are combined afterwards.
    """
    alphas = F.array(*[F.lit(i) for i in range(steps + 1)])
    staged = rows.select(y, p_a, p_b, segment.alias("_high"), F.explode(alphas).alias("_k"))
    a = F.col("_k").cast("double") / steps
    err = squared_log_error(F.col(y), F.greatest(a * F.col(p_a) + (1 - a) * F.col(p_b), F.lit(0.0)))
    sums = staged.groupBy("_high", "_k").agg(F.sum(err).alias("_se"), F.count(F.lit(1)).alias("_n"))
    hi = sums.filter(F.col("_high")).select(F.col("_k").alias("k_high"), F.col("_se").alias("se_h"),
                                            F.col("_n").alias("n_h"))
    lo = sums.filter(~F.col("_high")).select(F.col("_k").alias("k_rest"), F.col("_se").alias("se_r"),
                                             F.col("_n").alias("n_r"))
    # every α_high row is expanded to the α_rest values and joined on α_rest
    pairs = hi.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("k_rest")).join(
        lo, "k_rest")
    return pairs.select(
        (F.col("k_high") / steps).alias("alpha_high"), (F.col("k_rest") / steps).alias("alpha_rest"),
        F.sqrt((F.col("se_h") + F.col("se_r")) / (F.col("n_h") + F.col("n_r"))).alias("rmsle"))


def hurdle_inputs(train: DataFrame, rows: DataFrame, as_of: Column, target: str = "sales") -> DataFrame:
    """Statistical hurdle parts per series from rows up to ``as_of``:
    p_nonzero = share of positive days, amount = mean of the positive days."""
    fit = train.filter(F.col(target).isNotNull() & (F.col("date") <= as_of))
    parts = fit.groupBy("store_nbr", "family").agg(
        F.avg((F.col(target) > 0).cast("double")).alias("p_nonzero"),
        F.coalesce(F.avg(F.when(F.col(target) > 0, F.col(target))), F.lit(0.0)).alias("amount"))
    return rows.join(parts, ["store_nbr", "family"], "left").fillna(0.0, ["p_nonzero", "amount"])


def hurdle_hard(p: Column, amount: Column, threshold: float = HURDLE_THRESHOLD) -> Column:
    return F.when(p >= threshold, amount).otherwise(F.lit(0.0))


def hurdle_soft(p: Column, amount: Column) -> Column:
    return p * amount


def f1_sweep(rows: DataFrame, label: Column, score: Column,
             thresholds: Sequence[float] = F1_THRESHOLDS) -> DataFrame:
    """F1 of (score >= t) per threshold; the threshold list is exploded per row
    and the confusion counts are conditional sums (partial aggregation)."""
    staged = rows.select(label.alias("_y"), score.alias("_s"),
                         F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("threshold"))
    hit = F.col("_s") >= F.col("threshold")
    counts = staged.groupBy("threshold").agg(
        F.count_if(hit & (F.col("_y") == 1)).alias("tp"),
        F.count_if(hit & (F.col("_y") == 0)).alias("fp"),
        F.count_if(~hit & (F.col("_y") == 1)).alias("fn"))
    f1 = F.try_divide(2.0 * F.col("tp"), (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double"))
    return counts.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def last_n_mean(df: DataFrame, keys: Sequence[str], value: str, n: int, name: str) -> DataFrame:
    """Mean of the last ``n`` non-null values per key (top-n per group by row_number)."""
    w = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    ranked = df.filter(F.col(value).isNotNull()).withColumn("_rk", F.row_number().over(w))
    return ranked.filter(F.col("_rk") <= n).groupBy(*keys).agg(F.avg(value).alias(name))
