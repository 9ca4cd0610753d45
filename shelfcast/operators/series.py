"""Series window features: lags, shifted rolling statistics, expanding means,
same-weekday lags, promotion features.

All features of one series share ``Window.partitionBy(keys).orderBy(date)``,
so Spark plans a single exchange and sort for all of them. ``shift(k)``
followed by ``rolling(n)`` is the single frame ``rows -(k+n-1) .. -k``.
Row lags equal day lags because the panel is dense (see ``densify``).
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.functions.moments import std_samp

SERIES_KEYS = ("store_nbr", "family")

# Fixed values of the original feature set.
SAFE_SHIFT = 16
LAG_DAYS = [16, 17, 21, 28, 35, 42, 56, 91, 182, 364]
ROLLING_WINDOWS = [7, 14, 28]
AGG_WINDOWS = [30, 90]
EXPANDING_MIN_OBS = 7
SAME_DOW_LAGS = [(3, 21), (4, 28), (8, 56), (52, 364)]
SAME_DOW_MEAN_WEEKS = [3, 4, 5, 6]

# rows that a sliding frame adds up before runs are doubled
FRAME_ROWS = 32


def series_window(keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date_col)


def shifted_frame(w: WindowSpec, shift: int, length: int) -> WindowSpec:
    """Frame of ``rolling(length)`` applied after ``shift(shift)``."""
    return w.rowsBetween(-(shift + length - 1), -shift)


def frame_mean(col: str, w: WindowSpec, shift: int, length: int | None, min_obs: int = 1) -> Column:
    """Mean over the shifted frame (``length`` None: everything up to ``shift``
    rows back), null below ``min_obs`` observations.

    Spark evaluates a sliding frame afresh for each row, within one generated
    loop: ``length`` additions a row, which a window of 90 days makes a few
    microseconds. Differences of running sums would be cheaper, but they lose
    the digits that a large early value takes.
    """
    frame = w.rowsBetween(Window.unboundedPreceding, -shift) if length is None else shifted_frame(w, shift, length)
    x = F.col(col).cast("double")
    mean = F.avg(x).over(frame)
    return mean if min_obs <= 1 else F.when(F.count(x).over(frame) >= min_obs, mean)


def _joined(parts: Sequence[Column], ends: bool) -> Column:
    """Statistics of adjoining runs of rows from those of each (null: no rows).
    The squared deviations of the whole are those inside the runs plus those of
    the runs' means: additions of what isn't negative, so no digits are lost."""
    n = sum((F.coalesce(p["n"], F.lit(0)) for p in parts), F.lit(0))
    s = sum((F.coalesce(p["s"], F.lit(0.0)) for p in parts), F.lit(0.0))
    mean = F.try_divide(s, F.nullif(n, F.lit(0)))
    q = sum((F.coalesce(p["q"] + p["n"] * F.pow(F.try_divide(p["s"], F.nullif(p["n"], F.lit(0))) - mean, F.lit(2.0)),
                        F.lit(0.0)) for p in parts), F.lit(0.0))
    out = [n.alias("n"), s.alias("s"), q.alias("q")]
    if ends:
        pick = (lambda f, k: f(*[p[k] for p in parts])) if len(parts) > 1 else lambda f, k: parts[0][k]
        out += [pick(F.least, "lo").alias("lo"), pick(F.greatest, "hi").alias("hi")]
    return F.struct(*out)


def stat_mean(part: Column) -> Column:
    return F.try_divide(part["s"], F.nullif(part["n"], F.lit(0)))


def stat_std(part: Column) -> Column:
    """Sample deviation, null below two observations."""
    return F.when(part["n"] > 1, F.sqrt(part["q"] / (part["n"] - 1)))


def add_window_statistics(df: DataFrame, target: str, windows: Sequence[int], shift: int = SAFE_SHIFT,
                          keys: Sequence[str] = SERIES_KEYS, date_col: str = "date",
                          ends: bool = False) -> DataFrame:
    """``_stat_{n}`` for each window length: a struct of the number of values
    ``n``, their sum ``s``, squared deviations ``q`` and, with ``ends``, smallest
    ``lo`` and largest ``hi`` over the ``n`` rows that end ``shift`` rows back.

    By doubling: the statistics of 2^k frames of ``FRAME_ROWS`` rows come from two
    of 2^(k-1), one of them ``lag``ged; a window is put together from the runs of
    the binary digits of its length in frames, and a sliding frame for the rest.
    That is O(log n) a row, where a sliding frame is O(n), and one pass over the
    sorted series a doubling, all with the same exchange and sort. A pass costs as
    much as a frame of some dozens of rows, so windows below ``FRAME_ROWS`` are
    plain sliding frames.
    """
    w = series_window(keys, date_col)
    x = F.col(target).cast("double")

    def framed(back: int, length: int) -> Column:
        f = shifted_frame(w, back, length)
        cols = [F.count(x).over(f).alias("n"), F.coalesce(F.sum(x).over(f), F.lit(0.0)).alias("s"),
                F.coalesce(F.var_pop(x).over(f) * F.count(x).over(f), F.lit(0.0)).alias("q")]
        return F.struct(*cols, *([F.min(x).over(f).alias("lo"), F.max(x).over(f).alias("hi")] if ends else []))

    levels = max(n // FRAME_ROWS for n in windows).bit_length()
    first, parts = {}, {n: [] for n in windows}
    if levels:
        first["_run_0"] = framed(0, FRAME_ROWS)
    lagged = {}
    for n in windows:
        back = shift
        for k in reversed(range(levels)):
            if n // FRAME_ROWS >> k & 1:
                lagged[f"_at_{k}_{back}"] = F.lag(f"_run_{k}", back).over(w)
                parts[n].append(F.col(f"_at_{k}_{back}"))
                back += FRAME_ROWS * 2 ** k
        if n % FRAME_ROWS:
            first[f"_rest_{n}"] = framed(back, n % FRAME_ROWS)
            parts[n].append(F.col(f"_rest_{n}"))
    out = df.withColumns(first)
    for k in range(1, levels):
        near, far = F.col(f"_run_{k - 1}"), F.col("_far")
        out = out.withColumn("_far", F.lag(f"_run_{k - 1}", FRAME_ROWS * 2 ** (k - 1)).over(w))
        out = out.withColumn(f"_run_{k}", _joined([near, far], ends)).drop("_far")
    out = out.withColumns(lagged) if lagged else out
    return out.select(*df.columns, *[_joined(parts[n], ends).alias(f"_stat_{n}") for n in windows])


def lag_columns(target: str, lags: Iterable[int], w: WindowSpec,
                name: str = "{t}_lag_{k}") -> list[Column]:
    return [F.lag(target, k).over(w).alias(name.format(t=target, k=k)) for k in lags]


def rolling_columns(target: str, windows: Iterable[int], w: WindowSpec,
                    shift: int = SAFE_SHIFT,
                    mean_name: str = "{t}_rolling_mean_{n}",
                    std_name: str = "{t}_rolling_std_{n}") -> list[Column]:
    """Mean and sample std over the shifted frame (min 1 observation; the std
    of one observation is null, as in pandas)."""
    cols = []
    for n in windows:
        cols.append(frame_mean(target, w, shift, n).alias(mean_name.format(t=target, n=n)))
        cols.append(std_samp(target, shifted_frame(w, shift, n)).alias(std_name.format(t=target, n=n)))
    return cols


def expanding_mean(target: str, w: WindowSpec, shift: int = SAFE_SHIFT,
                   min_obs: int = EXPANDING_MIN_OBS) -> Column:
    """Mean of everything up to ``shift`` rows back, null below ``min_obs``
    observations."""
    return frame_mean(target, w, shift, None, min_obs)


def mean_ignoring_nulls(cols: Sequence[Column]) -> Column:
    """Row-wise mean of the non-null values (null when all are null)."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    count = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.try_divide(total, F.nullif(count, F.lit(0)).cast("double"))


def add_lag_features(df: DataFrame, target: str = "sales", lags: Sequence[int] = LAG_DAYS,
                     keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    """``{target}_lag_{k}`` = value k rows (days) earlier in the series."""
    w = series_window(keys, date_col)
    return df.select("*", *lag_columns(target, lags, w))


def add_rolling_features(df: DataFrame, target: str = "sales",
                         windows: Sequence[int] = ROLLING_WINDOWS, shift: int = SAFE_SHIFT,
                         keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    w = series_window(keys, date_col)
    return df.select("*", *rolling_columns(target, windows, w, shift))


def add_same_dow_features(df: DataFrame, target: str = "sales",
                          keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    """Same-weekday lags (3, 4, 8, 52 weeks) and the mean of weeks 3..6."""
    w = series_window(keys, date_col)
    lags = [F.lag(target, k).over(w).alias(f"{target}_lag_dow_{wk}w") for wk, k in SAME_DOW_LAGS]
    weeks = [F.lag(target, 7 * wk).over(w) for wk in SAME_DOW_MEAN_WEEKS]
    return df.select("*", *lags, mean_ignoring_nulls(weeks).alias(f"{target}_dow_rolling_mean_4"))


def add_aggregation_features(df: DataFrame, target: str = "sales",
                             windows: Sequence[int] = AGG_WINDOWS, shift: int = SAFE_SHIFT,
                             keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    """Longer shifted windows (30, 90) and the shifted expanding mean (min 7 obs)."""
    w = series_window(keys, date_col)
    cols = rolling_columns(target, windows, w, shift,
                           mean_name="{t}_store_family_mean_{n}",
                           std_name="{t}_store_family_std_{n}")
    cols.append(expanding_mean(target, w, shift).alias(f"{target}_expanding_mean"))
    return df.select("*", *cols)


def add_rolling_minmax(df: DataFrame, target: str = "sales",
                       windows: Sequence[int] = (7, 28, 365), shift: int = SAFE_SHIFT,
                       keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    """Shifted rolling min / max and the coefficient of variation."""
    stats = add_window_statistics(df, target, windows, shift, keys, date_col, ends=True)
    cols = []
    for n in windows:
        part = F.col(f"_stat_{n}")
        cols += [part["lo"].alias(f"{target}_rolling_min_{n}"),
                 part["hi"].alias(f"{target}_rolling_max_{n}"),
                 F.try_divide(stat_std(part), F.nullif(stat_mean(part), F.lit(0.0)))
                 .alias(f"{target}_rolling_cv_{n}")]
    return stats.select(*df.columns, *cols)


def promo_run_length(col: str, w: WindowSpec, predicate: str = "eq1") -> Column:
    """Length of the current run of consecutive promoted rows (0 when not).

    ``predicate`` "eq1" counts rows with value == 1 (the original rule),
    "any" counts rows with value > 0. Run length = rows since the last
    non-promoted row, found with a running max (no second window pass).
    """
    hit = (F.col(col) == 1) if predicate == "eq1" else (F.col(col) > 0)
    hit = F.coalesce(hit, F.lit(False))
    rn = F.row_number().over(w)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    last_break = F.max(F.when(~hit, rn)).over(upto)
    return (rn - F.coalesce(last_break, F.lit(0))).cast("int")


def add_promotion_features(df: DataFrame, col: str = "onpromotion", predicate: str = "eq1",
                           keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    """Promotion lags 7/14, mean of the previous 14 rows, run length.

    Promotions are known for the horizon, so shifts below 16 are allowed.
    """
    w = series_window(keys, date_col)
    return df.select(
        "*",
        F.lag(col, 7).over(w).alias("promo_lag_7"),
        F.lag(col, 14).over(w).alias("promo_lag_14"),
        frame_mean(col, w, 1, 14).alias("promo_rolling_14"),
        promo_run_length(col, w, predicate).alias("promo_duration"))


def add_series_features(df: DataFrame, target: str = "sales",
                        keys: Sequence[str] = SERIES_KEYS, date_col: str = "date",
                        promo_predicate: str = "eq1") -> DataFrame:
    """All series-window features over one partitioning (one exchange, one
    sort)."""
    w = series_window(keys, date_col)
    has_promo = "onpromotion" in df.columns
    cols = lag_columns(target, LAG_DAYS, w)
    cols += rolling_columns(target, ROLLING_WINDOWS, w)
    cols += [F.lag(target, k).over(w).alias(f"{target}_lag_dow_{wk}w") for wk, k in SAME_DOW_LAGS]
    cols.append(mean_ignoring_nulls([F.lag(target, 7 * wk).over(w) for wk in SAME_DOW_MEAN_WEEKS])
                .alias(f"{target}_dow_rolling_mean_4"))
    cols += rolling_columns(target, AGG_WINDOWS, w, SAFE_SHIFT,
                            mean_name="{t}_store_family_mean_{n}",
                            std_name="{t}_store_family_std_{n}")
    cols.append(expanding_mean(target, w).alias(f"{target}_expanding_mean"))
    if has_promo:
        cols += [F.lag("onpromotion", 7).over(w).alias("promo_lag_7"),
                 F.lag("onpromotion", 14).over(w).alias("promo_lag_14"),
                 frame_mean("onpromotion", w, 1, 14).alias("promo_rolling_14"),
                 promo_run_length("onpromotion", w, promo_predicate).alias("promo_duration")]
    return df.select("*", *cols)
