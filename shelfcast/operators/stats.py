"""Target statistics: fitted on training rows up to ``as_of``, applied by joins.

Each statistic is a small aggregate (partial aggregation on the map side);
applying them is a chain of left joins on the statistic's keys. Joins of
tables keyed by series are left to AQE, which broadcasts them only when the
measured size is below the broadcast threshold and otherwise shuffles.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.moments import std_samp
from shelfcast.operators.series import SAFE_SHIFT

RECENT_DAYS = 90
SMOOTHING = 1.0          # rows that the prior counts for
DOW = "_dow"

# name -> (keys, [(output column, aggregate kind)]) ; kinds: mean std median q25 q75 zero
STAT_SPECS = {
    "store_family": (["store_nbr", "family"],
                     [("sf_mean", "mean"), ("sf_median", "median"), ("sf_std", "std"),
                      ("sf_q25", "q25"), ("sf_q75", "q75")]),
    "store_family_zero": (["store_nbr", "family"], [("sf_zero_ratio", "zero")]),
    "store_family_dow": (["store_nbr", "family", DOW], [("sf_dow_mean", "mean")]),
    "family": (["family"], [("family_mean", "mean"), ("family_std", "std")]),
    "family_dow": (["family", DOW], [("family_dow_mean", "mean")]),
    "store": (["store_nbr"], [("store_mean", "mean"), ("store_std", "std")]),
    "store_dow": (["store_nbr", DOW], [("store_dow_mean", "mean")]),
    "store_family_recent": (["store_nbr", "family"],
                            [("sf_recent_mean", "mean"), ("sf_recent_std", "std")]),
    "store_family_dow_recent": (["store_nbr", "family", DOW], [("sf_dow_recent_mean", "mean")]),
    "cluster_family": (["cluster", "family"],
                       [("cluster_family_mean", "mean"), ("cluster_family_std", "std")]),
}
RECENT = {"store_family_recent", "store_family_dow_recent"}
MERGED = "_by_keys"   # one table per key set, as aggregated (used by apply)


def _agg(kind: str, y: Column) -> Column:
    if kind == "mean":
        return F.avg(y)
    if kind == "std":
        return std_samp(y)
    if kind == "median":
        return F.percentile(y, F.lit(0.5))
    if kind == "q25":
        return F.percentile(y, F.lit(0.25))
    if kind == "q75":
        return F.percentile(y, F.lit(0.75))
    if kind == "zero":
        return F.avg((y == 0).cast("double"))
    raise ValueError(kind)


def fit_target_stats(train: DataFrame, as_of: Column | None = None, target: str = "sales",
                     date_col: str = "date", recent_days: int = RECENT_DAYS) -> dict[str, DataFrame]:
    """Statistics of the target over rows with a known target and date <= as_of.

    ``train`` must carry ``cluster`` for the cluster statistic (skipped
    otherwise). The recent statistics use date >= max(date) - 90 days; they
    are conditional aggregates in the same pass as the all-time statistics
    with the same keys, so there is one aggregation (one shuffle of partial
    aggregates) per distinct key set, not one per statistic.
    """
    rows = train.filter(F.col(target).isNotNull())
    if as_of is not None:
        rows = rows.filter(F.col(date_col) <= as_of)
    rows = rows.withColumn(DOW, F.weekday(F.col(date_col)))
    recent_start = F.date_sub(rows.select(F.max(date_col)).scalar(), recent_days)
    y = F.col(target)
    y_recent = F.when(F.col(date_col) >= recent_start, y)
    by_keys: dict[tuple, list] = {}
    for name, (keys, aggs) in STAT_SPECS.items():
        if any(k not in rows.columns for k in keys):
            continue
        col = y_recent if name in RECENT else y
        by_keys.setdefault(tuple(keys), []).extend(
            (name, out, _agg(kind, col).alias(out)) for out, kind in aggs)
    out = {}
    merged = {}
    for keys, items in by_keys.items():
        table = rows.groupBy(*keys).agg(*[expr for _n, _o, expr in items])
        merged[keys] = table
        for name in dict.fromkeys(n for n, _o, _e in items):
            cols = [o for n, o, _e in items if n == name]
            t = table.select(*keys, *cols)
            if name in RECENT:
                # keys seen only before the recent window have no recent statistics
                t = t.filter(F.col(cols[0]).isNotNull())
            out[name] = t
    out[MERGED] = merged
    return out


def by_weekday(table: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Weekday statistics (keys + _dow) turned into one row per key with an
    array of 7 values per statistic, so they join on the coarser key and the
    row's weekday picks its element (no join on the weekday)."""
    aggs = [F.array(*[F.max(F.when(F.col(DOW) == d, F.col(c))) for d in range(7)]).alias(f"_{c}_by_dow")
            for c in cols]
    return table.groupBy(*keys).agg(*aggs)


def pick_weekday(cols: list[str], date_col: str = "date") -> list[Column]:
    return [F.col(f"_{c}_by_dow")[F.weekday(date_col)].alias(c) for c in cols]


def apply_target_stats(df: DataFrame, stats: dict[str, DataFrame], date_col: str = "date") -> DataFrame:
    """Left-join every fitted statistic on its keys (absent ones are skipped).

    Weekday statistics ride on the table of the same keys without the weekday,
    as arrays: one join per key set without weekdays, none on a key as coarse
    as seven days."""
    tables = stats.get(MERGED) or _merged_by_keys(stats)
    out = df
    for base in dict.fromkeys(tuple(k for k in keys if k != DOW) for keys in tables):
        if any(k not in df.columns for k in base):
            continue
        plain, daily = tables.get(base), tables.get((*base, DOW))
        cols = [c for c in daily.columns if c not in (*base, DOW)] if daily is not None else []
        folded = by_weekday(daily, list(base), cols) if cols else None
        table = plain if folded is None else folded if plain is None else plain.join(folded, list(base), "full")
        out = out.join(table, list(base), "left").select("*", *pick_weekday(cols, date_col)).drop(
            *[f"_{c}_by_dow" for c in cols])
    return out


def _merged_by_keys(stats: dict[str, DataFrame]) -> dict[tuple, DataFrame]:
    """The statistics' tables put together by key set."""
    tables: dict[tuple, DataFrame] = {}
    for name, (keys, _aggs) in STAT_SPECS.items():
        if name in stats:
            k = tuple(keys)
            tables[k] = stats[name] if k not in tables else tables[k].join(stats[name], list(k), "full")
    return tables


def stat_columns() -> list[str]:
    return [c for _k, aggs in STAT_SPECS.values() for c, _kind in aggs]


def ordered_name(keys: Sequence[str]) -> str:
    return "ordered_" + "_x_".join(keys)


def ordered_category_stats(df: DataFrame, categories: Sequence[Sequence[str]], target: str = "sales",
                           date_col: str = "date", gap: int = SAFE_SHIFT, smoothing: float = SMOOTHING) -> DataFrame:
    """Each category set's mean target over earlier rows only, in time order,
    drawn towards the mean of all earlier rows: ``(sum + smoothing * prior) /
    (count + smoothing)`` as ``ordered_<names>``.

    Earlier are the rows ``gap`` days back and more, so a row's value holds
    neither its own target nor any that is unknown when a horizon row is
    predicted. Rows without a target count for nothing; a row without earlier
    ones has null; a null category has the prior.

    Rows are added up to one a category and day before anything moves; running
    sums are windows over those, one a category, as long as there are days.
    The prior is one row a day, hence the broadcast.
    """
    y = F.col(target).cast("double")
    day = F.unix_date(F.col(date_col))

    def earlier(keys: Sequence[str]) -> list[Column]:
        w = Window.partitionBy(*keys).orderBy(day).rangeBetween(Window.unboundedPreceding, -gap)
        return [F.sum("_s").over(w), F.sum("_n").over(w)]

    daily = df.groupBy(date_col).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    s, n = earlier([])
    prior = daily.select(date_col, F.try_divide(s, F.nullif(n, F.lit(0))).alias("_prior"))
    out = df.join(F.broadcast(prior), date_col, "left")
    for keys in categories:
        sums = df.groupBy(*keys, date_col).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
        s, n = earlier(keys)
        out = out.join(sums.select(*keys, date_col, s.alias("_es"), n.alias("_en")), [*keys, date_col], "left")
        total, count = F.coalesce("_es", F.lit(0.0)), F.coalesce("_en", F.lit(0))
        out = out.withColumn(ordered_name(keys), (total + smoothing * F.col("_prior")) / (count + smoothing)).drop("_es", "_en")
    return out.drop("_prior")
