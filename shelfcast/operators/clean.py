"""Cleaning, filling and filtering operators (target clipping, promotion
nulls, structural zeros, event windows, trailing windows, post-processing)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.series import SERIES_KEYS

PREDICTION_CLIP_THRESHOLD = 0.01
TRAILING_DAYS = 730


def clean_sales(df: DataFrame, target: str = "sales", promo: str = "onpromotion") -> DataFrame:
    """Clip the target at 0 (null stays null), null promotions -> 0 as int."""
    t = F.col(target)
    return df.withColumns({
        target: F.when(t.isNotNull(), F.greatest(t, F.lit(0.0))),
        promo: F.coalesce(F.col(promo), F.lit(0)).cast("int"),
    })


def clean_holidays(df: DataFrame) -> DataFrame:
    """``is_transferred`` = transferred as boolean, false when absent/null."""
    if "transferred" in df.columns:
        flag = F.coalesce(F.col("transferred").cast("boolean"), F.lit(False))
    else:
        flag = F.lit(False)
    return df.withColumn("is_transferred", flag)


def forward_back_fill(df: DataFrame, value: str, order_col: str = "date",
                      keys: Sequence[str] = ()) -> DataFrame:
    """Forward fill, then back fill, in ``order_col`` order.

    Without ``keys`` this is a date-grain operation: the window has one
    partition, which is only used on tables bounded by the calendar.
    """
    w = Window.partitionBy(*keys).orderBy(order_col) if keys else Window.orderBy(order_col)
    ffill = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    bfill = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(value, F.coalesce(ffill, bfill))


def interpolate_linear(df: DataFrame, value: str, order_col: str = "date",
                       keys: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation between the previous and next known values by row
    position; trailing gaps keep the last value, leading gaps stay null."""
    base = Window.partitionBy(*keys).orderBy(order_col) if keys else Window.orderBy(order_col)
    rn = F.row_number().over(base)
    staged = df.withColumn("_rn", rn)
    known_rn = F.when(F.col(value).isNotNull(), F.col("_rn"))
    back = base.rowsBetween(Window.unboundedPreceding, 0)
    ahead = base.rowsBetween(0, Window.unboundedFollowing)
    staged = staged.select(
        "*",
        F.last(value, ignorenulls=True).over(back).alias("_pv"),
        F.last(known_rn, ignorenulls=True).over(back).alias("_pr"),
        F.first(value, ignorenulls=True).over(ahead).alias("_nv"),
        F.first(known_rn, ignorenulls=True).over(ahead).alias("_nr"))
    frac = F.try_divide((F.col("_rn") - F.col("_pr")).cast("double"),
                        F.nullif(F.col("_nr") - F.col("_pr"), F.lit(0)).cast("double"))
    interp = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(F.col("_pv").isNotNull() & F.col("_nv").isNotNull(),
                    F.col("_pv") + (F.col("_nv") - F.col("_pv")) * frac)
              .otherwise(F.col("_pv")))
    return staged.withColumn(value, interp).drop("_rn", "_pv", "_pr", "_nv", "_nr")


def first_sale_date(target: str = "sales", keys: Sequence[str] = SERIES_KEYS,
                    date_col: str = "date") -> Column:
    """Per-series first date with a positive target (window, no join)."""
    return F.min(F.when(F.col(target) > 0, F.col(date_col))).over(Window.partitionBy(*keys))


def filter_structural_zeros(df: DataFrame, target: str = "sales",
                            keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    """Drop rows before a series' first sale; series that never sold are kept whole."""
    first = first_sale_date(target, keys, date_col)
    staged = df.withColumn("_first_sale", first)
    keep = F.col("_first_sale").isNull() | (F.col(date_col) >= F.col("_first_sale"))
    return staged.filter(keep).drop("_first_sale")


def structural_zero_counts(df: DataFrame, target: str = "sales",
                           keys: Sequence[str] = SERIES_KEYS, date_col: str = "date") -> DataFrame:
    """Per series: first sale date, rows, and rows the filter removes.

    Two-level aggregate: the first sale date per series, then the count of
    earlier rows; the second pass is a window over the same partitioning.
    """
    staged = df.withColumn("_first_sale", first_sale_date(target, keys, date_col))
    before = F.col("_first_sale").isNotNull() & (F.col(date_col) < F.col("_first_sale"))
    return staged.groupBy(*keys).agg(
        F.min("_first_sale").alias("first_sale_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(before).alias("n_removed"))


def mask_date_range(df: DataFrame, start: str, end: str, date_col: str = "date") -> DataFrame:
    """Drop rows inside the inclusive interval [start, end]."""
    d = F.col(date_col)
    return df.filter(~d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def trailing_window(df: DataFrame, max_date: Column, days: int = TRAILING_DAYS,
                    date_col: str = "date") -> DataFrame:
    """Keep rows with date >= max_date - days (apply after the features)."""
    return df.filter(F.col(date_col) >= F.date_sub(max_date, days))


def postprocess(pred: Column, threshold: float = PREDICTION_CLIP_THRESHOLD) -> Column:
    """Clip at 0 and set values below ``threshold`` to 0; a missing prediction
    stays null."""
    p = F.when(pred.isNotNull(), F.greatest(pred, F.lit(0.0)))
    return F.when(p < F.lit(threshold), F.lit(0.0)).otherwise(p)


def fill_missing_features(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Null -> 0 for every numeric feature column (not keys, target, strings)."""
    numeric = [f.name for f in df.schema.fields
               if f.name not in exclude and f.dataType.typeName() in
               ("double", "float", "integer", "long", "short")]
    return df.fillna(0, subset=numeric)


def ensure_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Missing feature guard: absent columns become constant 0."""
    missing = {c: F.lit(0) for c in names if c not in df.columns}
    return df.withColumns(missing) if missing else df
