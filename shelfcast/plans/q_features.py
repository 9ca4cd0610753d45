"""Queries: calendar functions and series-window features (inventory 77-85, 105-115, 122, 158)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions import calendar as cal
from shelfcast.functions.metrics import rmsle, rmsle_by
from shelfcast.functions.moments import std_samp
from shelfcast.operators import series
from shelfcast.operators.folds import holdout_bounds
from shelfcast.plans.catalog import register
from shelfcast.plans.oracle import sql

KEY = ["store_nbr", "family", "date"]
PI2 = "(2 * pi())"
DOW = "(isodow(date) - 1)"
SW = "PARTITION BY store_nbr, family ORDER BY date"


def _frame(shift: int, n: int) -> str:
    return f"OVER ({SW} ROWS BETWEEN {shift + n - 1} PRECEDING AND {shift} PRECEDING)"


def _lag(col: str, k: int) -> str:
    return f"LAG({col}, {k}) OVER ({SW})"


def _r(expr: str, name: str) -> str:
    return f"ROUND({expr}, 6) AS {name}"


# ---------------------------------------------------------------- calendar
CAL_SQL = f"""
SELECT date, CAST(day(date) AS INTEGER) AS day, CAST({DOW} AS INTEGER) AS day_of_week,
  CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  CAST({DOW} >= 5 AS INTEGER) AS is_weekend, CAST(day(date) = 1 AS INTEGER) AS is_month_start,
  CAST(date = last_day(date) AS INTEGER) AS is_month_end,
  {_r(f"sin({PI2} * {DOW} / 7.0)", "dow_sin")}, {_r(f"cos({PI2} * {DOW} / 7.0)", "dow_cos")},
  {_r(f"sin({PI2} * (month(date) - 1) / 12.0)", "month_sin")},
  {_r(f"cos({PI2} * (month(date) - 1) / 12.0)", "month_cos")},
  CAST((day(date) - 1) // 7 + 1 AS INTEGER) AS week_of_month
FROM cal"""


@register("calendar_features", sql(CAL_SQL))
def calendar_features(src):
    """Calendar parts, weekend/month flags, cyclical encodings (date grain)."""
    return src.calendar.select("date", *cal.calendar_columns("date"))


def _fourier_sql() -> str:
    cols = []
    for k in cal.FOURIER_ORDERS:
        cols += [_r(f"sin({PI2} * {k} * {DOW} / 7.0)", f"fourier_week_sin_{k}"),
                 _r(f"cos({PI2} * {k} * {DOW} / 7.0)", f"fourier_week_cos_{k}"),
                 _r(f"sin({PI2} * {k} * dayofyear(date) / 365.25)", f"fourier_year_sin_{k}"),
                 _r(f"cos({PI2} * {k} * dayofyear(date) / 365.25)", f"fourier_year_cos_{k}")]
    return "SELECT date, " + ", ".join(cols) + " FROM cal"


@register("fourier_features", sql(_fourier_sql()))
def fourier_features(src):
    return src.calendar.select("date", *cal.fourier_columns("date"))


PAYDAY_SQL = f"""
, c AS (SELECT date, CAST(day(date) AS INTEGER) AS d, date = last_day(date) AS me FROM cal)
SELECT date,
  CAST(d = 15 OR me AS INTEGER) AS is_payday,
  CAST(LEAST(GREATEST(CASE WHEN d <= 15 THEN d - 1 ELSE d - 15 END, 0), 16) AS INTEGER) AS days_since_payday,
  CAST(d IN (15, 16, 17) OR d IN (1, 2, 3) OR me AS INTEGER) AS is_post_payday_window,
  CAST(d IN (15, 16, 17) AS INTEGER) AS is_quincena,
  CAST(d >= 28 OR d <= 2 AS INTEGER) AS is_fin_de_mes,
  ROUND(GREATEST(0.0, 1.0 - 0.25 * CAST(LEAST(abs(d - 15),
      CASE WHEN d <= 3 THEN LEAST(abs(d - 30), d) WHEN d >= 28 THEN 30 - d ELSE 15 END) AS DOUBLE)), 6) AS payday_decay,
  CAST(date BETWEEN DATE '{cal.EVENT_START}' AND DATE '{cal.EVENT_END}' AS INTEGER) AS is_earthquake_period,
  CAST(month(date) = 8 AND d >= 15 AS INTEGER) AS is_back_to_school
FROM c"""


@register("payday_features", sql(PAYDAY_SQL))
def payday_features(src):
    """Wage-cycle flags, payday decay (values as coded), event and school flags."""
    return src.calendar.select("date", *cal.payday_columns("date"))


SEASON_SQL = """
SELECT date,
  CAST(LEAST(GREATEST(CASE WHEN make_date(year(date), 12, 25) - date >= 0
        THEN make_date(year(date), 12, 25) - date
        ELSE make_date(year(date) + 1, 12, 25) - date END, 0), 365) AS INTEGER) AS days_to_christmas,
  CAST(LEAST(GREATEST(make_date(year(date) + 1, 1, 1) - date, 0), 365) AS INTEGER) AS days_to_new_year
FROM cal"""


@register("season_distance", sql(SEASON_SQL))
def season_distance(src):
    return src.calendar.select("date", *cal.season_columns("date"))


@register("cross_features", sql(f"""
SELECT p.store_nbr, p.family, p.date,
  p.family || '_' || s.store_type AS family_x_store_type,
  p.family || '_' || CAST(s.cluster AS VARCHAR) AS family_x_cluster,
  CAST(isodow(p.date) - 1 AS VARCHAR) || '_' || p.family AS dow_x_family
FROM panel p JOIN stores s USING (store_nbr)"""))
def cross_features(src):
    """String crosses family×store_type, family×cluster, weekday×family."""
    p = src.panel.join(src.stores, "store_nbr")
    return p.select(*KEY, *cal.cross_columns())


# ------------------------------------------------------------ series windows
def _lags_sql() -> str:
    cols = ", ".join(f"{_lag('sales', k)} AS sales_lag_{k}" for k in series.LAG_DAYS)
    return f"SELECT store_nbr, family, date, sales, {cols} FROM panel"


@register("lag_features", sql(_lags_sql()))
def lag_features(src):
    """sales_lag_k for k in 16, 17, 21, 28, 35, 42, 56, 91, 182, 364."""
    return series.add_lag_features(src.panel.select(*KEY, "sales"))


def _rolling_sql(windows, mean_name, std_name) -> str:
    cols = []
    for n in windows:
        cols.append(_r(f"AVG(sales) {_frame(16, n)}", mean_name.format(n=n)))
        cols.append(_r("STDDEV_SAMP(sales) " + _frame(16, n), std_name.format(n=n)))
    return ", ".join(cols)


@register("rolling_features", sql(
    "SELECT store_nbr, family, date, sales, "
    + _rolling_sql(series.ROLLING_WINDOWS, "sales_rolling_mean_{n}", "sales_rolling_std_{n}")
    + " FROM panel"))
def rolling_features(src):
    """Mean and sample std over 7/14/28 rows after a shift of 16."""
    return series.add_rolling_features(src.panel.select(*KEY, "sales"))


def _dow_sql() -> str:
    lags = ", ".join(f"{_lag('sales', k)} AS sales_lag_dow_{w}w" for w, k in series.SAME_DOW_LAGS)
    four = [_lag("sales", 7 * w) for w in series.SAME_DOW_MEAN_WEEKS]
    total = " + ".join(f"COALESCE({x}, 0)" for x in four)
    cnt = " + ".join(f"CAST({x} IS NOT NULL AS INTEGER)" for x in four)
    return (f"SELECT store_nbr, family, date, sales, {lags}, "
            f"ROUND(({total}) / NULLIF({cnt}, 0), 6) AS sales_dow_rolling_mean_4 FROM panel")


@register("dow_lag_features", sql(_dow_sql()))
def dow_lag_features(src):
    """Same-weekday lags (3, 4, 8, 52 weeks) and mean of weeks 3..6 ignoring nulls."""
    return series.add_same_dow_features(src.panel.select(*KEY, "sales"))


@register("aggregation_features", sql(
    "SELECT store_nbr, family, date, sales, "
    + _rolling_sql(series.AGG_WINDOWS, "sales_store_family_mean_{n}", "sales_store_family_std_{n}")
    + f", ROUND(CASE WHEN COUNT(sales) OVER ({SW} ROWS BETWEEN UNBOUNDED PRECEDING AND 16 PRECEDING) >= 7"
    + f" THEN AVG(sales) OVER ({SW} ROWS BETWEEN UNBOUNDED PRECEDING AND 16 PRECEDING) END, 6)"
    + " AS sales_expanding_mean FROM panel"))
def aggregation_features(src):
    """30/90-row shifted means/stds and the shifted expanding mean (min 7)."""
    return series.add_aggregation_features(src.panel.select(*KEY, "sales"))


def _promo_sql(pred: str) -> str:
    return f"""
, p AS (SELECT store_nbr, family, date, onpromotion, COALESCE({pred}, false) AS hit FROM panel),
isl AS (SELECT *, SUM(CASE WHEN hit THEN 0 ELSE 1 END) OVER ({SW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM p)
SELECT store_nbr, family, date, onpromotion,
  {_lag('onpromotion', 7)} AS promo_lag_7, {_lag('onpromotion', 14)} AS promo_lag_14,
  ROUND(AVG(onpromotion) OVER ({SW} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 6) AS promo_rolling_14,
  CAST(SUM(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY store_nbr, family, island ORDER BY date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS promo_duration
FROM isl"""


@register("promotion_features", sql(_promo_sql("onpromotion = 1")))
def promotion_features(src):
    """Promotion lags 7/14, shifted 14-row mean, run length of value == 1 (original rule)."""
    return series.add_promotion_features(
        src.panel.select(*KEY, "onpromotion"), predicate="eq1")


@register("promotion_features_any", sql(_promo_sql("onpromotion > 0")))
def promotion_features_any(src):
    """As promotion_features, but a run counts rows with any promotion (> 0)."""
    return series.add_promotion_features(
        src.panel.select(*KEY, "onpromotion"), predicate="any")


def _minmax_sql() -> str:
    cols = []
    for n in (7, 28, 365):
        f = _frame(16, n)
        cols += [f"MIN(sales) {f} AS sales_rolling_min_{n}", f"MAX(sales) {f} AS sales_rolling_max_{n}",
                 _r(f"(STDDEV_SAMP(sales) {f}) / NULLIF(AVG(sales) {f}, 0)", f"sales_rolling_cv_{n}")]
    return "SELECT store_nbr, family, date, sales, " + ", ".join(cols) + " FROM panel"


@register("rolling_minmax", sql(_minmax_sql()))
def rolling_minmax(src):
    """Spec-only extras: shifted rolling min/max and coefficient of variation (7, 28, 365)."""
    return series.add_rolling_minmax(src.panel.select(*KEY, "sales"))


@register("series_cv", sql("""
SELECT store_nbr, family, ROUND(AVG(sales), 6) AS mean_sales, ROUND(STDDEV_SAMP(sales), 6) AS std_sales,
  ROUND((STDDEV_SAMP(sales)) / NULLIF(AVG(sales), 0), 6) AS cv
FROM train GROUP BY 1, 2"""))
def series_cv(src):
    """Per-series coefficient of variation over the training days."""
    t = src.train_rows()
    return t.groupBy("store_nbr", "family").agg(
        F.avg("sales").alias("mean_sales"), std_samp("sales").alias("std_sales"),
        F.try_divide(std_samp("sales"), F.nullif(F.avg("sales"), F.lit(0.0))).alias("cv"))


# ------------------------------------------------- minimum slice: naive forecast
def holdout_naive(src):
    """Validation rows of the last 16 known days with the lag-28 forecast and
    shifted rolling means (one series window over the dense panel)."""
    w = series.series_window()
    _, val_start, val_end = holdout_bounds(src.train_end)
    recent = src.panel.filter(F.col("date").between(F.date_sub(val_start, 28), val_end))   # the longest look back
    feats = recent.select(
        *KEY, "sales",
        F.lag("sales", 16).over(w).alias("sales_lag_16"),
        F.lag("sales", 28).over(w).alias("sales_lag_28"),
        F.avg("sales").over(series.shifted_frame(w, 16, 7)).alias("sales_rolling_mean_7"))
    return feats.filter(F.col("date").between(val_start, val_end))


HOLDOUT_SQL = f"""
, f AS (SELECT store_nbr, family, date, sales, LAG(sales, 28) OVER ({SW}) AS pred FROM panel),
v AS (SELECT f.* FROM f, bounds b WHERE f.date BETWEEN b.train_end - 15 AND b.train_end)"""
SLE = "POW(ln(1 + GREATEST(COALESCE(pred, 0), 0)) - ln(1 + sales), 2)"


@register("rmsle_by_family", sql(HOLDOUT_SQL + f"""
SELECT family, ROUND(SQRT(AVG({SLE})), 6) AS rmsle, COUNT(*) AS n FROM v GROUP BY family"""),
          headline=True)
def rmsle_by_family(src):
    """RMSLE of the lag-28 forecast per family on the 16-day holdout."""
    v = holdout_naive(src).withColumn("pred", F.coalesce(F.col("sales_lag_28"), F.lit(0.0)))
    return rmsle_by(v, "sales", "pred", ["family"])


@register("rmsle_by_day", sql(HOLDOUT_SQL + f"""
SELECT CAST(v.date - (b.train_end - 16) AS INTEGER) AS horizon_day, ROUND(SQRT(AVG({SLE})), 6) AS rmsle,
  COUNT(*) AS n FROM v, bounds b GROUP BY 1"""))
def rmsle_by_day(src):
    """RMSLE of the lag-28 forecast per day of the holdout (1..16)."""
    v = holdout_naive(src).withColumn("pred", F.coalesce(F.col("sales_lag_28"), F.lit(0.0)))
    v = v.withColumn("horizon_day", F.datediff("date", F.date_sub(src.train_end, 16)))
    return rmsle_by(v, "sales", "pred", ["horizon_day"])


@register("rmsle_overall", sql(HOLDOUT_SQL + f"""
SELECT ROUND(SQRT(AVG({SLE})), 6) AS rmsle_lag28,
  ROUND(SQRT(AVG(POW(ln(1 + 0.0) - ln(1 + sales), 2))), 6) AS rmsle_zero, COUNT(*) AS n FROM v"""))
def rmsle_overall(src):
    """RMSLE of the lag-28 and of the zero forecast over the holdout."""
    v = holdout_naive(src)
    return v.agg(rmsle("sales", F.coalesce(F.col("sales_lag_28"), F.lit(0.0))).alias("rmsle_lag28"),
                 rmsle("sales", F.lit(0.0)).alias("rmsle_zero"),
                 F.count(F.lit(1)).alias("n"))
