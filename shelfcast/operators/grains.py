"""Grain tables: features computed once at the grain they belong to, then
joined down to the panel.

* date grain (one row per day): oil features, holiday flags and distances.
  Windows here have no partition key; they are only applied to tables
  bounded by the calendar (a few thousand rows), never to fact data.
* store-day grain: transactions features, store totals, store-specific
  (regional / local) holiday matches.
* group-day grain: family, city, cluster×family, type×family totals.

Lags are taken by date at the grain itself (the original shifted rows of
the broadcast panel, which leaks same-day totals), so a 16-day lag is 16
days whatever the number of rows per day.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.moments import std_samp
from shelfcast.operators.series import SAFE_SHIFT, shifted_frame

# Fixed values of the original feature rules.
HOLIDAY_TYPES = ["Holiday", "Transfer", "Bridge", "Additional"]
LOCALE_ORDINAL = {"National": 3, "Regional": 2, "Local": 1}
NO_HOLIDAY_DISTANCE = 30
REGIME_WINDOW, REGIME_MIN_OBS = 90, 30
REGIME_CUTS = (0.33, 0.66)
MA_WINDOW, MA_MIN_OBS = 60, 20
TX_LAGS = [16, 21, 28]
TX_ROLLING = [7, 14, 28]
TX_IMPUTE_LAST = 28


# ------------------------------------------------------------------- oil
def oil_features(oil_daily: DataFrame, value: str = "dcoilwtico", date_col: str = "date") -> DataFrame:
    """Oil features on a dense, filled date-grain series."""
    w = Window.orderBy(date_col)
    x = F.col(value)
    prev = F.lag(value, 1).over(w)
    regime_frame = w.rowsBetween(-REGIME_WINDOW, -1)
    staged = oil_daily.select(
        date_col, value,
        F.lag(value, 7).over(w).alias("oil_lag_7"),
        F.lag(value, 14).over(w).alias("oil_lag_14"),
        F.avg(value).over(w.rowsBetween(-28, -1)).alias("oil_rolling_mean_28"),
        std_samp(value, w.rowsBetween(-28, -1)).alias("oil_rolling_std_28"),
        (x - prev).alias("oil_diff"),
        prev.alias("_last"),
        F.collect_list(value).over(regime_frame).alias("_win"),
        F.lag(value, 30).over(w).alias("_x30"),
        F.avg(value).over(w.rowsBetween(-MA_WINDOW, -1)).alias("_ma60"),
        F.count(value).over(w.rowsBetween(-MA_WINDOW, -1)).alias("_n60"))
    n = F.size("_win")
    n_less = F.size(F.filter("_win", lambda q: q < F.col("_last")))
    n_equal = F.size(F.filter("_win", lambda q: q == F.col("_last")))
    # average-rank percentile of the window's last value (ties averaged)
    pct = F.when((n >= REGIME_MIN_OBS) & F.col("_last").isNotNull(),
                 (n_less + (n_equal + 1) / 2.0) / n)
    lo, hi = REGIME_CUTS
    regime = (F.when(pct.isNull(), F.lit(1.0))
              .when(pct <= lo, F.lit(0.0))
              .when(pct <= hi, F.lit(1.0))
              .otherwise(F.lit(2.0)))
    ma60 = F.when(F.col("_n60") >= MA_MIN_OBS, F.col("_ma60"))
    momentum = F.try_divide(x - F.col("_x30"), F.col("_x30") + 1.0)
    return staged.select(
        date_col, value, "oil_lag_7", "oil_lag_14", "oil_rolling_mean_28", "oil_rolling_std_28",
        "oil_diff", regime.alias("oil_regime"),
        F.coalesce(momentum, F.lit(0.0)).alias("oil_momentum_30d"),
        F.coalesce((x > ma60).cast("int"), F.lit(0)).alias("oil_above_60d_ma"))


# --------------------------------------------------------------- holidays
def holiday_day_flags(holidays: DataFrame) -> DataFrame:
    """One row per holiday date: type flags and the first row's locale ordinal."""
    ordinal = F.create_map(*[x for k, v in LOCALE_ORDINAL.items() for x in (F.lit(k), F.lit(v))])
    is_hol = F.col("type").isin(HOLIDAY_TYPES)
    national = (F.col("locale") == "National") & ~F.coalesce(F.col("transferred"), F.lit(False))
    return holidays.groupBy("date").agg(
        F.max(is_hol.cast("int")).alias("is_holiday"),
        F.max(national.cast("int")).alias("is_national_holiday"),
        F.max((F.col("type") == "Bridge").cast("int")).alias("is_bridge_day"),
        F.max((F.col("type") == "Work Day").cast("int")).alias("is_work_day"),
        F.coalesce(ordinal[F.min_by("locale", "h_seq")], F.lit(0)).alias("holiday_type"))


def holiday_neighbour_flags(holidays: DataFrame) -> DataFrame:
    """Days before / after a holiday date, by shifting the holiday dates
    (not by lagging rows, so gaps and table edges do not matter)."""
    hd = holidays.filter(F.col("type").isin(HOLIDAY_TYPES)).select("date").distinct()
    tags = F.array(
        F.struct(F.date_sub("date", 1).alias("d"), F.lit("pre").alias("k")),
        F.struct(F.date_add("date", 1).alias("d"), F.lit("post1").alias("k")),
        F.struct(F.date_add("date", 2).alias("d"), F.lit("post2").alias("k")))
    shifted = hd.select(F.explode(tags).alias("t")).select(
        F.col("t.d").alias("date"), F.col("t.k").alias("k"))
    return shifted.groupBy("date").agg(
        F.max((F.col("k") == "pre").cast("int")).alias("is_pre_holiday"),
        F.max((F.col("k") == "post1").cast("int")).alias("is_post_holiday_1d"),
        F.max((F.col("k") == "post2").cast("int")).alias("is_post_holiday_2d"))


def holiday_distances(calendar: DataFrame, holidays: DataFrame, date_col: str = "date") -> DataFrame:
    """As-of lookups on the calendar: days to the next holiday (strictly after)
    and since the last one (on or before); 30 when there is none.

    Calendar days and holiday dates are unioned and scanned once in date
    order (date grain, bounded)."""
    hd = holidays.filter(F.col("type").isin(HOLIDAY_TYPES)).select(
        F.col("date").alias(date_col)).distinct().withColumn("_h", F.lit(1))
    both = calendar.select(date_col, F.lit(0).alias("_h")).unionByName(hd)
    k = F.unix_date(F.col(date_col))
    w = Window.orderBy(k)
    hdate = F.when(F.col("_h") == 1, F.col(date_col))
    nxt = F.min(hdate).over(w.rangeBetween(1, Window.unboundedFollowing))
    last = F.max(hdate).over(w.rangeBetween(Window.unboundedPreceding, 0))
    scanned = both.select(date_col, "_h", nxt.alias("_next"), last.alias("_last"))
    return scanned.filter(F.col("_h") == 0).select(
        date_col,
        F.coalesce(F.datediff("_next", date_col), F.lit(NO_HOLIDAY_DISTANCE)).alias("days_to_next_holiday"),
        F.coalesce(F.datediff(date_col, "_last"), F.lit(NO_HOLIDAY_DISTANCE)).alias("days_since_last_holiday"))


def holiday_calendar(calendar: DataFrame, holidays: DataFrame) -> DataFrame:
    """Date-grain holiday features (flags, neighbours, distances, scope ordinal)."""
    flags = holiday_day_flags(holidays)
    near = holiday_neighbour_flags(holidays)
    dist = holiday_distances(calendar, holidays)
    zero = ["is_holiday", "is_national_holiday", "is_bridge_day", "is_work_day", "holiday_type",
            "is_pre_holiday", "is_post_holiday_1d", "is_post_holiday_2d"]
    out = calendar.join(flags, "date", "left").join(near, "date", "left").join(dist, "date", "left")
    return out.select("date", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero],
                      "days_to_next_holiday", "days_since_last_holiday")


def holiday_location_flags(store_days: DataFrame, stores: DataFrame, holidays: DataFrame) -> DataFrame:
    """Store-day flags: regional holiday of the store's state, local holiday
    of its city (existence joins on (date, name))."""
    reg = (holidays.filter(F.col("locale") == "Regional")
           .select("date", F.col("locale_name").alias("state")).distinct()
           .withColumn("is_regional_holiday", F.lit(1)))
    loc = (holidays.filter(F.col("locale") == "Local")
           .select("date", F.col("locale_name").alias("city")).distinct()
           .withColumn("is_local_holiday", F.lit(1)))
    sd = store_days.join(stores.select("store_nbr", "city", "state"), "store_nbr", "left")
    sd = sd.join(reg, ["date", "state"], "left").join(loc, ["date", "city"], "left")
    return sd.select("store_nbr", "date",
                     F.coalesce("is_regional_holiday", F.lit(0)).alias("is_regional_holiday"),
                     F.coalesce("is_local_holiday", F.lit(0)).alias("is_local_holiday"))


# ------------------------------------------------------------ transactions
def store_days(stores: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every (store, day) of the panel span, generated from the store list."""
    return stores.select("store_nbr", F.explode(F.sequence(start, end)).alias("date"))


def transactions_last_mean(tx: DataFrame, n_last: int = TX_IMPUTE_LAST, as_of: Column | None = None) -> DataFrame:
    """Per store: mean of the last ``n_last`` known daily transactions (up to ``as_of``)."""
    if as_of is not None:
        tx = tx.filter(F.col("date") <= as_of)
    w = Window.partitionBy("store_nbr").orderBy(F.col("date").desc())
    ranked = tx.filter(F.col("transactions").isNotNull()).withColumn("_rk", F.row_number().over(w))
    return ranked.filter(F.col("_rk") <= n_last).groupBy("store_nbr").agg(
        F.avg("transactions").alias("tx_last28_mean"))


def transaction_features(days: DataFrame, tx: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Store-day transactions: impute gaps with the store's last-28 mean (0 if
    none), lags 16/21/28, rolling means after a shift of 16, ratios.

    ``as_of`` bounds the days that the imputed mean and the store's mean see,
    so a validation fold's own days don't enter its features."""
    imputed = (days.join(tx, ["store_nbr", "date"], "left")
               .join(transactions_last_mean(tx, as_of=as_of), "store_nbr", "left")
               .select("store_nbr", "date",
                       F.coalesce(F.col("transactions").cast("double"), F.col("tx_last28_mean"),
                                  F.lit(0.0)).alias("transactions")))
    w = Window.partitionBy("store_nbr").orderBy("date")
    cols = [F.lag("transactions", k).over(w).alias(f"transactions_lag_{k}") for k in TX_LAGS]
    cols += [F.avg("transactions").over(shifted_frame(w, SAFE_SHIFT, n))
             .alias(f"transactions_rolling_mean_{n}") for n in TX_ROLLING]
    seen = F.col("transactions") if as_of is None else F.when(F.col("date") <= as_of, F.col("transactions"))
    cols.append(F.avg(seen).over(Window.partitionBy("store_nbr")).alias("_store_mean"))
    staged = imputed.select("store_nbr", "date", "transactions", *cols)
    return staged.select(
        "store_nbr", "date", "transactions",
        *[f"transactions_lag_{k}" for k in TX_LAGS],
        *[f"transactions_rolling_mean_{n}" for n in TX_ROLLING],
        (F.col("transactions_lag_16") / (F.col("_store_mean") + 1.0)).alias("tx_vs_store_mean"),
        (F.col("transactions_rolling_mean_7") / (F.col("transactions_rolling_mean_28") + 1.0))
        .alias("tx_rolling_trend"))


# ------------------------------------------------------------ hierarchical
def group_day_totals(panel: DataFrame, keys: Sequence[str], how: str, name: str,
                     target: str = "sales") -> DataFrame:
    """Aggregate the target to (keys, date); all-null groups stay null."""
    agg = F.sum(target) if how == "sum" else F.avg(target)
    return panel.groupBy(*keys, "date").agg(agg.alias(name))


def lag_by_date(df: DataFrame, keys: Sequence[str], value: str, lags: Sequence[int],
                prefix: str, rolling: Sequence[int] = ()) -> DataFrame:
    """Lags (and shifted rolling means) of a dense group-day series."""
    w = Window.partitionBy(*keys).orderBy("date")
    cols = [F.lag(value, k).over(w).alias(f"{prefix}_lag_{k}") for k in lags]
    cols += [F.avg(value).over(shifted_frame(w, SAFE_SHIFT, n)).alias(f"{prefix}_rolling_{n}")
             for n in rolling]
    return df.select(*keys, "date", value, *cols)


def hierarchical_tables(panel_with_stores: DataFrame) -> dict[str, DataFrame]:
    """The five group-day tables with their lags (keys, date, total, lags)."""
    p = panel_with_stores
    store = lag_by_date(group_day_totals(p, ["store_nbr"], "sum", "store_total"),
                        ["store_nbr"], "store_total", [16, 28], "store_total", rolling=[7])
    family = lag_by_date(group_day_totals(p, ["family"], "sum", "family_national"),
                         ["family"], "family_national", [16, 28], "family_national")
    city = lag_by_date(group_day_totals(p, ["city"], "sum", "city_total"),
                       ["city"], "city_total", [16], "city_total")
    cluster_family = lag_by_date(group_day_totals(p, ["cluster", "family"], "avg", "cluster_family_avg"),
                                 ["cluster", "family"], "cluster_family_avg", [16], "cluster_family")
    type_family = lag_by_date(group_day_totals(p, ["store_type", "family"], "avg", "type_family_avg"),
                              ["store_type", "family"], "type_family_avg", [16], "store_type_family")
    return {"store": store, "family": family, "city": city,
            "cluster_family": cluster_family, "type_family": type_family}
