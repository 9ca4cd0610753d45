"""The feature matrix: one projection per grain, joined down to the panel once.

Grains and how they reach the panel:

* series (store, family, date): all series-window features in one select —
  the panel comes out of ``densify`` clustered by (store, family), so this
  adds a sort but no exchange;
* date: calendar, oil and holiday tables — one row per day of the panel
  span, a size bound independent of the data volume, hence broadcast;
* store-day: transactions, store totals, city totals and location holiday
  flags merged into one table first, then one join on (store_nbr, date);
* group-day: family, cluster×family, type×family totals (one join each);
* statistics: fitted as of ``as_of`` and left-joined on their keys.

Raw same-day transactions are not a feature (they are unknown for the
horizon); only their lags of 16+ days are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import calendar as cal
from shelfcast.operators import grains, series, stats
from shelfcast.operators.clean import fill_missing_features
from shelfcast.plans.panelplan import oil_dense
from shelfcast.sources.panel import PanelSources

KEY = ["store_nbr", "family", "date"]
CATEGORICAL = ["family", "store_type", "cluster", "city", "state",
               "family_x_store_type", "family_x_cluster", "dow_x_family"]
NON_FEATURES = ["id", "date", "sales", "role"]


def date_grain_table(src: PanelSources) -> DataFrame:
    """Calendar + oil + holiday features, one row per day (bounded size)."""
    calendar = cal.calendar_table(src.calendar)
    oil = grains.oil_features(oil_dense(src))
    hol = grains.holiday_calendar(src.calendar, src.holidays)
    return calendar.join(oil, "date", "left").join(hol, "date", "left")


def store_day_table(src: PanelSources, panel_with_stores: DataFrame,
                    hier: dict[str, DataFrame], st: dict | None = None,
                    as_of: Column | None = None) -> DataFrame:
    """Transactions, store and city totals, location holiday flags and the
    store statistics per (store, day): everything keyed by store reaches the
    panel through this one table and one join."""
    days = grains.store_days(src.store_list, src.first_date, src.panel_end)
    tx = grains.transaction_features(days, src.transactions, as_of).drop("transactions")
    loc = grains.holiday_location_flags(days, src.stores, src.holidays)
    store = hier["store"].drop("store_total")
    city = (hier["city"].drop("city_total")
            .join(src.stores.select("store_nbr", "city"), "city").drop("city"))
    out = (tx.join(loc, ["store_nbr", "date"], "left")
             .join(store, ["store_nbr", "date"], "left")
             .join(city, ["store_nbr", "date"], "left"))
    if st is not None:
        m = st[stats.MERGED]
        out = out.join(m[("store_nbr",)], "store_nbr", "left")
        wd = stats.by_weekday(m[("store_nbr", stats.DOW)], ["store_nbr"], ["store_dow_mean"])
        out = out.join(wd, "store_nbr", "left").select(
            "*", *stats.pick_weekday(["store_dow_mean"])).drop("_store_dow_mean_by_dow")
    return out


def family_day_table(hier: dict[str, DataFrame], st: dict) -> DataFrame:
    """Family national totals and the family statistics per (family, day):
    families × days rows, independent of the number of stores."""
    m = st[stats.MERGED]
    wd = stats.by_weekday(m[("family", stats.DOW)], ["family"], ["family_dow_mean"])
    fam = (hier["family"].drop("family_national").join(m[("family",)], "family", "left")
           .join(wd, "family", "left"))
    return fam.select("*", *stats.pick_weekday(["family_dow_mean"])).drop("_family_dow_mean_by_dow")


def series_stats_table(st: dict) -> DataFrame:
    """Per-series statistics (all-time, recent, zero ratio and the weekday
    means as arrays) keyed by (store_nbr, family) only, the key the panel is
    already partitioned by, so this join does not move the panel."""
    m = st[stats.MERGED]
    wd = stats.by_weekday(m[("store_nbr", "family", stats.DOW)], ["store_nbr", "family"],
                    ["sf_dow_mean", "sf_dow_recent_mean"])
    return m[("store_nbr", "family")].join(wd, ["store_nbr", "family"], "full")


def interaction_columns() -> list[Column]:
    c = F.col
    return [
        (c("sales_lag_16") - c("sales_lag_28")).alias("sales_velocity_16_28"),
        (c("sales_lag_16") - c("sales_lag_42")).alias("sales_velocity_16_42"),
        (c("sales_lag_28") - c("sales_lag_364")).alias("sales_yoy_change"),
        (c("onpromotion") * c("sf_mean")).alias("promo_x_sf_mean"),
        (c("onpromotion") * c("sf_dow_mean")).alias("promo_x_sf_dow_mean"),
        (c("sales_lag_16") / (c("sf_mean") + 1.0)).alias("lag16_to_mean_ratio"),
        (c("sales_lag_dow_3w") / (c("sales_lag_dow_4w") + 1.0)).alias("dow_trend_3w_4w"),
        (c("sales_lag_dow_4w") / (c("sales_lag_dow_52w") + 1.0)).alias("dow_yoy_ratio"),
        (c("sf_recent_mean") / (c("sf_mean") + 1.0)).alias("recent_vs_overall_ratio"),
        (c("onpromotion") * c("sales_dow_rolling_mean_4")).alias("promo_x_dow_avg"),
        (c("oil_regime") * cal.store_type_ordinal("store_type")).alias("oil_x_store_type"),
        (c("is_effective_holiday") * c("is_post_payday_window")).alias("holiday_x_payday"),
    ]


def build_features(src: PanelSources, as_of: Column | None = None,
                   promo_predicate: str = "eq1") -> DataFrame:
    """Every panel row (train and horizon) with the full feature set.

    ``as_of`` (default train_end) bounds the rows the target statistics see,
    so a validation fold passes its own training end.
    """
    src = src.materialized()
    as_of = src.train_end if as_of is None else as_of
    stores = src.stores
    panel = src.panel.join(stores, "store_nbr", "left")
    feats = series.add_series_features(panel, promo_predicate=promo_predicate)
    hier = grains.hierarchical_tables(panel)
    st = stats.fit_target_stats(panel.filter(F.col("date") <= src.train_end), as_of=as_of)
    # join order: date grain (broadcast, bounded by days) and series statistics
    # (same key as the panel's partitioning) first; then the one store-day join
    # (the only exchange of the panel); then family-level tables, whose size
    # is families × days (AQE broadcasts them when measured small).
    out = (feats.join(F.broadcast(date_grain_table(src)), "date", "left")
                .join(series_stats_table(st), ["store_nbr", "family"], "left")
                .select("*", *stats.pick_weekday(["sf_dow_mean", "sf_dow_recent_mean"]))
                .drop("_sf_dow_mean_by_dow", "_sf_dow_recent_mean_by_dow")
                .join(store_day_table(src, panel, hier, st, as_of), ["store_nbr", "date"], "left")
                .join(family_day_table(hier, st), ["family", "date"], "left")
                .join(hier["cluster_family"].drop("cluster_family_avg")
                      .join(st[stats.MERGED][("cluster", "family")], ["cluster", "family"], "left"),
                      ["cluster", "family", "date"], "left")
                .join(hier["type_family"].drop("type_family_avg"),
                      ["store_type", "family", "date"], "left"))
    out = out.withColumn("is_effective_holiday", F.greatest(
        "is_national_holiday", "is_regional_holiday", "is_local_holiday"))
    return out.select("*", *cal.cross_columns(), *interaction_columns())


def feature_columns(df: DataFrame) -> list[str]:
    """All columns except the id, date, target and split tags."""
    return [c for c in df.columns if c not in NON_FEATURES]


def training_matrix(features: DataFrame) -> DataFrame:
    """Null -> 0 on numeric features (categoricals keep their values)."""
    return fill_missing_features(features, exclude=NON_FEATURES + CATEGORICAL)
