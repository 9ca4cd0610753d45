"""Panel view, densify, grain tables (no cross-series leaks), holidays."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from shelfcast.functions import calendar as cal
from shelfcast.operators import grains
from shelfcast.operators.densify import densify
from shelfcast.sources import PanelSources

from conftest import SMOKE_DIR


def test_densify_fills_gaps(spark):
    rows = [(1, "A", dt.date(2017, 1, 3), 5.0), (1, "A", dt.date(2017, 1, 6), 2.0),
            (2, "A", dt.date(2017, 1, 2), 1.0)]
    fact = spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")
    out = densify(fact, ["store_nbr", "family"], "date", F.lit(dt.date(2017, 1, 1)),
                  F.lit(dt.date(2017, 1, 7)), {"sales": 0.0}).toPandas()
    assert len(out) == 14
    s1 = out[out.store_nbr == 1].sort_values("date")["sales"].tolist()
    assert s1 == [0.0, 0.0, 5.0, 0.0, 0.0, 2.0, 0.0]


def test_panel_is_dense_with_null_horizon(spark):
    src = PanelSources(spark, SMOKE_DIR)
    p = src.panel
    stats = p.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("store_nbr", "family").alias("s"),
                  F.count_distinct("date").alias("d"),
                  F.count_if(F.col("sales").isNull()).alias("nulls")).first()
    assert stats.n == stats.s * stats.d
    assert stats.nulls == stats.s * 16


def test_store_total_lag_is_sixteen_days(spark):
    """Several families per store: the store-total lag is 16 days, not 16 rows."""
    rows = []
    for i in range(40):
        d = dt.date(2017, 1, 1) + dt.timedelta(days=i)
        for fam in ("A", "B", "C"):
            rows.append((1, fam, d, float(i)))
    p = spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")
    p = p.withColumn("city", F.lit("X")).withColumn("cluster", F.lit(1)).withColumn("store_type", F.lit("A"))
    t = grains.hierarchical_tables(p)["store"].orderBy("date").toPandas()
    assert t["store_total"][20] == 60.0
    assert t["store_total_lag_16"][20] == 3.0 * 4      # day 4 total = 3 families x 4


def test_transactions_do_not_cross_stores(spark):
    days = spark.createDataFrame([(s, dt.date(2017, 1, 1) + dt.timedelta(days=i))
                                  for s in (1, 2) for i in range(40)], "store_nbr int, date date")
    tx = days.select("store_nbr", "date", (F.col("store_nbr") * 1000).cast("long").alias("transactions"))
    out = grains.transaction_features(days, tx).toPandas()
    s2 = out[out.store_nbr == 2].sort_values("date")
    assert s2["transactions_lag_16"].iloc[:16].isna().all()
    assert (s2["transactions_lag_16"].iloc[16:] == 2000).all()


def test_holiday_distances_and_flags(spark, sample_holidays):
    calendar = spark.createDataFrame([(dt.date(2016, 12, 31) + dt.timedelta(days=i),) for i in range(20)],
                                     "date date")
    hc = grains.holiday_calendar(calendar, sample_holidays).orderBy("date").toPandas().set_index("date")
    assert hc.loc[dt.date(2016, 12, 31), "days_to_next_holiday"] == 1
    assert hc.loc[dt.date(2017, 1, 1), "is_national_holiday"] == 1
    assert hc.loc[dt.date(2017, 1, 15), "is_national_holiday"] == 0     # transferred
    assert hc.loc[dt.date(2017, 1, 15), "is_holiday"] == 1
    assert hc.loc[dt.date(2017, 1, 1), "holiday_type"] == 3
    assert hc.loc[dt.date(2016, 12, 31), "is_pre_holiday"] == 1
    assert hc.loc[dt.date(2017, 1, 3), "is_post_holiday_2d"] == 1
    assert hc.loc[dt.date(2016, 12, 31), "days_since_last_holiday"] == 30


def test_payday_table(spark):
    days = spark.createDataFrame([(dt.date(2017, 1, d),) for d in range(1, 32)], "date date")
    out = days.select("date", *cal.payday_columns()).orderBy("date").toPandas()
    decay = dict(zip(range(1, 32), out["payday_decay"]))
    expected = {1: .75, 2: .5, 3: .25, 12: .25, 13: .5, 14: .75, 15: 1.0, 16: .75, 17: .5, 18: .25,
                28: .5, 29: .75, 30: 1.0, 31: 1.25}
    for d in range(1, 32):
        assert decay[d] == expected.get(d, 0.0), d
    assert out["days_since_payday"][14] == 14       # the 15th, as coded


def test_regional_and_local_match(spark, sample_stores, sample_holidays):
    days = spark.createDataFrame([(s, dt.date(2017, 1, 2)) for s in (1, 2)], "store_nbr int, date date")
    out = grains.holiday_location_flags(days, sample_stores, sample_holidays).toPandas()
    flags = dict(zip(out.store_nbr, out.is_local_holiday))
    assert flags == {1: 1, 2: 0}


def _panel_two_stores(spark, bump_after=None):
    rows = []
    for i in range(60):
        d = dt.date(2017, 1, 1) + dt.timedelta(days=i)
        for store, level in ((1, 10.0), (2, 1000.0)):
            for fam in ("A", "B"):
                v = level + i
                if bump_after is not None and d > bump_after:
                    v = v * 7 + 3
                rows.append((store, fam, d, float(v), "C%d" % store, store, "A"))
    return spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double, "
                                       "city string, cluster int, store_type string")


def test_hierarchical_no_leak(spark):
    """Group totals lagged by date: changing sales after t leaves lags up to t+16 unchanged."""
    cut = dt.date(2017, 1, 20)
    a = grains.hierarchical_tables(_panel_two_stores(spark))
    b = grains.hierarchical_tables(_panel_two_stores(spark, cut))
    for name in a:
        lag_cols = [c for c in a[name].columns if "_lag_" in c or "_rolling_" in c]
        keys = [c for c in a[name].columns if c not in lag_cols and not c.endswith(("_total", "_national", "_avg"))]
        keep = F.col("date") <= F.lit(cut + dt.timedelta(days=16))
        diff = a[name].filter(keep).select(*keys, *lag_cols).exceptAll(
            b[name].filter(keep).select(*keys, *lag_cols))
        assert diff.count() == 0, name


def test_target_stats_as_of(spark):
    """Statistics fitted as of t do not see rows after t."""
    from shelfcast.operators import stats
    cut = dt.date(2017, 1, 20)
    a = stats.fit_target_stats(_panel_two_stores(spark), as_of=F.lit(cut))
    b = stats.fit_target_stats(_panel_two_stores(spark, cut), as_of=F.lit(cut))
    for name, df in a.items():
        if name.startswith("_"):
            continue
        assert df.exceptAll(b[name]).count() == 0, name


def test_series_do_not_mix_levels(spark):
    """Two stores with very different levels: store totals stay per store."""
    t = grains.hierarchical_tables(_panel_two_stores(spark))["store"].toPandas()
    low = t[t.store_nbr == 1]["store_total_lag_16"].dropna()
    assert low.max() < 2 * (10 + 60)


def test_sql_views(spark):
    from shelfcast.plans.views import register_views
    names = register_views(spark, PanelSources(spark, SMOKE_DIR), prefix="t_")
    assert "t_panel" in names
    row = spark.sql("""SELECT COUNT(*) AS n, SUM(CASE WHEN sales IS NULL THEN 1 ELSE 0 END) AS h
                       FROM t_panel""").first()
    s = spark.sql("SELECT COUNT(DISTINCT store_nbr, family) AS s FROM t_panel").first().s
    assert row.h == 16 * s
    assert spark.sql("SELECT COUNT(*) FROM t_holiday_calendar WHERE is_holiday = 1").first()[0] > 0
