"""Window statistics by doubling, ranks over sampled ranges, ordered category statistics."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import metrics
from shelfcast.operators import series, stats

DAY0 = dt.date(2016, 1, 1)


def _series(spark, values):
    rows = [(1, "A", DAY0 + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")


@pytest.mark.parametrize("shift", [0, 1, 16])
def test_window_statistics_equal_plain_frames(spark, shift):
    rng = random.Random(3)
    values = [None if rng.random() < 0.1 else round(rng.uniform(0, 50), 3) for _ in range(420)]
    values[20:60] = [None] * 40
    windows = [1, 7, 32, 33, 64, 90, 365]
    got = series.add_window_statistics(_series(spark, values), "sales", windows, shift, ends=True)
    got = got.select("date", *[c for n in windows for c in (
        series.stat_mean(F.col(f"_stat_{n}")).alias(f"mean_{n}"), series.stat_std(F.col(f"_stat_{n}")).alias(f"std_{n}"),
        F.col(f"_stat_{n}.lo").alias(f"lo_{n}"), F.col(f"_stat_{n}.hi").alias(f"hi_{n}"), F.col(f"_stat_{n}.n").alias(f"n_{n}"))])
    for i, r in enumerate(got.orderBy("date").collect()):
        for n in windows:
            end = i - shift + 1
            seen = [v for v in values[max(0, end - n):max(0, end)] if v is not None]
            assert r[f"n_{n}"] == len(seen)
            assert r[f"mean_{n}"] == (pytest.approx(statistics.fmean(seen)) if seen else None)
            assert r[f"std_{n}"] == (pytest.approx(statistics.stdev(seen), abs=1e-12) if len(seen) > 1 else None)
            assert (r[f"lo_{n}"], r[f"hi_{n}"]) == ((min(seen), max(seen)) if seen else (None, None))


def test_a_spike_costs_later_windows_no_digits(spark):
    rng = random.Random(5)
    values = [rng.uniform(0, 1) for _ in range(500)]
    values[3] = 1e15
    got = series.add_rolling_minmax(_series(spark, values), windows=(90, 365), shift=1).orderBy("date").collect()
    for i in (480, 499):
        for n in (90, 365):
            seen = values[i - n:i]
            assert got[i][f"sales_rolling_cv_{n}"] == pytest.approx(statistics.stdev(seen) / statistics.fmean(seen), rel=1e-9)


def test_window_statistics_stay_in_one_exchange(spark):
    df = spark.range(2000).select((F.col("id") % 3).cast("int").alias("store_nbr"), F.lit("A").alias("family"),
                                  F.date_add(F.lit(DAY0), (F.col("id") / 3).cast("int")).alias("date"),
                                  F.col("id").cast("double").alias("sales"))
    plan = series.add_rolling_minmax(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_an_outlier_does_not_fill_one_range(spark):
    """Ranges come from sampled bounds: with one value at 1e15 the rest are still dealt out."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(float(i), 1) for i in range(8000)] + [(1e15, 1)]
        df = spark.createDataFrame(rows, "v double, n long")
        placed = metrics.range_buckets(df, ["v"])
        sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
        assert len(sizes) > 2 and max(sizes) < 8001 * 0.6
        order = placed.groupBy("_bucket").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_bucket").collect()
        assert all(a.hi < b.lo for a, b in zip(order, order[1:]))
        before = {r.v: r.before for r in metrics.counts_before(df, "v", "n").collect()}
        assert before == {v: i for i, (v, _) in enumerate(rows)}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_grouped_quantiles_with_ties_and_nulls(spark):
    rng = random.Random(11)
    rows = [(g, float(rng.randrange(9))) for g in ("a", "b") for _ in range(101)] + [("a", None), ("c", 4.0)]
    got = {r.g: (r.q0, r.q1) for r in metrics.quantiles(spark.createDataFrame(rows, "g string, x double"), "x", [0.25, 0.5], ["g"]).collect()}
    for g in ("a", "b"):
        xs = sorted(x for h, x in rows if h == g and x is not None)
        assert got[g] == (xs[25], xs[50])
    assert got["c"] == (4.0, 4.0)


def _panel(spark, bump=None):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        for cat in ("x", "y", None):
            v = float(rng.randrange(20))
            rows.append((DAY0 + dt.timedelta(days=i), cat, None if i >= 50 else v + (1000 if bump == (i, cat) else 0)))
    return rows, spark.createDataFrame(rows, "date date, cat string, sales double")


def test_ordered_statistics_by_hand(spark):
    rows, df = _panel(spark)
    got = {(r.date, r.cat): r.ordered_cat for r in stats.ordered_category_stats(df, [("cat",)], gap=16, smoothing=2.0).collect()}
    assert len(got) == len(rows)
    for d, cat, _ in rows:
        known = [(c, v) for e, c, v in rows if (d - e).days >= 16 and v is not None]
        if not known:
            assert got[d, cat] is None
            continue
        prior = statistics.fmean(v for _, v in known)
        own = [v for c, v in known if c == cat and cat is not None]
        assert got[d, cat] == pytest.approx((sum(own) + 2 * prior) / (len(own) + 2))


def test_ordered_statistics_do_not_leak(spark):
    """A changed target moves only rows 16 days later and more."""
    plain, bumped = (stats.ordered_category_stats(_panel(spark, b)[1], [("cat",)]) for b in (None, (20, "x")))
    key = lambda df: {(r.date, r.cat): r.ordered_cat for r in df.collect()}
    a, b = key(plain), key(bumped)
    moved = {d for (d, c) in a if a[d, c] != b[d, c]}
    assert min(moved) == DAY0 + dt.timedelta(days=36) and max(moved) == DAY0 + dt.timedelta(days=59)
