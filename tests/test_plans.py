"""Physical-plan guards: the shapes the design relies on at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_windows_add_no_exchange(spark):
    """Fact aggregation + densify window are the only shuffles of a series feature query."""
    p = _plan(entry.queries()["rolling_features"](spark, SMOKE_DIR))
    assert p.count("Exchange hashpartitioning") == 2


def test_scan_is_pruned(spark):
    """Only the needed line-item columns are read; nothing is cross joined."""
    p = _plan(entry.queries()["lag_features"](spark, SMOKE_DIR))
    schemas = re.findall(r"lineitem\.parquet\].*?ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("l_extendedprice" not in s and "l_tax" not in s for s in schemas)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_blend_grid_is_generated_not_joined(spark):
    p = _plan(entry.queries()["blend_simplex"](spark, SMOKE_DIR))
    assert "Generate" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_store_list_does_not_aggregate_line_items(spark):
    """The stores come from the suppliers by a semi join; no sum of quantities."""
    p = _plan(entry.queries()["tx_features"](spark, SMOKE_DIR))
    assert "LeftSemi" in p and "l_quantity" not in p


def test_auc_and_quantiles_have_no_global_window_over_values(spark):
    from pyspark.sql import functions as F
    from shelfcast.functions.metrics import quantiles, roc_auc
    df = spark.range(5000).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") * 0.37).alias("s"))
    for out in (roc_auc(df, "y", "s"), quantiles(df, "s", [0.5])):
        windows = re.findall(r"Window \[.*", _plan(out))
        assert windows
        for w in windows:
            # ordered by value within a bucket, or by bucket over the buckets' totals
            assert "_bucket" in w
    assert list(quantiles(df, "s", [0.0, 0.25, 1.0]).first()) == pytest.approx([0.0, 4999 * 0.25 * 0.37, 4999 * 0.37])


def test_describe_reads_the_panel_once(spark):
    p = _plan(entry.queries()["eda_describe"](spark, SMOKE_DIR))
    assert "Expand" in p or "Generate" in p
    assert "ObjectHashAggregate" not in p


def test_target_statistics_join_on_no_weekday_key(spark):
    """Weekday statistics ride on their coarse key's table: four joins."""
    from pyspark.sql import functions as F
    from shelfcast.operators import stats
    train = spark.range(400).select(
        (F.col("id") % 3).cast("int").alias("store_nbr"), (F.col("id") % 2).cast("string").alias("family"),
        F.lit(1).alias("cluster"), F.date_add(F.lit("2020-01-01"), (F.col("id") % 60).cast("int")).alias("date"),
        F.col("id").cast("double").alias("sales"))
    fitted = stats.fit_target_stats(train)
    out = stats.apply_target_stats(train, fitted)
    assert set(stats.stat_columns()) <= set(out.columns) and out.count() == 400
    logical = out._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Join LeftOuter") == 4
    alone = stats.apply_target_stats(train, {k: v for k, v in fitted.items() if k != stats.MERGED})
    assert alone.select(*out.columns).exceptAll(out).count() == 0
