"""The driver contract: entry, queries and oracle SQL (DuckDB) on the smoke data."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
# cheap keys covering every query module with an oracle
SAMPLE = ["scan_sales", "merged_panel", "lag_features", "rolling_features", "promotion_features",
          "oil_features", "holiday_flags", "holiday_distance", "tx_features", "hier_city",
          "stats_store_family", "target_stats_applied", "blend_grid_alpha", "hurdle_select", "auc",
          "eda_oil_corr", "eda_promo_impact", "ts_fold_counts", "tx_forecast_grid", "submission",
          "hurdle_hard", "low_method_selection", "holdout_roles", "category_encoded", "score_table",
          "tx_forecast_features", "prediction_quartiles", "eda_describe", "rolling_minmax", "ordered_category_stats"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_contract_shapes():
    qs, sq = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 100
    assert set(sq) <= set(qs)


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert set(df.columns) == {"family", "rmsle", "n"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_matches(spark, duck, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())
