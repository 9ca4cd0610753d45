"""Temporary views for SQL users: the panel view and its grain tables.

``register_views(spark, src)`` names the lazily built DataFrames, so report
queries can be written in Spark SQL against the same plans (Catalyst sees
one plan either way).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfcast.operators import grains
from shelfcast.plans.panelplan import merged_panel, oil_dense
from shelfcast.sources.panel import PanelSources


def register_views(spark: SparkSession, src: PanelSources, prefix: str = "") -> list[str]:
    views = {
        "panel": src.panel,
        "train": src.train_rows(),
        "horizon": src.horizon_rows(),
        "stores": src.stores,
        "transactions": src.transactions,
        "oil": src.oil,
        "oil_daily": oil_dense(src),
        "holidays": src.holidays,
        "calendar": src.calendar,
        "merged_panel": merged_panel(src),
        "holiday_calendar": grains.holiday_calendar(src.calendar, src.holidays),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
