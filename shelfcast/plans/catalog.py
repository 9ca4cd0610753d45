"""Registry of named queries: a Spark plan and, where exact, a DuckDB oracle.

Each query is ``fn(src: PanelSources) -> DataFrame``. The registered
callable has the driver signature ``(spark, sf_dir) -> DataFrame`` and rounds
double outputs to 6 places (the oracle rounds the same columns), so the
comparison is insensitive to summation order.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.sources.panel import PanelSources

ROUND_DIGITS = 6


@dataclass
class Entry:
    name: str
    fn: Callable[[PanelSources], DataFrame]
    sql: str | None
    headline: bool = False


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(name, fn, sql, headline)
        return fn
    return deco


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), ROUND_DIGITS).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(entry.fn(PanelSources(spark, sf_dir)))
    run.__name__ = entry.name
    run.__doc__ = entry.fn.__doc__
    return run


def load_all() -> dict[str, Entry]:
    """Import the modules that register queries."""
    from shelfcast.plans import (  # noqa: F401
        q_sources, q_features, q_grains, q_stats, q_matrix, q_forecast, q_reports, q_models)
    return REGISTRY


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(e) for name, e in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: e.sql for name, e in load_all().items() if e.sql}
