"""Shared fixtures: a local session and the small retail fixtures (fixed seed)."""

from __future__ import annotations

import datetime as dt
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import get_spark
    s = get_spark("local[4]", app="shelfcast-tests", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def _dates(start: dt.date, n: int):
    return [start + dt.timedelta(days=i) for i in range(n)]


@pytest.fixture(scope="session")
def sample_train(spark):
    """30 days from 2017-01-01 × stores {1, 2} × {GROCERY I, BEVERAGES} = 120 rows."""
    rng = np.random.default_rng(42)
    rows, i = [], 0
    for store in (1, 2):
        for fam in ("GROCERY I", "BEVERAGES"):
            for d in _dates(dt.date(2017, 1, 1), 30):
                rows.append((i, d, store, fam, float(max(0.0, rng.normal(100, 30))), int(rng.integers(0, 2))))
                i += 1
    return spark.createDataFrame(
        rows, "id long, date date, store_nbr int, family string, sales double, onpromotion int")


@pytest.fixture(scope="session")
def sample_stores(spark):
    return spark.createDataFrame(
        [(1, "Quito", "Pichincha", "A", 1), (2, "Guayaquil", "Guayas", "B", 2)],
        "store_nbr int, city string, state string, store_type string, cluster int")


@pytest.fixture(scope="session")
def sample_holidays(spark):
    return spark.createDataFrame(
        [(dt.date(2017, 1, 1), "Holiday", "National", "Ecuador", "Primer dia", False, 0),
         (dt.date(2017, 1, 2), "Holiday", "Local", "Quito", "Fundacion", False, 1),
         (dt.date(2017, 1, 15), "Transfer", "National", "Ecuador", "Traslado", True, 2)],
        "date date, type string, locale string, locale_name string, description string, "
        "transferred boolean, h_seq long")
