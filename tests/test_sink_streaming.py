"""Submission sink, side files, and the streaming scorer on horizon files."""

from __future__ import annotations

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import PanelSources
from shelfcast.sources.sink import load_json, save_json, submission_rows, write_submission
from shelfcast.streaming.scoring import fallback_tables, score, start_scoring

from conftest import SMOKE_DIR


def test_submission_sink(spark):
    h = spark.createDataFrame([(i, 1, "A", i) for i in range(4)], "id long, store_nbr int, family string, date int")
    p = spark.createDataFrame([(1, "A", i, float(i) - 0.995) for i in range(4)],
                              "store_nbr int, family string, date int, pred double")
    rows = submission_rows(h, p)
    out = tempfile.mkdtemp(prefix="sub-")
    write_submission(rows, out + "/s")
    back = spark.read.option("header", True).csv(out + "/s")
    assert back.columns == ["id", "sales"] and back.count() == 4


def test_side_file_default(spark):
    d = tempfile.mkdtemp(prefix="side-")
    assert load_json(spark, d + "/missing", {"w": [1.0]}) == {"w": [1.0]}
    save_json(spark, {"w": [0.7, 0.3]}, d + "/weights")
    assert load_json(spark, d + "/weights") == {"w": [0.7, 0.3]}


def test_streaming_scores_like_batch(spark):
    src = PanelSources(spark, SMOKE_DIR).materialized()
    tables = fallback_tables(src.train_rows(), src.train_end)
    horizon = src.with_id(src.horizon_rows()).select("id", "date", "store_nbr", "family", "onpromotion")
    d = tempfile.mkdtemp(prefix="stream-")
    horizon.filter(F.dayofmonth("date") % 2 == 0).write.parquet(d + "/in/part1")
    horizon.filter(F.dayofmonth("date") % 2 == 1).write.parquet(d + "/in/part2")
    q = start_scoring(spark, d + "/in/*", d + "/out", tables, checkpoint=d + "/ckpt")
    q.awaitTermination(120)
    got = spark.read.parquet(*glob.glob(d + "/out/batch=*"))
    expected = score(horizon, tables)
    assert got.count() == horizon.count()
    assert got.exceptAll(expected).count() == 0


def test_missing_prediction_is_an_error(spark):
    h = spark.createDataFrame([(i, 1, "A", i) for i in range(4)], "id long, store_nbr int, family string, date int")
    p = spark.createDataFrame([(1, "A", i, 1.0 if i else None) for i in range(3)],
                              "store_nbr int, family string, date int, pred double")
    rows = submission_rows(h, p, keep=["date"])
    assert {(r.id, r.sales) for r in rows.collect()} == {(0, None), (1, 1.0), (2, 1.0), (3, None)}
    with pytest.raises(ValueError):
        write_submission(rows, tempfile.mkdtemp(prefix="sub-") + "/s")
