"""Sinks: the submission file, small JSON side files (blend weights, scores)."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.clean import postprocess


def submission_rows(horizon: DataFrame, predictions: DataFrame, key=("store_nbr", "family", "date"),
                    pred: str = "pred", keep=()) -> DataFrame:
    """(id, sales) for every horizon row; predictions are joined on the key,
    never aligned by position. A horizon row without a prediction is an error
    (checked with an anti-join, which Spark evaluates distributed)."""
    joined = horizon.join(predictions.select(*key, pred), list(key), "left")
    return joined.select("id", *keep, postprocess(F.col(pred)).alias("sales"), F.col(pred).isNull().alias("_missing"))


def refuse_missing(rows: DataFrame) -> None:
    """An error if any horizon row has no prediction or no id. ``rows`` should be
    read from a checkpoint: they are checked, then used."""
    bad = F.col("sales").isNull() | F.col("id").isNull()
    if "_missing" in rows.columns:
        bad = bad | F.col("_missing")
    if not rows.filter(bad).isEmpty():
        raise ValueError("horizon rows without a prediction")


def write_submission(rows: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write (id, sales), none of them missing (``refuse_missing``)."""
    refuse_missing(rows)
    out = rows.select("id", "sales")
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def save_json(spark: SparkSession, obj: dict, path: str) -> None:
    """Small side file (weights, scores) as one JSON record."""
    spark.createDataFrame([(json.dumps(obj),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str, default: dict | None = None) -> dict | None:
    """Read a side file written by ``save_json``; ``default`` when absent."""
    if "://" not in path and not os.path.exists(path):
        return default
    row = spark.read.text(path).first()
    return json.loads(row[0]) if row else default
