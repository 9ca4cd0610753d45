"""Scans of the raw tables.

Explicit schemas for the retail CSV layout (never ``inferSchema``) and a
parquet reader for the star-schema test tables. Readers fail at plan time
with a clear error when an input is missing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Retail layout of the input files (one table per file).
RETAIL_SCHEMAS = {
    "train": T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()),
        T.StructField("family", T.StringType()),
        T.StructField("sales", T.DoubleType()),
        T.StructField("onpromotion", T.IntegerType()),
    ]),
    "test": T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()),
        T.StructField("family", T.StringType()),
        T.StructField("onpromotion", T.IntegerType()),
    ]),
    "stores": T.StructType([
        T.StructField("store_nbr", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("cluster", T.IntegerType()),
    ]),
    "oil": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("dcoilwtico", T.DoubleType()),
    ]),
    "holidays_events": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("type", T.StringType()),
        T.StructField("locale", T.StringType()),
        T.StructField("locale_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("transferred", T.BooleanType()),
    ]),
    "transactions": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()),
        T.StructField("transactions", T.LongType()),
    ]),
    "sample_submission": T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("sales", T.DoubleType()),
    ]),
}


def _require(path: str) -> str:
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(f"input not found: {path}")
    return path


def read_parquet_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table ``{root}/{name}.parquet``; pruning/pushdown by Catalyst."""
    return spark.read.parquet(_require(f"{root}/{name}.parquet"))


def read_retail_csv(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """A retail CSV file with its fixed schema (header row, ISO dates)."""
    path = _require(f"{raw_dir}/{name}.csv")
    return (spark.read.schema(RETAIL_SCHEMAS[name])
            .option("header", True).option("dateFormat", "yyyy-MM-dd")
            .csv(path))
