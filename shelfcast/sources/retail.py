"""Sources over a directory of the original retail CSV files.

``RetailSources`` exposes the same attributes as ``PanelSources`` (panel,
stores, oil, holidays, transactions, calendar, series, families, cut dates),
so every query and operator runs unchanged on train.csv / test.csv /
stores.csv / oil.csv / holidays_events.csv / transactions.csv.
``load_raw_data`` is the loader's five left joins.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators.clean import clean_holidays, forward_back_fill
from shelfcast.operators.densify import densify
from shelfcast.sources.panel import PanelSources
from shelfcast.sources.tables import read_retail_csv


def load_train(spark: SparkSession, raw_dir: str) -> DataFrame:
    """train.csv with sales clipped at 0 (a null target stays null)."""
    t = read_retail_csv(spark, raw_dir, "train")
    return t.withColumn("sales", F.when(F.col("sales").isNotNull(), F.greatest("sales", F.lit(0.0))))


def load_stores(spark: SparkSession, raw_dir: str) -> DataFrame:
    return read_retail_csv(spark, raw_dir, "stores").withColumnRenamed("type", "store_type")


def load_oil(spark: SparkSession, raw_dir: str) -> DataFrame:
    """oil.csv forward- then back-filled in date order (date grain)."""
    return forward_back_fill(read_retail_csv(spark, raw_dir, "oil"), "dcoilwtico", "date")


def load_holidays(spark: SparkSession, raw_dir: str) -> DataFrame:
    """holidays_events.csv with its file order kept as ``h_seq`` (the first
    row of a day decides its scope) and ``is_transferred``. The order is by file
    name, start of the split and row, as Spark reads larger files first."""
    h = read_retail_csv(spark, raw_dir, "holidays_events")
    return clean_holidays(h.withColumn("h_seq", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"))))


def load_raw_data(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train ⟕ stores ⟕ oil ⟕ transactions, test ⟕ stores ⟕ oil)."""
    stores, oil = load_stores(spark, raw_dir), load_oil(spark, raw_dir)
    tx = read_retail_csv(spark, raw_dir, "transactions")
    train = (load_train(spark, raw_dir).join(stores, "store_nbr", "left")
             .join(oil, "date", "left").join(tx, ["date", "store_nbr"], "left"))
    test = read_retail_csv(spark, raw_dir, "test").join(stores, "store_nbr", "left").join(oil, "date", "left")
    return train, test


class RetailSources(PanelSources):
    """``PanelSources`` over the retail CSV layout."""

    def __init__(self, spark: SparkSession, raw_dir: str):
        super().__init__(spark, raw_dir)
        self.raw_dir = raw_dir

    def options(self) -> dict:
        return {}

    @property
    def panel_end(self) -> Column:
        """The last day of test.csv: the horizon is as long as the file says."""
        return read_retail_csv(self.spark, self.raw_dir, "test").select(F.max("date")).scalar()

    @cached_property
    def sales_fact(self) -> DataFrame:
        train = load_train(self.spark, self.raw_dir).select("store_nbr", "family", "date", "sales",
                                                            "onpromotion")
        test = read_retail_csv(self.spark, self.raw_dir, "test").select(
            "store_nbr", "family", "date", F.lit(None).cast("double").alias("sales"), "onpromotion")
        return train.unionByName(test)

    @cached_property
    def first_date(self) -> Column:
        return read_retail_csv(self.spark, self.raw_dir, "train").select(F.min("date")).scalar()

    @cached_property
    def train_end(self) -> Column:
        return read_retail_csv(self.spark, self.raw_dir, "train").select(F.max("date")).scalar()

    @cached_property
    def panel(self) -> DataFrame:
        """train ∪ test rows, densified (gaps in train are 0, the horizon stays null)."""
        dense = densify(self.sales_fact, ["store_nbr", "family"], "date", self.first_date, self.panel_end,
                        {"sales": 0.0, "onpromotion": 0})
        in_train = F.col("date") <= self.train_end
        return dense.select("store_nbr", "family", "date",
                            F.when(in_train, F.col("sales")).alias("sales"),
                            F.coalesce("onpromotion", F.lit(0)).cast("int").alias("onpromotion"))

    @cached_property
    def store_list(self) -> DataFrame:
        return self.series.select("store_nbr").distinct()

    @cached_property
    def families(self) -> DataFrame:
        """Not needed for ids here (the files have their own); codes as in the panel."""
        fam = self.sales_fact.select("family").distinct()
        return fam.select("family", (F.dense_rank().over(Window.orderBy("family")) - 1).alias("family_code"))

    @cached_property
    def stores(self) -> DataFrame:
        return load_stores(self.spark, self.raw_dir)

    @cached_property
    def transactions(self) -> DataFrame:
        return read_retail_csv(self.spark, self.raw_dir, "transactions")

    @cached_property
    def oil(self) -> DataFrame:
        return read_retail_csv(self.spark, self.raw_dir, "oil")

    @cached_property
    def holidays(self) -> DataFrame:
        return load_holidays(self.spark, self.raw_dir).drop("is_transferred")

    def with_id(self, df: DataFrame) -> DataFrame:
        """Rows keep the id of the input files (train.csv / test.csv)."""
        ids = (read_retail_csv(self.spark, self.raw_dir, "train").select("id", "date", "store_nbr", "family")
               .unionByName(read_retail_csv(self.spark, self.raw_dir, "test")
                            .select("id", "date", "store_nbr", "family")))
        return df.join(ids, ["date", "store_nbr", "family"], "left")
