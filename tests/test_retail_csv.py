"""The original CSV layout: loaders and the queries running on RetailSources."""

from __future__ import annotations

import datetime as dt
import shutil
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.plans.catalog import finalize, load_all
from shelfcast.sources.retail import RetailSources, load_holidays, load_raw_data


def _write_csv(df, path):
    df.toPandas().to_csv(path, index=False)


@pytest.fixture(scope="module")
def raw_dir(spark, sample_train, sample_stores, sample_holidays):
    d = tempfile.mkdtemp(prefix="raw-")
    rng = np.random.default_rng(7)
    _write_csv(sample_train, f"{d}/train.csv")
    test_rows = [(1000 + i * 4 + j, dt.date(2017, 1, 31) + dt.timedelta(days=i), s, f, int(rng.integers(0, 2)))
                 for i in range(16) for j, (s, f) in enumerate([(1, "GROCERY I"), (1, "BEVERAGES"),
                                                                 (2, "GROCERY I"), (2, "BEVERAGES")])]
    _write_csv(spark.createDataFrame(test_rows, "id long, date date, store_nbr int, family string, onpromotion int"),
               f"{d}/test.csv")
    _write_csv(sample_stores.withColumnRenamed("store_type", "type"), f"{d}/stores.csv")
    oil = [(dt.date(2017, 1, 1) + dt.timedelta(days=i), None if i == 5 else float(rng.uniform(40, 80)))
           for i in range(46)]
    _write_csv(spark.createDataFrame(oil, "date date, dcoilwtico double"), f"{d}/oil.csv")
    _write_csv(sample_holidays.drop("h_seq"), f"{d}/holidays_events.csv")
    tx = [(dt.date(2017, 1, 1) + dt.timedelta(days=i), s, int(rng.integers(500, 3000)))
          for i in range(30) for s in (1, 2)]
    _write_csv(spark.createDataFrame(tx, "date date, store_nbr int, transactions long"), f"{d}/transactions.csv")
    return d


def test_load_raw_data(spark, raw_dir):
    train, test = load_raw_data(spark, raw_dir)
    assert train.count() == 120 and test.count() == 64
    assert train.filter(F.col("dcoilwtico").isNull()).count() == 0
    assert "transactions" in train.columns and "transactions" not in test.columns
    assert "store_type" in train.columns


def test_missing_file_raises(spark):
    with pytest.raises(FileNotFoundError):
        load_raw_data(spark, tempfile.mkdtemp(prefix="empty-"))


@pytest.mark.parametrize("name", ["lag_features", "rolling_features", "holiday_flags", "holiday_local_match",
                                  "tx_features", "hier_store", "target_stats_applied", "fallback_forecast",
                                  "submission", "eda_kpis", "calendar_features"])
def test_queries_run_on_retail_files(spark, raw_dir, name):
    src = RetailSources(spark, raw_dir)
    out = finalize(load_all()[name].fn(src))
    assert out.count() > 0


def test_retail_submission_keeps_file_ids(spark, raw_dir):
    src = RetailSources(spark, raw_dir)
    sub = load_all()["submission"].fn(src)
    ids = sorted(r.id for r in sub.collect())
    assert ids == list(range(1000, 1064))
    assert sub.filter(F.col("sales") < 0).count() == 0


def test_feature_matrix_on_retail_files(spark, raw_dir):
    from shelfcast.plans.features import build_features, feature_columns, training_matrix
    m = training_matrix(build_features(RetailSources(spark, raw_dir)))
    cols = feature_columns(m)
    for c in ["day_of_week", "month", "sales_lag_16", "oil_lag_7", "oil_rolling_mean_28", "is_holiday",
              "days_to_next_holiday", "transactions_lag_16", "sf_mean", "store_total_lag_16",
              "is_effective_holiday", "payday_decay", "family_x_store_type"]:
        assert c in m.columns, c
    assert not {"sales", "id", "date"} & set(cols) and len(cols) > 100
    assert m.count() == 46 * 4              # 30 train + 16 horizon days, 4 series
    assert "transactions" not in m.columns   # same-day transactions are not a feature


def test_horizon_is_as_long_as_the_file_says(spark, raw_dir):
    """20 days in test.csv give 20 submission rows a series."""
    d = shutil.copytree(raw_dir, tempfile.mkdtemp(prefix="raw20-") + "/raw")
    rows = [(1000 + i * 4 + j, dt.date(2017, 1, 31) + dt.timedelta(days=i), s, f, 0)
            for i in range(20) for j, (s, f) in enumerate([(1, "GROCERY I"), (1, "BEVERAGES"),
                                                            (2, "GROCERY I"), (2, "BEVERAGES")])]
    _write_csv(spark.createDataFrame(rows, "id long, date date, store_nbr int, family string, onpromotion int"), f"{d}/test.csv")
    sub = load_all()["submission"].fn(RetailSources(spark, d))
    assert sorted(r.id for r in sub.collect()) == list(range(1000, 1080))


def test_replaced_inputs_give_new_results(spark, raw_dir):
    """Session tables follow the files under their path."""
    d = shutil.copytree(raw_dir, tempfile.mkdtemp(prefix="rawnew-") + "/raw")
    before = load_all()["submission"].fn(RetailSources(spark, d)).agg(F.sum("sales")).first()[0]
    text = spark.read.option("header", True).csv(f"{d}/train.csv").toPandas()
    text["sales"] = text["sales"].astype(float) * 10
    text.to_csv(f"{d}/train.csv", index=False)
    spark.catalog.refreshByPath(d)
    after = load_all()["submission"].fn(RetailSources(spark, d)).agg(F.sum("sales")).first()[0]
    assert after == pytest.approx(10 * before, rel=1e-6)


def test_holiday_order_over_several_files(spark, tmp_path):
    """A folder of two files, the second one larger (Spark reads it first): the
    first file's row of a day comes first, and rows of a file keep their order."""
    folder = tmp_path / "holidays_events.csv"
    folder.mkdir()
    head = "date,type,locale,locale_name,description,transferred\n"
    (folder / "a.csv").write_text(head + "2017-01-01,Holiday,Local,Quito,first,false\n")
    (folder / "b.csv").write_text(head + "".join(
        f"2017-01-01,Holiday,National,Ecuador,later {i:03d},false\n" for i in range(200)))
    rows = load_holidays(spark, str(tmp_path)).orderBy("h_seq").collect()
    assert [r.description for r in rows] == ["first", *(f"later {i:03d}" for i in range(200))]
    first = load_holidays(spark, str(tmp_path)).groupBy("date").agg(F.min_by("locale", "h_seq").alias("locale")).collect()
    assert [r.locale for r in first] == ["Local"]
