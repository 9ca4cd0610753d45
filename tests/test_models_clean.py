"""Model pipelines on a small fixture, cleaning operators with exact cases."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from shelfcast.operators import clean
from shelfcast.plans import models as ml


@pytest.fixture(scope="module")
def model_frame(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(200):
        a, b, c = rng.normal(size=3)
        rows.append((1, "A", dt.date(2017, 1, 1) + dt.timedelta(days=i), float(abs(rng.normal()) * 10 + 50),
                     float(a), float(b), float(c)))
    return spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double, "
                                       "f1 double, f2 double, f3 double")


def test_tweedie_predicts_nonnegative_and_roundtrips(spark, model_frame):
    model = ml.tweedie_pipeline(["f1", "f2", "f3"], 1.5).fit(model_frame)
    p = ml.predict_clipped(model, model_frame)
    assert p.count() == 200 and p.filter(F.col("pred") < 0).count() == 0
    path = os.path.join(tempfile.mkdtemp(prefix="model-"), "m")
    model.write().overwrite().save(path)
    again = ml.predict_clipped(PipelineModel.load(path), model_frame, "pred2")
    diff = p.join(again.drop("sales"), ["store_nbr", "family", "date"]).select(
        F.max(F.abs(F.col("pred") - F.col("pred2")))).first()[0]
    assert diff == pytest.approx(0.0, abs=1e-9)


def test_gbt_log1p_nonnegative(spark, model_frame):
    md = ml.ModelData(model_frame, model_frame, model_frame, ["f1", "f2", "f3"])
    p = ml.predict_clipped(ml.fit_gbt_log1p(md, max_iter=5), model_frame, log_target=True)
    assert p.count() == 200 and p.filter(F.col("pred") < 0).count() == 0


def test_hashed_sample_is_deterministic(spark, model_frame):
    a = ml.hashed_sample(model_frame, 3).select("date").collect()
    b = ml.hashed_sample(model_frame.repartition(7), 3).select("date").collect()
    assert sorted(a) == sorted(b) and 100 < len(a) < 180


def test_categorize_rules(spark):
    df = spark.createDataFrame([("sales_lag_16",), ("oil_regime",), ("sf_mean",), ("payday_decay",), ("zzz",)],
                               "feature string")
    got = [r[0] for r in df.select(ml.categorize()).collect()]
    assert got == ["Lag features", "External", "Aggregation", "Temporal", "Aggregation"]


def test_interpolate_linear(spark):
    vals = [None, 1.0, None, None, 4.0, None]
    df = spark.createDataFrame([(dt.date(2017, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)],
                               "date date, x double")
    out = clean.interpolate_linear(df, "x").orderBy("date").toPandas()["x"].tolist()
    assert pd.isna(out[0]) and out[1:] == [1.0, 2.0, 3.0, 4.0, 4.0]


def test_forward_back_fill(spark):
    vals = [None, 2.0, None, 5.0, None]
    df = spark.createDataFrame([(dt.date(2017, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)],
                               "date date, x double")
    out = clean.forward_back_fill(df, "x").orderBy("date").toPandas()["x"].tolist()
    assert out == [2.0, 2.0, 2.0, 5.0, 5.0]


def test_structural_zeros(spark):
    rows = []
    for i in range(6):
        d = dt.date(2017, 1, 1) + dt.timedelta(days=i)
        rows.append((1, "A", d, 0.0 if i < 3 else 1.0))   # leading zeros
        rows.append((1, "B", d, 0.0))                      # never sells
    df = spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")
    kept = clean.filter_structural_zeros(df)
    assert kept.filter(F.col("family") == "A").count() == 3
    assert kept.filter(F.col("family") == "B").count() == 6
    counts = {r.family: r.n_removed for r in clean.structural_zero_counts(df).collect()}
    assert counts == {"A": 3, "B": 0}


def test_missing_feature_guard_and_fill(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b double, c string")
    out = clean.fill_missing_features(clean.ensure_columns(df, ["a", "z"]), exclude=["c"]).first()
    assert out.z == 0 and out.b == 0.0 and out.c == "x"


def test_trees_split_on_categories_and_take_unseen_ones(spark, model_frame):
    """The target depends on the category only, in no order of its codes."""
    level = F.when(F.col("c") == "b", 90.0).otherwise(10.0)
    df = model_frame.withColumn("c", F.element_at(F.array(*map(F.lit, "abcd")), (F.dayofyear("date") % 4 + 1).cast("int")))
    df = df.withColumn("sales", level)
    md = ml.ModelData(df, df, df, ["f1"], df, ["c"])
    model = ml.fit_gbt_raw(md, max_iter=10)
    got = ml.predict_clipped(model, df).join(df.select("date", "c"), "date")
    assert got.filter(F.abs(F.col("pred") - F.col("sales")) > 5).count() == 0
    imp = {r.feature: r.share for r in ml.importance_table(spark, model, ["f1", "c"]).collect()}
    assert imp["c"] > 0.9
    assert ml.predict_clipped(model, df.withColumn("c", F.lit("new"))).filter(F.col("pred").isNull()).count() == 0


def test_early_stopping_keeps_fewer_trees(spark, model_frame):
    noise = model_frame.withColumn("sales", F.rand(3) * 100)
    md = ml.ModelData(noise.filter(F.dayofyear("date") % 2 == 0), noise.filter(F.dayofyear("date") % 2 == 1),
                      noise, ["f1", "f2", "f3"])
    _, used = ml.fit_gbt_early_stopped(md, max_iter=30)
    assert 1 <= used < 30


def one_class(model_frame, sales):
    """Model data whose training rows all sell, or none does; validation has both."""
    train = model_frame.withColumn("sales", F.expr(sales))
    return ml.ModelData(train, model_frame.withColumn("sales", F.when(F.col("f1") > 0, F.col("sales")).otherwise(0.0)),
                        model_frame, ["f1", "f2", "f3"], train, [])


@pytest.mark.parametrize("sales, p", [("sales", 1.0), ("0 * sales", 0.0)])
def test_zero_classifier_of_one_class(model_frame, monkeypatch, sales, p):
    from shelfcast.plans import q_models
    monkeypatch.setattr(q_models, "data", lambda src: one_class(model_frame, sales))
    got = q_models.fit_zero_classifier(None).collect()
    assert len(got) == 200 and {r.p_nonzero for r in got} == {p} and {r.is_nonzero for r in got} == {0, 1}


def test_hurdle_where_every_training_row_sells(spark, model_frame, monkeypatch):
    """The probability is 1 then, so the hurdle is the amount alone, and the horizon is predicted whole."""
    from shelfcast.plans import q_models
    named = model_frame.withColumnsRenamed({"f1": "sales_lag_16", "f2": "onpromotion", "f3": "sf_mean"})
    md = ml.ModelData(named.filter("date < '2017-06-01'"), named.filter("date >= '2017-06-01'"),
                      named.withColumn("sales", F.lit(None).cast("double")), ["sales_lag_16", "onpromotion", "sf_mean"], named, [])
    monkeypatch.setattr(q_models, "data", lambda src: md)
    got = {r.date: r for r in q_models.fit_hurdle(None).collect()}
    assert len(got) == 200 and {r.threshold for r in got.values()} == {min(q_models.fc.F1_THRESHOLDS)}
    methods = {r.method for r in got.values()}
    assert len(methods) == 1 and methods <= {"hard", "soft", "baseline", "blend"}
    amount, base = (ml.predict_clipped(ml.fit_tweedie(ml.refit_data(md), power), md.horizon).collect() for power in (1.3, 1.2))
    for a, b in zip(sorted(amount), sorted(base)):
        expected = {"hard": a.pred, "soft": a.pred, "baseline": b.pred, "blend": 0.5 * a.pred + 0.5 * b.pred}
        assert got[a.date].pred == pytest.approx(expected[got[a.date].method], rel=1e-6)


def test_hurdle_where_no_training_row_sells(model_frame, monkeypatch):
    """The amount is 0 then: fitted on rows before June that never sell, chosen on
    days that sell, refitted on rows of both kinds, or of the first kind only."""
    from shelfcast.plans import q_models
    named = model_frame.withColumnsRenamed({"f1": "sales_lag_16", "f2": "onpromotion", "f3": "sf_mean"})
    late = named.withColumn("sales", F.when(F.col("date") >= "2017-06-01", F.col("sales")).otherwise(0.0))
    never = named.withColumn("sales", F.lit(0.0))
    horizon = named.withColumn("sales", F.lit(None).cast("double"))
    for rows in (late, never):
        md = ml.ModelData(rows.filter("date < '2017-06-01'"), rows.filter("date >= '2017-06-01'"), horizon,
                          ["sales_lag_16", "onpromotion", "sf_mean"], rows, [])
        monkeypatch.setattr(q_models, "data", lambda src: md)
        got = q_models.fit_hurdle(None).collect()
        assert len(got) == 200 and all(np.isfinite([r.pred, r.rmsle_valid]).all() and r.pred >= 0 for r in got)
    assert {(r.pred, r.method, r.rmsle_valid) for r in got} == {(0.0, "hard", 0.0)}


def test_codes_of_unseen_values_are_null(spark):
    from shelfcast.plans.q_matrix import CATEGORICAL, apply_codes
    codes = spark.createDataFrame([(c, v, i) for c in CATEGORICAL for i, v in enumerate(["1", "2"])],
                                  "feature string, value string, code int")
    df = spark.createDataFrame([tuple("2" for _ in CATEGORICAL), tuple("9" for _ in CATEGORICAL)],
                               ", ".join(f"{c} string" for c in CATEGORICAL))
    rows = apply_codes(df, codes).select(*[f"{c}_code" for c in CATEGORICAL]).collect()
    assert set(rows[0]) == {1} and set(rows[1]) == {None}


def test_missing_prediction_stays_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.005,), (0.5,)], "p double")
    assert [r[0] for r in df.select(clean.postprocess(F.col("p"))).collect()] == [None, 0.0, 0.0, 0.5]


def test_features_of_a_fold_do_not_see_its_days(spark):
    """Perturbation: changing sales and transactions after the fold's training
    end changes no feature of its validation days, apart from the lags of the
    gap days that are known by then."""
    from shelfcast.operators import grains
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-03-31')) AS date").withColumn("store_nbr", F.lit(1))
    tx = days.withColumn("transactions", F.dayofyear("date") * 3)
    cut = F.lit(dt.date(2020, 2, 28))
    changed = tx.withColumn("transactions", F.when(F.col("date") > cut, 10 ** 6).otherwise(F.col("transactions")))
    a, b = (grains.transaction_features(days, t, cut).filter(F.col("date") <= F.date_add(cut, 16)).drop("transactions")
            for t in (tx, changed))
    assert a.exceptAll(b).count() == 0
