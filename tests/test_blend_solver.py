"""The continuous weight search, cross-fitted stacking, classes and the guard."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import forecast as fc
from shelfcast.plans import blend_solver as bs
from shelfcast.plans import models as ml
from shelfcast.plans import q_models as q

PREDS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(42)
    y = rng.gamma(2, 20, 400)
    cols = [y * rng.lognormal(m, s, 400) for m, s in ((0.4, 0.3), (-0.5, 0.4), (0.1, 1.5))]
    rows = [tuple(map(float, r)) for r in zip(y, *cols)] + [(None, 1.0, 1.0, 1.0), (3.0, None, 2.0, 4.0)]
    return spark.createDataFrame(rows, "sales double, a double, b double, c double").cache()


def score(rows, w):
    return math.sqrt(np.mean([(math.log1p(sum(x * (r[p] or 0) for x, p in zip(w, PREDS))) - math.log1p(r.sales)) ** 2
                              for r in rows if r.sales is not None]))


def test_never_worse_than_the_grid_or_any_start(frame):
    rows = frame.collect()
    grid = min((score(rows, [i / 20, j / 20, (20 - i - j) / 20]), [i / 20, j / 20, (20 - i - j) / 20])
               for i in range(21) for j in range(21 - i))
    found, w = bs.best_weights(frame, "sales", PREDS, [grid[1]])
    assert found < grid[0] and found == pytest.approx(score(rows, w), rel=1e-9)
    assert min(w) >= 0 and sum(w) == pytest.approx(1)
    starts = bs.drawn_starts(3)
    assert len(starts) == 21 and bs.drawn_starts(3) == starts
    for (reached, _), start in zip(bs.solve(frame, "sales", PREDS, starts), starts):
        assert reached <= score(rows, start) + 1e-12
        assert reached == pytest.approx(found, rel=1e-4)       # one minimum, from anywhere
    # no nearby point of the simplex is better
    rng = np.random.default_rng(1)
    assert all(score(rows, bs.onto_simplex(np.array(w) + rng.normal(0, 0.01, 3))) >= found - 1e-9 for _ in range(50))


def test_useless_predictors_and_empty_input(spark, frame):
    perfect = frame.where("sales is not null").withColumn("a", F.col("sales"))
    found, w = bs.best_weights(perfect, "sales", PREDS)
    assert found < 1e-4 and w[0] == pytest.approx(1, abs=1e-3)
    assert math.isnan(bs.best_weights(frame.limit(0), "sales", PREDS)[0])


def test_ridge_by_normal_equations(frame):
    rows = frame.where("sales is not null and a is not null")
    data = np.array([[r[c] for c in (*PREDS, "sales")] for r in rows.collect()])
    x, y = data[:, :-1], data[:, -1]
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z / len(y) + 0.1 * np.eye(3), z.T @ (y - y.mean()) / len(y)) / x.std(0)
    got = q.ridge_coefficients(rows, PREDS)
    assert got[1:] == pytest.approx(beta, rel=1e-8) and got[0] == pytest.approx(y.mean() - beta @ x.mean(0), rel=1e-8)


def test_feature_classes(spark):
    names = {"sales_rolling_mean_7": "Rolling stats", "sales_lag_16": "Lag features", "promo_lag_1": "Promotion",
             "oil_lag_7": "External", "transactions_lag_16": "External", "day_of_week": "Temporal", "sf_dow_mean": "Temporal",
             "is_holiday": "Temporal", "sf_mean": "Aggregation", "family_x_cluster": "Cross", "oil_rolling_7": "Rolling stats"}
    names["is_holiday"] = "Temporal" if "day" in "is_holiday" else "External"
    rows = spark.createDataFrame([(n,) for n in names], "feature string").select("feature", ml.categorize().alias("c")).collect()
    assert {r.feature: r.c for r in rows} == names


def test_a_missing_feature_is_zero(spark):
    rows = spark.createDataFrame([(1, "f", i, float(i % 5), float(i % 3), float(i % 4)) for i in range(60)],
                                 "store_nbr int, family string, date int, sales double, u double, v double")
    model = ml.tweedie_pipeline(["u", "v"], 1.5).fit(rows)
    lacking = ml.predict_clipped(model, rows.drop("v")).collect()
    zero = ml.predict_clipped(model, rows.withColumn("v", F.lit(0))).collect()
    assert sorted(map(tuple, lacking)) == sorted(map(tuple, zero))


def test_weights_of_the_grid_are_a_start(frame):
    best = fc.best_of(fc.grid_scores(frame.dropna(), "sales", PREDS, None, 20), ["w1", "w2", "w3"]).first()
    assert bs.best_weights(frame.dropna(), "sales", PREDS, [[best.w1, best.w2, best.w3]])[0] <= best.rmsle + 5e-7
