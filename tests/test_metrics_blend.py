"""Metrics, post-processing, blends, folds (exact cases of the original tests)."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.metrics import rmsle, roc_auc
from shelfcast.operators import forecast as fc
from shelfcast.operators.clean import clean_sales, postprocess
from shelfcast.operators.folds import fold_counts, tag_folds


def _rmsle(spark, y, p):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    return df.agg(rmsle("y", "p")).first()[0]


def test_rmsle_formula(spark):
    y, p = [1, 2, 3], [1.5, 2.5, 3.5]
    expected = math.sqrt(np.mean((np.log1p(p) - np.log1p(y)) ** 2))
    assert _rmsle(spark, y, p) == pytest.approx(expected)


def test_rmsle_clips_negative_predictions(spark):
    assert _rmsle(spark, [1, 2], [-1, -5]) > 0
    assert _rmsle(spark, [1, 2, 3], [1, 2, 3]) == 0.0


def test_postprocess(spark):
    df = spark.createDataFrame([(x,) for x in [0.001, 0.005, 0.5, 10.0, -3.0]], "p double")
    assert [r[0] for r in df.select(postprocess(F.col("p"))).collect()] == [0.0, 0.0, 0.5, 10.0, 0.0]


def test_weighted_blend(spark):
    df = spark.createDataFrame([(10.0, 20.0), (20.0, 40.0), (-50.0, -10.0)], "a double, b double")
    out = [r[0] for r in df.select(fc.weighted_blend(["a", "b"], [0.7, 0.3])).collect()]
    assert out[:2] == pytest.approx([13.0, 26.0])
    assert out[2] == 0.0
    with pytest.raises(ValueError):
        fc.weighted_blend(["a", "b"], [1.0])


def test_simplex_grid_search(spark):
    rng = np.random.default_rng(42)
    y = rng.uniform(0, 100, 100)
    rows = [(float(t), float(t + rng.normal(0, 5)), float(t + rng.normal(0, 20))) for t in y]
    df = spark.createDataFrame(rows, "sales double, p1 double, p2 double")
    scores = fc.grid_scores(df, "sales", ["p1", "p2"], None, 20)
    assert scores.count() == 21
    best = fc.best_of(scores, ["w1", "w2"]).first()
    assert best.w1 >= 0 and best.w2 >= 0 and best.w1 + best.w2 == pytest.approx(1.0)
    assert best.w1 > best.w2          # the less noisy predictor gets more weight


def test_segment_grid_equals_direct(spark):
    rng = np.random.default_rng(1)
    rows = [(float(rng.uniform(0, 50)), float(rng.uniform(0, 50)), float(rng.uniform(0, 50)), bool(i % 3 == 0))
            for i in range(60)]
    df = spark.createDataFrame(rows, "sales double, a double, b double, hi boolean")
    grid = fc.segment_alpha_grid(df, "sales", "a", "b", F.col("hi"), steps=4).toPandas()
    pdf = df.toPandas()
    for _, g in grid.iterrows():
        al = np.where(pdf.hi, g.alpha_high, g.alpha_rest)
        pred = np.maximum(al * pdf.a + (1 - al) * pdf.b, 0)
        direct = math.sqrt(np.mean((np.log1p(pred) - np.log1p(pdf.sales)) ** 2))
        assert g.rmsle == pytest.approx(direct)


def test_time_folds(spark):
    rows = [(dt.date(2017, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "date date, value double")
    mx, mn = F.lit(dt.date(2017, 4, 10)), F.lit(dt.date(2017, 1, 1))
    tagged = tag_folds(df, mx, mn, n_splits=3).toPandas()
    assert sorted(tagged.fold.unique()) == [0, 1, 2]
    for f, g in tagged.groupby("fold"):
        tr, va = g[g.role == "train"].date, g[g.role == "val"].date
        assert (min(va) - max(tr)).days >= 16
        assert va.nunique() <= 16
        assert set(tr).isdisjoint(set(va))
    counts = fold_counts(tag_folds(df, mx, mn, n_splits=3)).toPandas()
    assert len(counts) == 6


def test_auc_matches_rank_formula(spark):
    rows = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4), (1, 0.8), (0, 0.3)]
    df = spark.createDataFrame(rows, "y int, s double")
    auc = roc_auc(df, "y", "s").first().auc
    # pairs (pos, neg): 9 pairs, ties count 1/2
    wins = sum((p > n) + 0.5 * (p == n) for yp, p in rows if yp == 1 for yn, n in rows if yn == 0)
    assert auc == pytest.approx(wins / 9)


def test_clean_sales(spark, sample_train):
    dirty = sample_train.withColumn("sales", F.when(F.col("id") == 0, -5.0).otherwise(F.col("sales"))) \
        .withColumn("onpromotion", F.when(F.col("id") == 1, F.lit(None)).otherwise(F.col("onpromotion")))
    out = clean_sales(dirty)
    assert out.filter(F.col("sales") < 0).count() == 0
    assert out.filter(F.col("onpromotion").isNull()).count() == 0


def test_f1_sweep(spark):
    rows = [(1, 0.8), (1, 0.6), (0, 0.5), (0, 0.2)]
    df = spark.createDataFrame(rows, "y int, p double")
    sw = {round(r.threshold, 2): r.f1 for r in fc.f1_sweep(df, F.col("y"), F.col("p")).collect()}
    assert sw[0.55] == pytest.approx(1.0)
    assert sw[0.7] == pytest.approx(2 / 3)
