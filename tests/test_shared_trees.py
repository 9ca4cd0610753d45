"""Trees of all trials and folds grown together score like separate fits."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.metrics import rmsle
from shelfcast.plans import models as ml
from shelfcast.plans import q_models as q
from shelfcast.plans import shared_trees as st

PARAMS = [{"depth": 3, "step": 0.1, "subsample": 1.0, "min_instances": 1},
          {"depth": 4, "step": 0.2, "subsample": 1.0, "min_instances": 20}]


@pytest.fixture(scope="module")
def tree_data(spark):
    """120 days of 10 series; numbers of few values, and categories."""
    rng = np.random.default_rng(7)
    rows = []
    for store in range(5):
        for family in ("A", "B"):
            for d in range(120):
                x, z = int(rng.integers(0, 40)), float(rng.integers(0, 9))
                sales = max(0.0, 3.0 * (x > 20) + z * (family == "B") + store + float(rng.normal(0, 1)))
                rows.append((store, family, dt.date(2020, 1, 1) + dt.timedelta(d), sales, x, z,
                             str(int(rng.integers(0, 12)))))
    df = spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double, x int, z double, kind string")
    return ml.ModelData(df.repartition(3).checkpoint(), None, None, ["x", "z"], None, ["family", "kind"])


def flagged(md, folds=2):
    return q._fold_rows(md, ["store_nbr", "date", *md.features, *md.categorical], folds)


def scored(md, params, **kw):
    return st.shared_trees(flagged(md), md.features, md.categorical, params, 2, trees=3, bins=64, seed=42, **kw)


def test_scores_equal_separate_fits(tree_data):
    got = scored(tree_data, PARAMS)
    rows = flagged(tree_data)
    for t, p in enumerate(PARAMS):
        for f in (0, 1):
            train = rows.where(f"_fold{f} = 1").withColumn("log_sales", F.log1p("sales"))
            model = ml.gbt_pipeline(["x", "z"], "log_sales", max_iter=3, categorical=["family", "kind"], **p).fit(train)
            own = ml.predict_clipped(model, rows.where(f"_fold{f} = 2"), log_target=True).agg(rmsle("sales", "pred")).first()[0]
            assert got[t, f] == pytest.approx(own, rel=1e-3)


def test_blocks_do_not_change_scores(tree_data):
    params = [*PARAMS, {"depth": 4, "step": 0.1, "subsample": 0.6, "min_instances": 3}]
    one, many = scored(tree_data, params), scored(tree_data, params, block=100)
    assert np.allclose(one, many, rtol=1e-4) and np.isfinite(one).all()


def test_a_missing_feature_is_an_error(tree_data):
    holes = flagged(tree_data).withColumn("z", F.when(F.col("x") > 3, F.col("z")))
    with pytest.raises(Exception, match="features must be finite"):
        st.shared_trees(holes, ["x", "z"], [], PARAMS, 2, trees=1, bins=64, seed=1)


def test_no_trial_is_fitted_apart(tree_data, monkeypatch):
    def apart(*args, **kwargs):
        raise AssertionError("a trial's model was fitted on its own")

    monkeypatch.setattr(ml, "gbt_pipeline", apart)
    rows = q.tune(tree_data, "gbt_log1p", trials=4, folds=2, max_iter=1)
    assert [(r[0], r[2]) for r in rows] == [(t, f) for t in range(4) for f in range(2)]
    assert all(math.isfinite(r[3]) and r[4] is None for r in rows)


def test_sums_are_exact():
    rng = np.random.default_rng(1)
    codes, target, slot = rng.integers(0, 7, (2, 5000)).astype(np.uint8), rng.normal(0, 3, 4000), rng.integers(0, 4, 4000)
    unit, both = st.sums_of(codes, [7, 7], slot, 3, target)
    count = np.rint(both / unit)
    for s in range(3):
        for b in range(7):
            mine = (slot == s) & (codes[1, :4000] == b)
            assert count[s, 7 + b] == mine.sum()
            assert both[s, 7 + b] - count[s, 7 + b] * unit == pytest.approx(target[mine].sum(), abs=1e-4)


def test_split_orders_categories_by_mean():
    count = np.array([[10.0, 10, 10, 10, 10, 10, 10, 0]])          # a number of 4 bins, a category of 4
    total = np.array([[20.0, 10, 10, 20, 0, 60, 0, 0]])
    count[0, 4:] = [10, 20, 10, 0]
    feature, left, sides, mean = st.best_splits(count, total, [4, 4], 1, 1)
    assert feature[0] == 1 and left[0].tolist() == [True, False, True, False]
    assert sides[0].tolist() == [0.0, 3.0, 20.0, 20.0] and mean[0] == 1.5
    assert st.best_splits(count, total, [4, 4], 1, 21)[0][0] == -1
