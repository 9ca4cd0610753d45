"""The registered searches run whole; proposals and shared fits are right."""

from __future__ import annotations

import inspect
import math
import random

import numpy as np
import pytest

from shelfcast.plans import models as ml
from shelfcast.plans import q_models as q
from shelfcast.plans import tuning


def test_registered_tree_search_is_whole(monkeypatch):
    asked = []
    signature = inspect.signature(q.tune)

    def tune(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        asked.append(bound.arguments)
        return []

    monkeypatch.setattr(q, "tune", tune)
    monkeypatch.setattr(q, "data", lambda src: None)
    monkeypatch.setattr(q, "_ranked_trials", lambda src, rows: rows)
    q.tune_trees(None)
    assert [(a["estimator"], a["trials"], a["folds"], a["max_iter"]) for a in asked] == [("gbt_log1p", 50, 3, ml.TREE_COUNT)]


def test_glm_search_is_whole(monkeypatch):
    asked = []

    def shared_fits(rows, features, params, folds):
        asked.extend(params)
        return None, np.array([[p["power"] + f for f in range(folds)] for p in params])

    monkeypatch.setattr(tuning, "shared_fits", shared_fits)
    rows = q.tune_tweedie(None, [])
    assert len(asked) == 50 and len(rows) == 150
    assert [(r[0], r[2]) for r in rows] == [(t, f) for t in range(50) for f in range(3)]
    again = list(asked)
    asked.clear()
    assert q.tune_tweedie(None, []) == rows and asked == again          # follows from the seed


SPACE = {"a": tuning.Uniform(0.0, 10.0), "b": tuning.Uniform(1e-4, 1.0, log=True), "c": tuning.Uniform(1, 9, whole=True)}


def known(p):
    return (p["a"] - 7) ** 2 / 10 + (math.log10(p["b"]) + 2) ** 2 + abs(p["c"] - 3) / 4


def searched(seed, trials=60):
    search = tuning.Parzen(SPACE, seed)
    for _ in range(trials):
        p = search.ask()
        search.tell(p, known(p))
    return search.told


def test_proposals_find_a_known_minimum():
    assert searched(1) == searched(1)
    found, drawn = [], []
    for seed in range(30):
        told = searched(seed)
        assert all(0 <= p["a"] <= 10 and 1e-4 <= p["b"] <= 1 and p["c"] in range(1, 10) for p, _ in told)
        found.append(min(s for _, s in told))
        rng = random.Random(1000 + seed)
        drawn.append(min(known({k: u.outer(rng.uniform(u.inner(u.low), u.inner(u.high))) for k, u in SPACE.items()}) for _ in told))
    assert sum(found) < sum(drawn) / 2
    assert sum(a < b for a, b in zip(found, drawn)) > 22


def test_a_failed_trial_is_the_worst():
    search = tuning.Parzen(SPACE, 3, start=1)
    first, second = search.ask(), search.ask()
    search.tell(first, math.nan)
    search.tell(second, 5.0)
    assert [s for _, s in search.told] == [math.inf, 5.0]


@pytest.fixture(scope="module")
def glm_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 3)) * [1, 20, 0.1] + [0, 5, 2]
    mu = np.exp(0.5 + x @ [0.4, 0.02, 3.0] - 6)
    y = rng.poisson(rng.gamma(2, mu / 2)).astype(float)
    rows = [(*map(float, r), float(v), 1.0, int(i % 5 != 0) + 2 * int(i % 5 == 0), 1 if i % 3 else 2)
            for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "u double, v double, w double, sales double, one double, _fold0 int, _fold1 int")


def test_shared_fits_equal_separate_ones(glm_rows):
    params = [{"power": 1.1, "reg": 1e-3}, {"power": 1.5, "reg": 1e-2}, {"power": 1.9, "reg": 1e-1}]
    coef, score = tuning.shared_fits(glm_rows.repartition(5), ["u", "v", "w"], params, 2, steps=40)
    for t, p in enumerate(params):
        for f in (0, 1):
            train = glm_rows.where(f"_fold{f} = 1")
            model = ml.tweedie_pipeline(["u", "v", "w"], p["power"], p["reg"], max_iter=40).fit(train)
            glm = model.stages[-1]
            assert np.allclose(coef[t, f], [glm.intercept, *glm.coefficients], rtol=2e-3, atol=2e-3)
            rows = model.transform(glm_rows.where(f"_fold{f} = 2")).select("sales", "pred").collect()
            own = math.sqrt(sum((math.log1p(r.pred) - math.log1p(r.sales)) ** 2 for r in rows) / len(rows))
            assert score[t, f] == pytest.approx(own, rel=1e-3)


def test_a_constant_feature_and_missing_values(glm_rows):
    from pyspark.sql import functions as F
    holes = glm_rows.withColumn("u", F.when(F.col("v") > 5, F.col("u")))
    coef, score = tuning.shared_fits(holes, ["u", "one"], [{"power": 1.5, "reg": 1e-3}], 2)
    assert np.isfinite(score).all() and (coef[0, :, 2] == 0).all()
