"""Tweedie-loss trees: the deviance falls, leaves are the aggregates they claim to be."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import functions as F

from shelfcast.plans import boosting

KEY = ("store_nbr", "family", "date")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    out = []
    for i in range(1600):
        x, kind = rng.normal(size=3), "abcd"[i % 4]
        mu = math.exp(0.3 + 0.8 * x[0] - 0.5 * (x[1] > 0) + 0.6 * (kind == "c"))
        y = float(rng.poisson(rng.gamma(2, mu / 2)))
        out.append((i, kind, i // 40, *map(float, x), y))
    return spark.createDataFrame(out, "store_nbr int, family string, date int, u double, v double, w double, sales double").cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return boosting.fit(rows.where("date < 30"), rows.where("date >= 30"), ["u", "v", "w"], ["family"], power=1.4, rounds=12,
                        depth=3, row_share=0.8, column_share=0.75, min_instances=5, step=0.2, seed=1)


def test_every_round_lowers_the_deviance(fitted):
    rounds, falls, scores = zip(*fitted.history)
    assert rounds == tuple(range(1, 13))
    assert all(b < a for a, b in zip(falls, falls[1:]))
    assert fitted.best == min(zip(scores, rounds))[1]
    assert all(len(r.columns) == 3 for r in fitted.rounds) and len({tuple(r.columns) for r in fitted.rounds}) > 1


def test_it_beats_the_mean_and_never_is_negative(rows, fitted):
    valid = rows.where("date >= 30")
    got = fitted.predict(valid).select("sales", "pred").collect()
    mean = rows.where("date < 30").agg(F.avg("sales")).first()[0]
    error = lambda p: math.sqrt(np.mean([(math.log1p(p(r)) - math.log1p(r.sales)) ** 2 for r in got]))
    assert min(r.pred for r in got) > 0
    assert error(lambda r: r.pred) < 0.9 * error(lambda r: mean)
    assert error(lambda r: r.pred) == pytest.approx(fitted.history[fitted.best - 1][2], rel=1e-9)


def test_leaf_values_of_a_round_by_sql(spark, rows, fitted):
    before = fitted.predict(rows.where("date < 30"), "mu", rounds=3)
    r = fitted.rounds[3]
    r.tree.setFeaturesCol("_some").setLeafCol("leaf")
    sliced = VectorSlicer(inputCol="features", outputCol="_some", indices=r.columns).transform(fitted.assembled(before))
    r.tree.transform(sliced).select(*KEY, "sales", "mu", "leaf").createOrReplaceTempView("leaves")
    got = spark.sql("""
        SELECT CAST(leaf AS INT) AS leaf,
               sum(sales * pow(mu, -0.4) - pow(mu, 0.6)) / (sum(0.4 * sales * pow(mu, -0.4) + 0.6 * pow(mu, 0.6)) + 0.1) AS v
        FROM leaves WHERE pmod(xxhash64(store_nbr, family, date, 1, 4), 10000) < 8000 GROUP BY leaf""").collect()
    assert {x.leaf: pytest.approx(x.v, rel=1e-9) for x in got} == r.values


def test_it_stops_when_patience_ends(rows):
    noise = rows.withColumn("u", F.rand(3)).withColumn("sales", F.floor(F.rand(4) * 4).cast("double"))
    model = boosting.fit(noise.where("date < 20"), noise.where("date >= 20"), ["u", "v"], power=1.5, rounds=40, depth=5,
                         min_instances=1, step=0.8, patience=3, seed=2)
    assert len(model.rounds) < 40 and len(model.rounds) - model.best == 3


def test_labels_must_be_positive_somewhere(rows):
    with pytest.raises(ValueError, match="positive"):
        boosting.fit(rows.withColumn("sales", F.lit(0.0)), None, ["u"])


def test_parameters_by_power():
    assert [boosting.tier(p)["min_instances"] for p in (1.0, 1.1, 1.2, 1.3, 1.5)] == [50, 50, 40, 40, 30]
