"""Gradient boosting with Tweedie loss (log link), on Spark's regression trees.

A round takes the gradient ``g`` and curvature ``h`` of the Tweedie deviance at
the current scores, fits a tree to ``g / h`` weighted by ``h`` on a sample of the
rows and columns, and re-estimates the value of each leaf by one aggregate over
the leaves, ``sum(g) / (sum(h) + reg_lambda)``. Scores are the sums of the leaves'
values times the step; the forecast is their exponential, so never negative.

The score of every round on the validation rows is kept (``history``). Boosting
stops when ``patience`` rounds brought no better one; the model is cut to the
best round. Rows are written to the checkpoint folder every ``CUT`` rounds, so
that a plan never holds more trees than that.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import chain

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import squared_log_error
from shelfcast.session import cut_lineage

CUT = 5
SCORE_LIMIT = 30.0

# fixed values: sampling and leaf size by variance power (cut at 1.1 and 1.3)
POWER_TIERS = [
    (1.1, {"column_share": 0.7, "row_share": 0.7, "min_instances": 50, "reg_lambda": 0.1}),
    (1.3, {"column_share": 0.65, "row_share": 0.75, "min_instances": 40, "reg_lambda": 0.15}),
    (9.9, {"column_share": 0.7, "row_share": 0.7, "min_instances": 30, "reg_lambda": 0.1}),
]


def tier(power: float) -> dict:
    return next(dict(p) for cut, p in POWER_TIERS if power <= cut)


def gradient(y: Column, score: Column, power: float) -> tuple[Column, Column]:
    """Negative gradient and curvature of the deviance by the score."""
    one, two = F.exp((1 - power) * score), F.exp((2 - power) * score)
    return y * one - two, (power - 1) * y * one + (2 - power) * two


def deviance(y: Column, score: Column, power: float) -> Column:
    """Half the unit deviance, without what depends on the label only."""
    if power == 1:
        return F.exp(score) - y * score
    if power == 2:
        return y * F.exp(-score) + score
    return F.exp((2 - power) * score) / (2 - power) - y * F.exp((1 - power) * score) / (1 - power)


@dataclass
class Round:
    tree: DecisionTreeRegressionModel
    columns: list[int]                 # of the assembled vector
    values: dict[int, float]           # by leaf

    def step(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the value of the leaf each row falls into."""
        self.tree.setFeaturesCol("_bt_some").setLeafCol("_bt_leaf").setPredictionCol("_bt_pred")
        sliced = VectorSlicer(inputCol="features", outputCol="_bt_some", indices=self.columns)
        leaves = F.create_map(*chain.from_iterable((F.lit(float(k)), F.lit(v)) for k, v in self.values.items()))
        out = self.tree.transform(sliced.transform(df)).withColumn(name, F.coalesce(leaves[F.col("_bt_leaf")], F.lit(0.0)))
        return out.drop("_bt_some", "_bt_leaf", "_bt_pred")


@dataclass
class TweedieBoost:
    """A fitted model: predict() adds the rounds up to the best one."""
    power: float
    step: float
    start: float
    features: list[str]
    indexer: StringIndexerModel | None
    rounds: list[Round] = field(default_factory=list)
    history: list[tuple[int, float, float | None]] = field(default_factory=list)
    best: int = 0

    def assembled(self, df: DataFrame) -> DataFrame:
        if self.indexer is not None:
            df = self.indexer.transform(df)
        names = [*self.features, *(self.indexer.getOutputCols() if self.indexer is not None else [])]
        return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(df)

    def predict(self, df: DataFrame, col: str = "pred", rounds: int | None = None) -> DataFrame:
        """``df`` with the forecast; by the best round unless told otherwise."""
        out = self.assembled(df).withColumn("_bt_score", F.lit(self.start))
        for i, r in enumerate(self.rounds[:self.best if rounds is None else rounds], 1):
            out = _moved(r, out, self.step)
            if i % CUT == 0:
                out = cut_lineage(out)
        return out.withColumn(col, F.exp("_bt_score")).drop("_bt_score", "features", *(
            self.indexer.getOutputCols() if self.indexer is not None else []))


def _moved(r: Round, df: DataFrame, step: float) -> DataFrame:
    score = F.col("_bt_score") + F.lit(step) * F.col("_bt_step")
    return r.step(df, "_bt_step").withColumn("_bt_score", F.greatest(F.lit(-SCORE_LIMIT), F.least(F.lit(SCORE_LIMIT), score))).drop("_bt_step")


def fit(train: DataFrame, valid: DataFrame | None, features: Sequence[str], categorical: Sequence[str] = (), *,
        label: str = "sales", key: Sequence[str] = ("store_nbr", "family", "date"), power: float = 1.5, rounds: int = 40,
        step: float = 0.1, depth: int = 5, row_share: float = 0.7, column_share: float = 0.7, min_instances: int = 30,
        reg_lambda: float = 0.1, patience: int = 100, bins: int = 64, seed: int = 42) -> TweedieBoost:
    """Boosted trees by Tweedie deviance. Without validation rows all rounds are
    kept. Raises if no label is positive."""
    indexer = None
    if categorical:
        indexer = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_idx" for c in categorical],
                                handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
    mean = train.agg(F.avg(label)).first()[0]
    if not mean or mean <= 0:
        raise ValueError("Tweedie boosting needs a positive mean of the label")
    start = float(train.select(F.log(F.lit(float(mean)))).first()[0])
    model = TweedieBoost(power, step, start, list(features), indexer)
    rows = train.filter(F.col(label).isNotNull()).withColumn("_bt_role", F.lit(0))
    if valid is not None:
        rows = rows.unionByName(valid.filter(F.col(label).isNotNull()).withColumn("_bt_role", F.lit(1)), allowMissingColumns=True)
    y = F.col(label).cast("double")
    rows = cut_lineage(model.assembled(rows).select(*key, y.alias("_bt_y"), "_bt_role", "features")
                       .withColumn("_bt_score", F.lit(start)))
    width = len(model.features) + len(categorical)
    rng = random.Random(seed)
    target = F.col("_bt_y")
    for number in range(1, rounds + 1):
        columns = sorted(rng.sample(range(width), max(1, round(column_share * width))))
        picked = F.pmod(F.xxhash64(*key, F.lit(seed), F.lit(number)), F.lit(10_000)) < int(row_share * 10_000)
        g, h = gradient(target, F.col("_bt_score"), power)
        sample = (rows.filter((F.col("_bt_role") == 0) & picked)
                  .withColumns({"_bt_g": g, "_bt_h": F.greatest(h, F.lit(1e-12))})
                  .withColumn("_bt_ratio", F.col("_bt_g") / F.col("_bt_h")))
        some = VectorSlicer(inputCol="features", outputCol="_bt_some", indices=columns).transform(sample)
        tree = DecisionTreeRegressor(labelCol="_bt_ratio", weightCol="_bt_h", featuresCol="_bt_some", maxDepth=depth,
                                     maxBins=bins, minInstancesPerNode=min_instances, seed=seed + number,
                                     leafCol="_bt_leaf", predictionCol="_bt_pred", cacheNodeIds=False).fit(some)
        per_leaf = tree.transform(some).groupBy("_bt_leaf").agg(
            (F.sum("_bt_g") / (F.sum("_bt_h") + F.lit(reg_lambda))).alias("v")).collect()      # at most 2 ** depth
        found = Round(tree, columns, {int(r[0]): float(r[1]) for r in per_leaf})
        model.rounds.append(found)
        rows = _moved(found, rows, step)
        if number % CUT == 0:
            rows = cut_lineage(rows)
        seen = rows.agg(F.avg(F.when(F.col("_bt_role") == 0, deviance(target, F.col("_bt_score"), power))),
                        F.sqrt(F.avg(F.when(F.col("_bt_role") == 1, squared_log_error(target, F.exp("_bt_score")))))).first()
        model.history.append((number, float(seen[0]), seen[1]))
        scored = [(s, n) for n, _, s in model.history if s is not None]
        model.best = min(scored)[1] if scored else number
        if scored and number - model.best >= patience:
            break
    return model
