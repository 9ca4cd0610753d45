"""Distributed model fitting on the feature matrix with ``pyspark.ml``.

* Tweedie GLM (log link); trees boosted by Tweedie loss are in ``boosting``;
  ``GBTRegressor`` on log1p(target) for the squared-log-error objective and on
  the raw target for the RMSE objective.
* The training matrix is checkpointed into the shared checkpoint folder
  before fitting (iterative algorithms re-read it many times; a lost
  executor then recomputes from the checkpoint, not from the raw scans).
* Independent fits (seeds, powers, horizons, segments, trials) are submitted
  from a small driver thread pool so Spark runs their jobs concurrently.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import EVENT_END, EVENT_START
from shelfcast.operators.clean import ensure_columns, mask_date_range, trailing_window
from shelfcast.operators.folds import holdout_bounds
from shelfcast.plans.features import CATEGORICAL, NON_FEATURES, build_features, training_matrix
from shelfcast.session import cut_lineage
from shelfcast.sources.panel import PanelSources

SEED = 42
FIT_THREADS = 4
# Feature columns never used by the models: identifiers, and flags that are
# constant by construction of the panel.
DROP = set(NON_FEATURES) | set(CATEGORICAL) | {"store_nbr"}
TREE_COUNT = 40            # most trees of a boosted model; early stopping ends sooner
GROWN = 1.1                # trees of a refit, as a multiple of the early-stopped count


# Compact feature set of the linear (GLM) models: levels, weekly shape,
# statistics, promotion, calendar and the lagged grain totals. Trees use all.
GLM_FEATURES = [
    "sales_lag_16", "sales_lag_21", "sales_lag_28", "sales_lag_35", "sales_lag_42", "sales_lag_364",
    "sales_rolling_mean_7", "sales_rolling_mean_14", "sales_rolling_mean_28", "sales_dow_rolling_mean_4",
    "sales_store_family_mean_30", "sales_store_family_mean_90", "sales_expanding_mean",
    "sf_mean", "sf_dow_mean", "sf_recent_mean", "sf_dow_recent_mean", "sf_zero_ratio",
    "family_dow_mean", "store_dow_mean", "onpromotion", "promo_rolling_14", "day_of_week",
    "is_weekend", "is_payday", "is_effective_holiday", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "store_total_lag_16", "family_national_lag_16", "transactions_lag_16", "oil_regime",
]


# Parameter tiers by Tweedie variance power (cut at 1.1 and 1.3): lower powers
# model heavier-volume series and get less regularisation.
POWER_PARAMS = [
    (1.1, {"reg": 1e-4, "max_iter": 15}),
    (1.3, {"reg": 1e-3, "max_iter": 15}),
    (9.9, {"reg": 1e-2, "max_iter": 15}),
]


def params_for_power(power: float) -> dict:
    return next(p for cut, p in POWER_PARAMS if power <= cut)


@dataclass
class ModelData:
    train: DataFrame          # rows up to the fold's training end (trailing window)
    valid: DataFrame          # the 16 validation days
    horizon: DataFrame        # rows after train_end (no target)
    features: list[str]
    known: DataFrame | None = None   # every known row in the trailing window of train_end (refit)
    categorical: list[str] | None = None


def model_data(src: PanelSources, trailing_days: int = 730) -> ModelData:
    """Feature matrix split into holdout train / validation / horizon.

    Training rows: date <= val_start - 16 - 1 and within the trailing window
    (the 730-day window is applied after the features, never before the
    364-day lags are computed), without the days of the event period and
    without the days before a series' first sale.

    Two matrices: target statistics as of the fold's training end for training
    and validation, and as of the last known day for the refit and the horizon.
    """
    src = src.materialized()
    fit_end, val_start, val_end = holdout_bounds(src.train_end)
    first = src.panel.groupBy("store_nbr", "family").agg(
        F.min(F.when(F.col("sales") > 0, F.col("date"))).alias("_first_sale"))

    def matrix(as_of):
        m = training_matrix(build_features(src, as_of=as_of))
        cols = [c for c, t in m.dtypes if c not in DROP and t in ("double", "int", "bigint")]
        rows = m.select("store_nbr", "date", "sales", *CATEGORICAL, *cols).withColumn("cluster", F.col("cluster").cast("string"))
        return cut_lineage(rows.join(first, ["store_nbr", "family"], "left")), cols

    def usable(rows, end):
        """Rows a model may learn from."""
        began = F.col("_first_sale").isNull() | (F.col("date") >= F.col("_first_sale"))
        rows = rows.filter(F.col("sales").isNotNull() & (F.col("date") <= end) & began)
        return trailing_window(mask_date_range(rows, EVENT_START, EVENT_END), end, trailing_days)

    at_fit, cols = matrix(fit_end)
    at_end, _ = matrix(src.train_end)
    valid = at_fit.filter(F.col("date").between(val_start, val_end))
    horizon = at_end.filter(F.col("date") > src.train_end)
    return ModelData(usable(at_fit, fit_end), valid, horizon, cols, usable(at_end, src.train_end), list(CATEGORICAL))


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def tweedie_pipeline(features: Sequence[str], power: float = 1.5, reg: float = 1e-3,
                     max_iter: int = 15) -> Pipeline:
    """Assemble, standardise (features span prices to flags; IRLS needs
    comparable scales to stay stable), fit the log-link Tweedie GLM."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    glm = GeneralizedLinearRegression(family="tweedie", variancePower=power, linkPower=0.0,
                                      labelCol="sales", featuresCol="scaled", maxIter=max_iter,
                                      regParam=reg, predictionCol="pred")
    return Pipeline(stages=[assembler(features), scaler, glm])


def gbt_pipeline(features: Sequence[str], label: str, max_iter: int = TREE_COUNT, depth: int = 5,
                 subsample: float = 0.8, seed: int = SEED, step: float = 0.1,
                 validation_col: str | None = None, categorical: Sequence[str] = (),
                 min_instances: int = 1, bins: int = 64) -> Pipeline:
    """Boosted trees. Categorical columns are indexed on the training rows (in
    alphabetical order; unseen values get a place of their own) and keep their
    nominal kind in the assembled vector, so trees split on sets of categories."""
    kw = {}
    indexed = [f"{c}_idx" for c in categorical]
    first = [StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                           stringOrderType="alphabetAsc")] if indexed else []
    if validation_col:
        kw = {"validationIndicatorCol": validation_col, "validationTol": 0.01}
    gbt = GBTRegressor(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=depth,
                       subsamplingRate=subsample, seed=seed, stepSize=step, predictionCol="raw_pred",
                       maxBins=bins, minInstancesPerNode=min_instances, **kw)
    return Pipeline(stages=[*first, assembler([*features, *indexed]), gbt])


def tree_bins(md: "ModelData", least: int = 64) -> int:
    """Bins for the trees: as many as the largest category set needs."""
    if not md.categorical:
        return least
    sizes = md.train.agg(*[F.count_distinct(c) for c in md.categorical]).first()
    return max(least, *(n + 2 for n in sizes))


def predict_clipped(model: PipelineModel, df: DataFrame, col: str = "pred",
                    log_target: bool = False) -> DataFrame:
    """Predictions, not below 0. A feature that ``df`` lacks is 0 throughout."""
    needed = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    made = {c for s in model.stages if isinstance(s, StringIndexerModel) for c in s.getOutputCols()}
    out = model.transform(ensure_columns(df, [c for c in needed if c not in made]))
    src_col = "raw_pred" if "raw_pred" in out.columns else "pred"
    p = F.expm1(F.col(src_col)) if log_target else F.col(src_col)
    return out.select("store_nbr", "family", "date", "sales", F.greatest(p, F.lit(0.0)).alias(col))


def glm_features(md: "ModelData") -> list[str]:
    return [c for c in GLM_FEATURES if c in md.features]


def fit_tweedie(md: ModelData, power: float = 1.5) -> PipelineModel:
    return tweedie_pipeline(glm_features(md), power).fit(md.train)


def fit_gbt_log1p(md: ModelData, **kw) -> PipelineModel:
    """Trees on log1p(target): minimising squared error there is RMSLE."""
    return gbt_pipeline(md.features, "log_sales", categorical=md.categorical or (), bins=tree_bins(md), **kw).fit(
        md.train.withColumn("log_sales", F.log1p("sales")))


def fit_gbt_early_stopped(md: ModelData, max_iter: int = TREE_COUNT) -> tuple[PipelineModel, int]:
    """Trees on log1p(target), stopped when the validation days no longer gain;
    the model and how many trees it kept."""
    both = md.train.withColumn("is_val", F.lit(False)).unionByName(
        md.valid.filter(F.col("sales").isNotNull()).withColumn("is_val", F.lit(True)))
    model = gbt_pipeline(md.features, "log_sales", max_iter=max_iter, validation_col="is_val",
                         categorical=md.categorical or (), bins=tree_bins(md)).fit(both.withColumn("log_sales", F.log1p("sales")))
    return model, model.stages[-1].getNumTrees


def refit_data(md: ModelData) -> ModelData:
    """Every known row as training rows."""
    return ModelData(md.known, md.valid, md.horizon, md.features, md.known, md.categorical)


def fit_gbt_raw(md: ModelData, **kw) -> PipelineModel:
    return gbt_pipeline(md.features, "sales", categorical=md.categorical or (), bins=tree_bins(md), **kw).fit(md.train)


def fit_zero_classifier(md: ModelData) -> PipelineModel:
    """Non-zero classifier with class weights balancing the two classes. Rows of
    one class only have nothing to balance: they weigh 1, not 0, and the model
    gives that class for certain."""
    share = md.train.select(F.avg((F.col("sales") > 0).cast("double"))).scalar()
    train = md.train.withColumn("is_nonzero", (F.col("sales") > 0).cast("double"))
    balanced = F.when(F.col("is_nonzero") == 1.0, 1.0 - share).otherwise(share)
    train = train.withColumn("w", F.when((share > 0) & (share < 1), balanced).otherwise(1.0))
    lr = LogisticRegression(labelCol="is_nonzero", featuresCol="features", weightCol="w",
                            maxIter=50, regParam=1e-3, probabilityCol="prob")
    return Pipeline(stages=[assembler(md.features), lr]).fit(train)


def parallel(tasks: Sequence[Callable[[], DataFrame]], threads: int = FIT_THREADS) -> list:
    """Run independent fit/predict tasks from a driver thread pool."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(lambda f: f(), tasks))


def hashed_sample(df: DataFrame, seed: int, fraction_pct: int = 70) -> DataFrame:
    """Deterministic row sample (bagging) independent of partitioning."""
    h = F.pmod(F.xxhash64("store_nbr", "family", "date", F.lit(seed)), F.lit(100))
    return df.filter(h < fraction_pct)


def importance_table(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance, share) of a tree model, from its importances vector."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(features, [float(x) for x in imp]))
    df = spark.createDataFrame(rows, "feature string, importance double")
    total = df.select(F.sum("importance")).scalar()
    return df.withColumn("share", F.try_divide(F.col("importance"), total))


# fixed values: a feature's class by the words in its name (any of the first
# list, none of the second); the first class that fits
FEATURE_CLASSES = [
    ("Rolling stats", ["rolling", "expanding"], []),
    ("Lag features", ["lag"], ["promo", "oil", "transact"]),
    ("Temporal", ["day", "month", "year", "week", "quarter", "dow", "weekend", "sin", "cos"], []),
    ("External", ["oil", "holiday", "transact"], []),
    ("Promotion", ["promo"], []),
    ("Cross", ["x_"], []),
]
OTHER_CLASS = "Aggregation"


def categorize(col: str = "feature") -> Column:
    def holds(words: Sequence[str]) -> Column:
        return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.col(col), w))

    return F.coalesce(*[F.when(holds(words) & ~holds(barred) if barred else holds(words), F.lit(name))
                        for name, words, barred in FEATURE_CLASSES], F.lit(OTHER_CLASS))
