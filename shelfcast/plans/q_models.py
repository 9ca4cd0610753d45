"""Queries: model fits, early stopping, per-segment / per-horizon / multi-seed
ensembles, tuning, importances, stacking, save/load (inventory 12, 97, 125,
127-141, 154-156, 158). Rows-only checks: results depend on the optimiser."""

from __future__ import annotations

import functools
import json
import math
import os
import random
import re
import uuid

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import rmsle
from shelfcast.operators import forecast as fc
from shelfcast.operators import stats
from shelfcast.operators.folds import holdout_bounds
from shelfcast.operators.series import series_window, shifted_frame
from shelfcast.plans import blend_solver as blend_search
from shelfcast.plans import boosting
from shelfcast.plans import models as ml
from shelfcast.plans import tuning
from shelfcast.plans.catalog import register
from shelfcast.plans.oracle import sql
from shelfcast.plans.q_forecast import holdout_frame
from shelfcast.plans.q_grains import tx_feature_frame
from shelfcast.plans.q_stats import ORDERED, ordered_category_stats
from shelfcast.plans.shared_trees import shared_trees
from shelfcast.session import cut_lineage, ensure_checkpoint_dir, session_table

KEY = ["store_nbr", "family", "date"]


def data(src) -> ml.ModelData:
    """Model data of this session and directory (checkpointed once per session)."""
    return session_table(src.spark, ("models", type(src).__name__, *src.options().values()), src.sf_dir,
                         lambda: ml.model_data(src))


@register("fit_tweedie")
def fit_tweedie(src):
    """Tweedie GLM (variance power 1.5, log link): validation predictions."""
    md = data(src)
    return ml.predict_clipped(ml.fit_tweedie(md, 1.5), md.valid)


def boosted(src):
    """Tweedie-loss trees of this session and directory (fitted once), and their
    scores a round as a table."""
    def build():
        md = data(src)
        model = boosting.fit(md.train, md.valid, md.features, md.categorical or (), power=1.5, rounds=ml.TREE_COUNT,
                             bins=ml.tree_bins(md), seed=ml.SEED, **boosting.tier(1.5))
        history = src.spark.createDataFrame(model.history, "round int, train_deviance double, rmsle_valid double")
        return model, cut_lineage(history)

    return session_table(src.spark, ("boosted", type(src).__name__, *src.options().values()), src.sf_dir, build)


@register("fit_tweedie_boost")
def fit_tweedie_boost(src):
    """Trees boosted by Tweedie loss (variance power 1.5): validation predictions
    of the best round, with their RMSLE."""
    model, history = boosted(src)
    best = history.agg(F.min("rmsle_valid")).scalar()
    return model.predict(data(src).valid).select(*KEY, "sales", "pred", best.alias("rmsle_valid"))


@register("boost_scores")
def boost_scores(src):
    """Staged scores of the Tweedie-loss trees: each round's deviance on the
    training rows and RMSLE on the validation days, and whether it is the best."""
    _, history = boosted(src)
    best = history.agg(F.min_by("round", F.struct("rmsle_valid", "round"))).scalar()
    return history.withColumn("is_best", F.col("round") == best)


@register("fit_gbt_log1p")
def fit_gbt_log1p(src):
    """Boosted trees on log1p(sales) (squared log error objective), expm1 back."""
    md = data(src)
    return ml.predict_clipped(ml.fit_gbt_log1p(md, max_iter=15), md.valid, log_target=True)


@register("fit_gbt_raw")
def fit_gbt_raw(src):
    """Boosted trees on raw sales (RMSE objective)."""
    md = data(src)
    return ml.predict_clipped(ml.fit_gbt_raw(md, max_iter=15), md.valid)


@register("fit_gbt_ordered")
def fit_gbt_ordered(src):
    """Boosted trees on raw sales whose categories enter as ordered target
    statistics, not as sets of values: validation predictions."""
    md = data(src)
    names = [stats.ordered_name(c) for c in ORDERED]
    encoded = cut_lineage(ordered_category_stats(src).fillna(0.0, names))
    train, valid = (rows.join(encoded, KEY, "left") for rows in (md.train, md.valid))
    model = ml.gbt_pipeline([*md.features, *names], "sales", max_iter=15).fit(train)
    return ml.predict_clipped(model, valid)


@register("fit_zero_classifier")
def fit_zero_classifier(src):
    """Class-weighted logistic classifier of non-zero sales; P(non-zero) per validation row."""
    md = data(src)
    out = ml.fit_zero_classifier(md).transform(md.valid)
    return out.select(*KEY, (F.col("sales") > 0).cast("int").alias("is_nonzero"),
                      vector_to_array("prob")[1].alias("p_nonzero"))


@register("fit_early_stop_refit")
def fit_early_stop_refit(src):
    """Early stopping on the validation rows, then a refit on every known row
    (gap and validation days, too) with int(1.1 × trees kept). Only the early
    stopped model has a validation score: the refit has seen those days, so it
    gets the mean of its horizon predictions instead."""
    md = data(src)
    es, used = ml.fit_gbt_early_stopped(md)
    trees = max(1, int(used * ml.GROWN))
    refit = ml.fit_gbt_log1p(ml.refit_data(md), max_iter=trees)
    score = ml.predict_clipped(es, md.valid, log_target=True).agg(rmsle("sales", "pred").alias("rmsle_valid"))
    ahead = ml.predict_clipped(refit, md.horizon, log_target=True).agg(F.avg("pred").alias("mean_horizon"))
    return score.select(F.lit("early_stopped").alias("phase"), F.lit(used).alias("n_trees"), "rmsle_valid",
                        F.lit(None).cast("double").alias("mean_horizon")).unionByName(
        ahead.select(F.lit("refit").alias("phase"), F.lit(trees).alias("n_trees"),
                     F.lit(None).cast("double").alias("rmsle_valid"), "mean_horizon"))


@register("fit_hurdle")
def fit_hurdle(src):
    """Fitted hurdle: probability of a sale × amount fitted on the positive
    rows. The F1 best threshold and the method (hard, soft, plain regression,
    half hard and half regression) are chosen on the validation days, both
    parts are refitted on all known rows, and the horizon is predicted. Where no
    training row sells there is no amount to fit: it is 0."""
    md = data(src)

    def parts(d, rows):
        clf = ml.fit_zero_classifier(d)
        positive = ml.ModelData(d.train.filter(F.col("sales") > 0), d.valid, d.horizon, d.features, d.known)
        if positive.train.isEmpty():
            amount = rows.select(*KEY, "sales", F.lit(0.0).alias("amount"))
        else:
            amount = ml.predict_clipped(ml.fit_tweedie(positive, 1.3), rows, "amount")
        base = ml.fit_tweedie(d, 1.2)
        p = clf.transform(rows).select(*KEY, vector_to_array("prob")[1].alias("p"))
        return (amount.join(p, KEY)
                .join(ml.predict_clipped(base, rows, "baseline").drop("sales"), KEY))

    val = cut_lineage(parts(md, md.valid))
    sweep = fc.f1_sweep(val, (F.col("sales") > 0).cast("int"), F.col("p"))
    t = float(sweep.orderBy(F.col("f1").desc(), F.col("threshold").asc()).first().threshold)
    hard = fc.hurdle_hard(F.col("p"), F.col("amount"), t)
    methods = {"hard": hard, "soft": fc.hurdle_soft(F.col("p"), F.col("amount")), "baseline": F.col("baseline"),
               "blend": 0.5 * hard + 0.5 * F.col("baseline")}
    scores = val.agg(*[rmsle("sales", e).alias(m) for m, e in methods.items()]).first().asDict()
    best = min(scores, key=lambda m: (scores[m], m))
    ahead = parts(ml.refit_data(md), md.horizon)
    return ahead.select(*KEY, methods[best].alias("pred"), F.lit(best).alias("method"), F.lit(t).alias("threshold"),
                        F.lit(float(scores[best])).alias("rmsle_valid"))


SEGMENT_POWER = {"HIGH": 1.1, "MEDIUM": 1.3, "LOW": 1.5}


@register("fit_segments")
def fit_segments(src):
    """One Tweedie GLM per series segment with its own variance power; the
    segment predictions are reassembled by a union on the key."""
    md = data(src)
    from shelfcast.operators.forecast import series_segments
    seg = series_segments(md.train).select("store_nbr", "family", "segment")
    tr = md.train.join(seg, ["store_nbr", "family"])
    va = md.valid.join(seg, ["store_nbr", "family"])

    def task(name, power):
        def run():
            part = tr.filter(F.col("segment") == name)
            model = ml.tweedie_pipeline(ml.glm_features(md), power, **ml.params_for_power(power)).fit(part)
            return ml.predict_clipped(model, va.filter(F.col("segment") == name)) \
                .withColumn("segment", F.lit(name))
        return run
    parts = ml.parallel([task(n, p) for n, p in SEGMENT_POWER.items()
                         if tr.filter(F.col("segment") == n).limit(1).count() > 0])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# fixed values: variance powers and seeds of the ensemble
POWERS, SEEDS = [1.0, 1.1, 1.2, 1.3, 1.5], [42, 123, 777]


@register("fit_multi_seed")
def fit_multi_seed(src):
    """Powers × seeds: each GLM sees a deterministic 70 % hashed sample (bagging);
    predictions are averaged over seeds, and the powers are blended by the weights
    that the continuous search finds on the validation days."""
    md = data(src)

    def task(power, seed):
        def run():
            model = ml.tweedie_pipeline(ml.glm_features(md), power, **ml.params_for_power(power)).fit(
                ml.hashed_sample(md.train, seed))
            return ml.predict_clipped(model, md.valid).select(
                *KEY, "sales", "pred", F.lit(power).alias("power"), F.lit(seed).alias("seed"))
        return run
    preds = ml.parallel([task(p, s) for p in POWERS for s in SEEDS])
    long = preds[0]
    for p in preds[1:]:
        long = long.unionByName(p)
    averaged = long.groupBy(*KEY, "sales", "power").agg(F.avg("pred").alias("pred"))
    names = [f"p{str(p).replace('.', '_')}" for p in POWERS]
    wide = cut_lineage(averaged.groupBy(*KEY, "sales").agg(
        *[F.max(F.when(F.col("power") == p, F.col("pred"))).alias(n) for p, n in zip(POWERS, names)]))
    score, weights = blend_search.best_weights(wide, "sales", names)
    return wide.select(*KEY, "sales", fc.weighted_blend(names, weights).alias("pred"),
                       F.lit(float(score)).alias("rmsle_valid"))


@register("fit_per_horizon")
def fit_per_horizon(src):
    """One GLM per horizon day h = 1..16 on features known h days ahead
    (lag h, means over [h, h+6] and [h, h+27], same-weekday lag), each
    predicting its own validation day; fits run from a driver thread pool."""
    m = src.materialized()
    fit_end, val_start, val_end = holdout_bounds(m.train_end)
    w = series_window()
    cols = [F.weekday("date").cast("double").alias("dow"), F.col("onpromotion").cast("double").alias("promo")]
    for h in range(1, 17):
        dow_lag = 7 * ((h + 6) // 7)
        cols += [F.lag("sales", h).over(w).alias(f"lag_{h}"),
                 F.avg("sales").over(shifted_frame(w, h, 7)).alias(f"mean7_{h}"),
                 F.avg("sales").over(shifted_frame(w, h, 28)).alias(f"mean28_{h}"),
                 F.lag("sales", dow_lag).over(w).alias(f"dowlag_{h}")]
    # the longest look back is 16 + 27 days
    recent = m.panel.filter(F.col("date") >= F.date_sub(fit_end, 730 + 43))
    feats = recent.select(*KEY, "sales", *cols).fillna(0.0)
    feats = cut_lineage(feats.filter(F.col("date") >= F.date_sub(fit_end, 730)))
    train = feats.filter((F.col("date") <= fit_end) & F.col("sales").isNotNull())

    def task(h):
        def run():
            fcols = ["dow", "promo", f"lag_{h}", f"mean7_{h}", f"mean28_{h}", f"dowlag_{h}"]
            model = ml.tweedie_pipeline(fcols, 1.3).fit(train)
            day = feats.filter(F.col("date") == F.date_add(val_start, h - 1))
            return ml.predict_clipped(model, day).withColumn("horizon_day", F.lit(h))
        return run
    preds = ml.parallel([task(h) for h in range(1, 17)])
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out


@register("fit_tx_forecast")
def fit_tx_forecast(src):
    """Transactions forecaster: Tweedie GLM on store-day features (lags
    16/21/28/35, shifted means, calendar), 32-day validation, then the store ×
    horizon grid is predicted with the same feature definition."""
    m = src.materialized()
    grid = tx_feature_frame(m)
    known = grid.filter(F.col("transactions").isNotNull())
    cutoff = F.date_sub(known.select(F.max("date")).scalar(), 32)
    fcols = ["dow", "month", "day", "week", "is_weekend", "tx_lag_16", "tx_lag_21", "tx_lag_28",
             "tx_lag_35", "tx_rolling_mean_7", "tx_rolling_mean_14", "tx_rolling_mean_28"]
    train = known.filter(F.col("date") <= cutoff).fillna(0.0, fcols)
    glm = ml.tweedie_pipeline(fcols, 1.5)
    glm.getStages()[-1].setLabelCol("transactions")
    model = glm.fit(train)
    horizon = grid.filter(F.col("date") > m.train_end).fillna(0.0, fcols)
    clipped = F.greatest(F.col("pred"), F.lit(0.0))
    checked = model.transform(known.filter(F.col("date") > cutoff).fillna(0.0, fcols))
    error = checked.select(F.sqrt(F.avg(F.pow(clipped - F.col("transactions"), F.lit(2.0))))).first()[0]
    return model.transform(horizon).select(
        "store_nbr", "date", clipped.alias("transactions_pred"), F.lit(float(error)).alias("rmse_valid"))


@register("tx_forecast_fitted")
def tx_forecast_fitted(src):
    """Horizon panel rows with the fitted transactions forecast, looked up by
    store and date (0 where the store has none)."""
    found = fit_tx_forecast(src).select("store_nbr", "date", "transactions_pred")
    return src.horizon_rows().select(*KEY).join(found, ["store_nbr", "date"], "left").select(
        *KEY, F.coalesce("transactions_pred", F.lit(0.0)).alias("transactions_pred"))


# fixed values: trials and folds of the search
N_TRIALS, N_FOLDS = 50, 3
SPACES = {
    "tweedie": lambda rng: {"power": round(rng.uniform(1.1, 1.8), 3), "reg": round(10 ** rng.uniform(-3, -1), 6)},
    "gbt_log1p": lambda rng: {"depth": rng.randint(3, 8), "step": round(10 ** rng.uniform(-1.5, -0.5), 4),
                              "subsample": round(rng.uniform(0.5, 1.0), 2), "min_instances": rng.randint(1, 50)},
}


def tune(md, estimator: str = "tweedie", trials: int = N_TRIALS, folds: int = N_FOLDS, max_iter: int = 15):
    """Seeded random search over an estimator's space: every trial is scored by
    its mean RMSLE over time folds with a 16-day gap. GLMs are fitted from a
    thread pool, trees of all trials and folds together. A GLM that does not
    converge scores null and is recorded with its error; any other failure ends
    the search."""
    rng = random.Random(ml.SEED)
    drawn = [(i, SPACES[estimator](rng)) for i in range(trials)]
    if estimator != "tweedie":
        categorical = md.categorical or []
        rows = _fold_rows(md, dict.fromkeys([*KEY, *md.features, *categorical]), folds)
        scores = shared_trees(rows, md.features, categorical, [p for _, p in drawn], folds, trees=max_iter,
                              bins=ml.tree_bins(md), seed=ml.SEED)
        return [(t, json.dumps(p, sort_keys=True), f, float(x) if math.isfinite(x) else None, None)
                for t, p in drawn for f, x in enumerate(scores[t])]
    max_date = md.train.select(F.max("date")).scalar()
    parts = []
    for f in range(folds):
        v_end = F.date_sub(max_date, 16 * f)
        v_start = F.date_sub(v_end, 15)
        parts.append((f, md.train.filter(F.col("date") <= F.date_sub(v_start, 16)),
                      md.train.filter(F.col("date").between(v_start, v_end))))

    def task(trial, params, fold, tr, va):
        def run():
            try:
                model = ml.tweedie_pipeline(ml.glm_features(md), **params, max_iter=max_iter).fit(tr)
                score = ml.predict_clipped(model, va).agg(rmsle("sales", "pred")).first()[0]
                return trial, json.dumps(params, sort_keys=True), fold, score, None
            except (PySparkException, Py4JJavaError) as e:
                if not re.search("Sum of weights cannot be zero|singular|not converge|infinity|NaN", str(e), re.I):
                    raise
                return trial, json.dumps(params, sort_keys=True), fold, None, str(e)[:200]
        return run
    return ml.parallel([task(t, p, f, tr, va) for t, p in drawn for f, tr, va in parts])


def _ranked_trials(src, rows):
    """Mean score a trial, best first; the trials are a parameter's worth of rows."""
    res = src.spark.createDataFrame(rows, "trial int, params string, fold int, rmsle double, error string")
    per = res.groupBy("trial", "params").agg(F.when(F.count("rmsle") == F.count(F.lit(1)), F.avg("rmsle")).alias("cv_rmsle"),
                                             F.max("error").alias("error"))
    return per.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("cv_rmsle").asc_nulls_last(), "trial")))


# the Tweedie GLM's search space; trials of a batch share their scans
TWEEDIE_SPACE = {"power": tuning.Uniform(1.0, 2.0), "reg": tuning.Uniform(1e-4, 1e-1, log=True)}
BATCH = 10


def tune_tweedie(rows, features, trials: int = N_TRIALS, folds: int = N_FOLDS, seed: int = ml.SEED):
    """Seeded search of the Tweedie GLM: ``(trial, params, fold, rmsle, error)``
    of every trial and fold. Trials are proposed in batches, by the densities of
    the trials before them; a batch is fitted on all folds in shared scans."""
    search = tuning.Parzen(TWEEDIE_SPACE, seed)
    out = []
    while len(out) < trials * folds:
        batch = [search.ask() for _ in range(min(BATCH, trials - len(out) // folds))]
        _, scores = tuning.shared_fits(rows, features, batch, folds)
        for params, per_fold in zip(batch, scores):
            trial = len(out) // folds
            search.tell(params, float(per_fold.mean()))
            text = json.dumps({k: round(v, 9) for k, v in params.items()}, sort_keys=True)
            out += [(trial, text, f, float(x) if math.isfinite(x) else None,
                     None if math.isfinite(x) else "diverged") for f, x in enumerate(per_fold)]
    return out


def _fold_rows(md, features, folds: int = N_FOLDS):
    """Features, label and fold flags of the training rows, checkpointed."""
    flags = tuning.fold_flags(md.train.select(F.max("date")).scalar(), folds)
    return cut_lineage(md.train.select(*features, "sales", *[c.alias(f"_fold{f}") for f, c in enumerate(flags)]))


@register("tune_params")
def tune_params(src):
    """Model-based search of the Tweedie GLM's variance power and regularisation:
    all 50 trials on all 3 folds, in shared scans of the training rows."""
    md = data(src)
    features = ml.glm_features(md)
    return _ranked_trials(src, tune_tweedie(_fold_rows(md, features), features))


@register("tune_trees")
def tune_trees(src):
    """Random search of the boosted trees' depth, step, sample and leaf size (the
    50 trials and 3 folds of ``tune``, all trees)."""
    return _ranked_trials(src, tune(data(src), "gbt_log1p", max_iter=ml.TREE_COUNT))


def _importances(src):
    md = data(src)
    model = ml.fit_gbt_raw(md, max_iter=15)
    return ml.importance_table(src.spark, model, [*md.features, *(md.categorical or [])])


@register("feature_importance")
def feature_importance(src):
    """Top 30 features of the raw-target tree model by importance, with their share."""
    return _importances(src).orderBy(F.col("importance").desc(), "feature").limit(30)


@register("importance_by_category")
def importance_by_category(src):
    """Tree importance summed per feature class (ordered word rules), largest first."""
    imp = _importances(src).withColumn("category", ml.categorize("feature"))
    return imp.groupBy("category").agg(F.sum("importance").alias("importance"),
                                       F.sum("share").alias("share"),
                                       F.count(F.lit(1)).alias("n_features")).orderBy(F.col("share").desc(), "category")


STACKED = ["p_lag28", "p_mean28", "p_dow4", "p_fallback"]
STACK_FOLDS, STACK_REG = 3, 0.1


def ridge_coefficients(rows, preds, label: str = "sales", reg: float = STACK_REG) -> list[float]:
    """Intercept and coefficients of a ridge regression, from the products of one
    aggregate: the mean squared error plus ``reg`` times the squared coefficients
    of the standardised predictors (the intercept isn't held back)."""
    x = [F.col(c).cast("double") for c in preds] + [F.col(label).cast("double")]
    n = len(x)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    got = rows.filter(F.col(label).isNotNull()).agg(*[F.avg(c) for c in x], *[F.covar_pop(x[i], x[j]) for i, j in pairs]).first()
    mean, cov = np.array(got[:n], dtype=float), np.zeros((n, n))
    for (i, j), v in zip(pairs, got[n:]):
        cov[i, j] = cov[j, i] = v
    held = np.diag(cov)[:-1]
    inner = cov[:-1, :-1] + reg * np.diag(held)
    beta = np.linalg.lstsq(inner, cov[:-1, -1], rcond=None)[0]
    return [float(mean[-1] - beta @ mean[:-1]), *map(float, beta)]


@register("stack_ridge")
def stack_ridge(src):
    """Cross-fitted stacking: the ridge is fitted on out-of-fold predictions of
    the ``STACK_FOLDS`` 16-day windows before the holdout (each predicted from the
    rows before its own gap) and predicts the holdout days, which it has not seen."""
    folds = [holdout_frame(src, 16 * k).select("sales", *STACKED) for k in range(1, STACK_FOLDS + 1)]
    beta = ridge_coefficients(functools.reduce(lambda a, b: a.unionByName(b), folds), STACKED)
    value = sum((F.lit(b) * F.col(c) for b, c in zip(beta[1:], STACKED)), F.lit(beta[0]))
    return holdout_frame(src).select(*KEY, "sales", F.greatest(value, F.lit(0.0)).alias("pred"))


@register("model_save_load")
def model_save_load(src):
    """Fit, save under the shared checkpoint folder, load back, predict again:
    both predictions must agree (max absolute difference is reported)."""
    md = data(src)
    model = ml.fit_tweedie(md, 1.5)
    path = os.path.join(ensure_checkpoint_dir(src.spark), f"model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = ml.predict_clipped(model, md.valid, "pred_a")
    b = ml.predict_clipped(loaded, md.valid, "pred_b")
    j = a.join(b.drop("sales"), KEY)
    return j.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.max(F.abs(F.col("pred_a") - F.col("pred_b"))).alias("max_abs_diff"),
                 F.min("pred_a").alias("min_pred"))


@register("forecast_submission")
def forecast_submission(src):
    """The full forecast job: holdout fits, blend weights, refit, horizon
    submission rows (id, key, sales) with the chosen weights."""
    from shelfcast.plans.forecast_job import run_forecast
    return run_forecast(src, data(src))
