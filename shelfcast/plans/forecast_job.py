"""End-to-end forecast job: features -> holdout fits -> blend weights ->
refit on all known rows -> horizon predictions -> submission.

Phase 1 fits a Tweedie GLM and log1p boosted trees on the rows before the
holdout gap (trees stopped early on the 16 validation days) and scores those
days. Phase 2 searches the blend weights as an aggregate over a 0.05 simplex
grid. Phase 3 refits both models on every known row of the trailing window,
with target statistics as of the last known day and 1.1 times the early-stopped
number of trees, predicts the horizon, blends, post-processes and writes
(id, sales). A horizon row without a prediction is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import forecast as fc
from shelfcast.plans import models as ml
from shelfcast.session import cut_lineage
from shelfcast.sources.panel import PanelSources
from shelfcast.sources.sink import refuse_missing, save_json, submission_rows, write_submission

KEY = ["store_nbr", "family", "date"]


def run_forecast(src: PanelSources, md: ml.ModelData | None = None,
                 out_path: str | None = None) -> DataFrame:
    """Horizon rows (id, key, sales) with the chosen weights; with ``out_path``
    also the submission and, beside it, the weights."""
    src = src.materialized()
    md = md or ml.model_data(src)
    # phase 1: holdout fits, run concurrently
    glm_h, (gbt_h, used) = ml.parallel([lambda: ml.fit_tweedie(md, 1.3), lambda: ml.fit_gbt_early_stopped(md)])
    pv = (ml.predict_clipped(glm_h, md.valid, "p_glm")
          .join(ml.predict_clipped(gbt_h, md.valid, "p_gbt", log_target=True).drop("sales"), KEY))
    # phase 2: blend weights (exhaustive simplex grid, deterministic tie-break)
    best = fc.best_of(fc.grid_scores(pv, "sales", ["p_glm", "p_gbt"], None, 20), ["w1", "w2"]).first()
    w_glm, w_gbt = float(best.w1), float(best.w2)
    # phase 3: refit on all known rows, predict the horizon
    refit, trees = ml.refit_data(md), max(1, int(used * ml.GROWN))
    glm_f, gbt_f = ml.parallel([lambda: ml.fit_tweedie(refit, 1.3),
                                lambda: ml.fit_gbt_log1p(refit, max_iter=trees)])
    ph = (ml.predict_clipped(glm_f, md.horizon, "p_glm")
          .join(ml.predict_clipped(gbt_f, md.horizon, "p_gbt", log_target=True).drop("sales"), KEY))
    blend = fc.weighted_blend(["p_glm", "p_gbt"], [w_glm, w_gbt])
    horizon = src.with_id(src.horizon_rows().select(*KEY))
    rows = cut_lineage(submission_rows(horizon, ph.withColumn("pred", blend), keep=KEY))
    refuse_missing(rows)
    if out_path:
        write_submission(rows, out_path)
        save_json(src.spark, {"w_glm": w_glm, "w_gbt": w_gbt, "trees": trees}, f"{out_path.rstrip('/')}-weights")
    return rows.select("id", *KEY, "sales", F.lit(w_glm).alias("w_glm"), F.lit(w_gbt).alias("w_gbt"))
