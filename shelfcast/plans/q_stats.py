"""Queries: target statistics fitted as of train_end and applied by joins (inventory 33, 50-59)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import stats
from shelfcast.plans.catalog import register
from shelfcast.plans.oracle import sql

TR = """
, tr AS (SELECT t.*, s.cluster, CAST(isodow(t.date) - 1 AS INTEGER) AS _dow
         FROM train t JOIN stores s USING (store_nbr) WHERE t.sales IS NOT NULL),
rc AS (SELECT * FROM tr WHERE date >= (SELECT MAX(date) FROM tr) - 90)"""

STAT_SQL = {
    "store_family": """SELECT store_nbr, family, ROUND(AVG(sales), 6) AS sf_mean,
  ROUND(quantile_cont(sales, 0.5), 6) AS sf_median, ROUND(STDDEV_SAMP(sales), 6) AS sf_std,
  ROUND(quantile_cont(sales, 0.25), 6) AS sf_q25, ROUND(quantile_cont(sales, 0.75), 6) AS sf_q75
FROM tr GROUP BY store_nbr, family""",
    "store_family_zero": """SELECT store_nbr, family,
  ROUND(SUM(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) / COUNT(*), 6) AS sf_zero_ratio
FROM tr GROUP BY store_nbr, family""",
    "store_family_dow": """SELECT store_nbr, family, _dow, ROUND(AVG(sales), 6) AS sf_dow_mean
FROM tr GROUP BY store_nbr, family, _dow""",
    "family": """SELECT family, ROUND(AVG(sales), 6) AS family_mean, ROUND(STDDEV_SAMP(sales), 6) AS family_std
FROM tr GROUP BY family""",
    "family_dow": "SELECT family, _dow, ROUND(AVG(sales), 6) AS family_dow_mean FROM tr GROUP BY family, _dow",
    "store": """SELECT store_nbr, ROUND(AVG(sales), 6) AS store_mean, ROUND(STDDEV_SAMP(sales), 6) AS store_std
FROM tr GROUP BY store_nbr""",
    "store_dow": "SELECT store_nbr, _dow, ROUND(AVG(sales), 6) AS store_dow_mean FROM tr GROUP BY store_nbr, _dow",
    "store_family_recent": """SELECT store_nbr, family, ROUND(AVG(sales), 6) AS sf_recent_mean,
  ROUND(STDDEV_SAMP(sales), 6) AS sf_recent_std
FROM rc GROUP BY store_nbr, family""",
    "store_family_dow_recent": """SELECT store_nbr, family, _dow, ROUND(AVG(sales), 6) AS sf_dow_recent_mean
FROM rc GROUP BY store_nbr, family, _dow""",
    "cluster_family": """SELECT cluster, family, ROUND(AVG(sales), 6) AS cluster_family_mean,
  ROUND(STDDEV_SAMP(sales), 6) AS cluster_family_std
FROM tr GROUP BY cluster, family""",
}


def fitted(src):
    """Statistics fitted on the training rows (cluster from the store table)."""
    train = src.train_rows().join(src.stores.select("store_nbr", "cluster"), "store_nbr", "left")
    return stats.fit_target_stats(train, as_of=src.train_end)


def _make(name: str, key: str, doc: str):
    def q(src):
        return fitted(src)[name]
    q.__doc__ = doc
    register(key, sql(TR + "\n" + STAT_SQL[name]))(q)


_make("store_family", "stats_store_family",
      "Per series mean, median, sample std, exact 25/75% quantiles (linear interpolation).")
_make("store_family_zero", "stats_zero_ratio", "Per series share of zero-sales days.")
_make("store_family_dow", "stats_store_family_dow", "Per series and weekday (Monday = 0) mean.")
_make("family", "stats_family", "Per family mean and std.")
_make("family_dow", "stats_family_dow", "Per family and weekday mean.")
_make("store", "stats_store", "Per store mean and std.")
_make("store_dow", "stats_store_dow", "Per store and weekday mean.")
_make("store_family_recent", "stats_recent", "Per series mean/std over the last 90 days.")
_make("store_family_dow_recent", "stats_recent_dow", "Per series and weekday mean over the last 90 days.")
_make("cluster_family", "stats_cluster_family", "Per cluster and family mean and std.")


APPLIED_SQL = TR + ",\n" + ",\n".join(f"st_{name} AS ({text})" for name, text in STAT_SQL.items()) + """,
p AS (SELECT q.store_nbr, q.family, q.date, s.cluster, CAST(isodow(q.date) - 1 AS INTEGER) AS _dow
      FROM panel q JOIN stores s USING (store_nbr))
SELECT p.store_nbr, p.family, p.date, sf_mean, sf_median, sf_std, sf_q25, sf_q75, sf_zero_ratio, sf_dow_mean,
  family_mean, family_std, family_dow_mean, store_mean, store_std, store_dow_mean, sf_recent_mean, sf_recent_std,
  sf_dow_recent_mean, cluster_family_mean, cluster_family_std
FROM p
LEFT JOIN st_store_family USING (store_nbr, family)
LEFT JOIN st_store_family_zero USING (store_nbr, family)
LEFT JOIN st_store_family_dow USING (store_nbr, family, _dow)
LEFT JOIN st_family USING (family)
LEFT JOIN st_family_dow USING (family, _dow)
LEFT JOIN st_store USING (store_nbr)
LEFT JOIN st_store_dow USING (store_nbr, _dow)
LEFT JOIN st_store_family_recent USING (store_nbr, family)
LEFT JOIN st_store_family_dow_recent USING (store_nbr, family, _dow)
LEFT JOIN st_cluster_family USING (cluster, family)"""


@register("target_stats_applied", sql(APPLIED_SQL))
def target_stats_applied(src):
    """Every panel row (train and horizon) with the 18 fitted statistics."""
    src = src.materialized()
    st = fitted(src)
    p = src.panel.select("store_nbr", "family", "date").join(
        src.stores.select("store_nbr", "cluster"), "store_nbr", "left")
    return stats.apply_target_stats(p, st).select(
        "store_nbr", "family", "date", *stats.stat_columns())


ORDERED = [("family",), ("store_type",), ("cluster",), ("city",), ("state",),
           ("family", "store_type"), ("family", "cluster"), ("family", stats.DOW)]
BEFORE = "ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 16 DAYS PRECEDING"


@register("ordered_category_stats", sql(f"""
, p AS (SELECT q.*, s.store_type, s.cluster, s.city, s.state, CAST(isodow(q.date) - 1 AS INTEGER) AS _dow
        FROM panel q JOIN stores s USING (store_nbr)),
before AS (SELECT *, AVG(sales) OVER ({BEFORE}) AS prior,
  SUM(sales) OVER f AS sum_f, COUNT(sales) OVER f AS n_f,
  SUM(sales) OVER st AS sum_st, COUNT(sales) OVER st AS n_st,
  SUM(sales) OVER cl AS sum_cl, COUNT(sales) OVER cl AS n_cl,
  SUM(sales) OVER ci AS sum_ci, COUNT(sales) OVER ci AS n_ci,
  SUM(sales) OVER sa AS sum_sa, COUNT(sales) OVER sa AS n_sa,
  SUM(sales) OVER fst AS sum_fst, COUNT(sales) OVER fst AS n_fst,
  SUM(sales) OVER fcl AS sum_fcl, COUNT(sales) OVER fcl AS n_fcl,
  SUM(sales) OVER fd AS sum_fd, COUNT(sales) OVER fd AS n_fd
  FROM p WINDOW f AS (PARTITION BY family {BEFORE}), st AS (PARTITION BY store_type {BEFORE}),
    cl AS (PARTITION BY cluster {BEFORE}), ci AS (PARTITION BY city {BEFORE}), sa AS (PARTITION BY state {BEFORE}),
    fst AS (PARTITION BY family, store_type {BEFORE}), fcl AS (PARTITION BY family, cluster {BEFORE}),
    fd AS (PARTITION BY family, _dow {BEFORE}))
SELECT store_nbr, family, date,
  ROUND((COALESCE(sum_f, 0) + prior) / (n_f + 1), 6) AS ordered_family,
  ROUND((COALESCE(sum_st, 0) + prior) / (n_st + 1), 6) AS ordered_store_type,
  ROUND((COALESCE(sum_cl, 0) + prior) / (n_cl + 1), 6) AS ordered_cluster,
  ROUND((COALESCE(sum_ci, 0) + prior) / (n_ci + 1), 6) AS ordered_city,
  ROUND((COALESCE(sum_sa, 0) + prior) / (n_sa + 1), 6) AS ordered_state,
  ROUND((COALESCE(sum_fst, 0) + prior) / (n_fst + 1), 6) AS ordered_family_x_store_type,
  ROUND((COALESCE(sum_fcl, 0) + prior) / (n_fcl + 1), 6) AS ordered_family_x_cluster,
  ROUND((COALESCE(sum_fd, 0) + prior) / (n_fd + 1), 6) AS "ordered_family_x__dow"
FROM before"""))
def ordered_category_stats(src):
    """Ordered target statistics of the categories and their crosses: means over
    rows at least 16 days earlier, for every panel row (train and horizon)."""
    src = src.materialized()
    rows = (src.panel.select("store_nbr", "family", "date", "sales").join(src.stores, "store_nbr", "left")
            .withColumn(stats.DOW, F.weekday("date")))
    return stats.ordered_category_stats(rows, ORDERED).select(
        "store_nbr", "family", "date", *map(stats.ordered_name, ORDERED))
