"""Queries: grain tables — oil, holidays, transactions, hierarchical totals
(inventory 34-39, 60-63, 86-92, 116, 123)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.operators import grains
from shelfcast.operators.series import shifted_frame
from shelfcast.plans.catalog import register
from shelfcast.plans.oracle import sql
from shelfcast.plans.panelplan import oil_dense


def _r(expr: str, name: str) -> str:
    return f"ROUND({expr}, 6) AS {name}"


OIL_SQL = f"""
, o AS (SELECT date, dcoilwtico AS x, ROW_NUMBER() OVER (ORDER BY date) AS rn FROM oil_dense),
w AS (
  SELECT date, x, rn,
    LAG(x, 7) OVER (ORDER BY date) AS l7, LAG(x, 14) OVER (ORDER BY date) AS l14,
    AVG(x) OVER (ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS m28,
    {'STDDEV_SAMP(x) OVER (ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)'} AS s28,
    x - LAG(x, 1) OVER (ORDER BY date) AS diff,
    LAG(x, 1) OVER (ORDER BY date) AS prev, LAG(x, 30) OVER (ORDER BY date) AS x30,
    AVG(x) OVER (ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS ma60,
    COUNT(x) OVER (ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS n60
  FROM o),
rk AS (
  SELECT w.rn, COUNT(o2.x) AS n, COUNT(*) FILTER (WHERE o2.x < w.prev) AS n_less,
         COUNT(*) FILTER (WHERE o2.x = w.prev) AS n_eq
  FROM w JOIN o o2 ON o2.rn BETWEEN w.rn - 90 AND w.rn - 1 GROUP BY w.rn),
pc AS (
  SELECT w.*, CASE WHEN rk.n >= 30 AND w.prev IS NOT NULL
                   THEN (rk.n_less + (rk.n_eq + 1) / 2.0) / rk.n END AS pct
  FROM w LEFT JOIN rk ON rk.rn = w.rn)
SELECT date, {_r('x', 'dcoilwtico')}, {_r('l7', 'oil_lag_7')}, {_r('l14', 'oil_lag_14')},
  {_r('m28', 'oil_rolling_mean_28')}, {_r('s28', 'oil_rolling_std_28')}, {_r('diff', 'oil_diff')},
  CAST(CASE WHEN pct IS NULL THEN 1.0 WHEN pct <= 0.33 THEN 0.0 WHEN pct <= 0.66 THEN 1.0 ELSE 2.0 END AS DOUBLE) AS oil_regime,
  {_r('COALESCE((x - x30) / (x30 + 1), 0.0)', 'oil_momentum_30d')},
  CAST(COALESCE(x > CASE WHEN n60 >= 20 THEN ma60 END, false) AS INTEGER) AS oil_above_60d_ma
FROM pc"""


@register("oil_features", sql(OIL_SQL))
def oil_features_q(src):
    """Oil lags, rolling stats, regime (90-day percentile rank), momentum (date grain)."""
    return grains.oil_features(oil_dense(src))


HS = """
, hs AS (SELECT DISTINCT date FROM holidays WHERE type IN ('Holiday', 'Transfer', 'Bridge', 'Additional'))"""


def _exists(cond: str) -> str:
    return f"CAST(EXISTS (SELECT 1 FROM {cond}) AS INTEGER)"


@register("holiday_flags", sql(HS + f"""
SELECT c.date,
  {_exists('hs WHERE hs.date = c.date')} AS is_holiday,
  {_exists("holidays h WHERE h.date = c.date AND h.locale = 'National' AND NOT COALESCE(h.transferred, false)")} AS is_national_holiday,
  {_exists("holidays h WHERE h.date = c.date AND h.type = 'Bridge'")} AS is_bridge_day,
  {_exists("holidays h WHERE h.date = c.date AND h.type = 'Work Day'")} AS is_work_day,
  {_exists('hs WHERE hs.date = c.date + 1')} AS is_pre_holiday,
  {_exists('hs WHERE hs.date = c.date - 1')} AS is_post_holiday_1d,
  {_exists('hs WHERE hs.date = c.date - 2')} AS is_post_holiday_2d
FROM cal c"""))
def holiday_flags(src):
    """Date-grain holiday flags (existence joins on date and shifted dates)."""
    hc = grains.holiday_calendar(src.calendar, src.holidays)
    return hc.select("date", "is_holiday", "is_national_holiday", "is_bridge_day", "is_work_day",
                     "is_pre_holiday", "is_post_holiday_1d", "is_post_holiday_2d")


@register("holiday_distance", sql(HS + """
SELECT c.date,
  CAST(COALESCE((SELECT MIN(hs.date) FROM hs WHERE hs.date > c.date) - c.date, 30) AS INTEGER) AS days_to_next_holiday,
  CAST(COALESCE(c.date - (SELECT MAX(hs.date) FROM hs WHERE hs.date <= c.date), 30) AS INTEGER) AS days_since_last_holiday
FROM cal c"""))
def holiday_distance(src):
    """As-of distances to the next / last holiday (default 30)."""
    return grains.holiday_distances(src.calendar, src.holidays)


@register("holiday_type", sql("""
SELECT c.date, COALESCE((SELECT CASE h.locale WHEN 'National' THEN 3 WHEN 'Regional' THEN 2
                                  WHEN 'Local' THEN 1 END
                         FROM holidays h WHERE h.date = c.date ORDER BY h.h_seq LIMIT 1), 0) AS holiday_type
FROM cal c"""))
def holiday_type(src):
    """Scope ordinal of the first holiday row of each day (3/2/1, else 0)."""
    return grains.holiday_calendar(src.calendar, src.holidays).select("date", "holiday_type")


HOL_LOCAL_SQL = """
, sd AS (SELECT DISTINCT s.store_nbr, c.date FROM series s CROSS JOIN cal c),
f AS (
  SELECT sd.store_nbr, sd.date,
    CAST(EXISTS (SELECT 1 FROM holidays h WHERE h.date = sd.date AND h.locale = 'National'
                 AND NOT COALESCE(h.transferred, false)) AS INTEGER) AS is_national_holiday,
    CAST(EXISTS (SELECT 1 FROM holidays h WHERE h.date = sd.date AND h.locale = 'Regional'
                 AND h.locale_name = st.state) AS INTEGER) AS is_regional_holiday,
    CAST(EXISTS (SELECT 1 FROM holidays h WHERE h.date = sd.date AND h.locale = 'Local'
                 AND h.locale_name = st.city) AS INTEGER) AS is_local_holiday
  FROM sd JOIN stores st USING (store_nbr))
SELECT *, GREATEST(is_national_holiday, is_regional_holiday, is_local_holiday) AS is_effective_holiday FROM f"""


@register("holiday_local_match", sql(HOL_LOCAL_SQL))
def holiday_local_match(src):
    """Store-day national / regional (state) / local (city) and effective holiday flags."""
    days = grains.store_days(src.store_list, src.first_date, src.panel_end)
    loc = grains.holiday_location_flags(days, src.stores, src.holidays)
    nat = grains.holiday_calendar(src.calendar, src.holidays).select("date", "is_national_holiday")
    out = loc.join(nat, "date", "left")
    return out.select("store_nbr", "date", "is_national_holiday", "is_regional_holiday",
                      "is_local_holiday",
                      F.greatest("is_national_holiday", "is_regional_holiday", "is_local_holiday")
                      .alias("is_effective_holiday"))


TX_BASE = """
, sd AS (SELECT DISTINCT s.store_nbr, c.date FROM series s CROSS JOIN cal c),
last28 AS (
  SELECT store_nbr, AVG(transactions) AS m FROM (
    SELECT store_nbr, transactions, ROW_NUMBER() OVER (PARTITION BY store_nbr ORDER BY date DESC) AS rk
    FROM transactions WHERE transactions IS NOT NULL) WHERE rk <= 28 GROUP BY 1)"""


@register("tx_impute", sql(TX_BASE + "\nSELECT store_nbr, ROUND(m, 6) AS tx_last28_mean FROM last28"))
def tx_impute(src):
    """Per store: mean of its last 28 known daily transaction counts."""
    return grains.transactions_last_mean(src.transactions)


def _tx_sql() -> str:
    w = "PARTITION BY store_nbr ORDER BY date"
    lags = ", ".join(f"LAG(tx, {k}) OVER ({w}) AS l{k}" for k in grains.TX_LAGS)
    rolls = ", ".join(f"AVG(tx) OVER ({w} ROWS BETWEEN {15 + n} PRECEDING AND 16 PRECEDING) AS r{n}"
                      for n in grains.TX_ROLLING)
    outs = ", ".join([_r(f"l{k}", f"transactions_lag_{k}") for k in grains.TX_LAGS]
                     + [_r(f"r{n}", f"transactions_rolling_mean_{n}") for n in grains.TX_ROLLING])
    return TX_BASE + f""",
imp AS (
  SELECT sd.store_nbr, sd.date, COALESCE(CAST(t.transactions AS DOUBLE), l.m, 0.0) AS tx
  FROM sd LEFT JOIN transactions t USING (store_nbr, date) LEFT JOIN last28 l USING (store_nbr)),
f AS (SELECT store_nbr, date, tx, {lags}, {rolls}, AVG(tx) OVER (PARTITION BY store_nbr) AS sm FROM imp)
SELECT store_nbr, date, {_r('tx', 'transactions')}, {outs},
  {_r('l16 / (sm + 1)', 'tx_vs_store_mean')}, {_r('r7 / (r28 + 1)', 'tx_rolling_trend')}
FROM f"""


@register("tx_features", sql(_tx_sql()))
def tx_features(src):
    """Store-day transactions (imputed), lags 16/21/28, shifted means, ratios."""
    days = grains.store_days(src.store_list, src.first_date, src.panel_end)
    return grains.transaction_features(days, src.transactions)


# ----------------------------------------------------------------- hierarchy
PS = """
, ps AS (SELECT p.*, s.city, s.cluster, s.store_type FROM panel p JOIN stores s USING (store_nbr))"""


def _hier_sql(keys: str, agg: str, total: str, lags, prefix: str, rolling=()) -> str:
    w = f"PARTITION BY {keys} ORDER BY date"
    cols = [f"LAG({total}, {k}) OVER ({w}) AS {prefix}_lag_{k}" if agg == "SUM"
            else _r(f"LAG({total}, {k}) OVER ({w})", f"{prefix}_lag_{k}") for k in lags]
    cols += [_r(f"AVG({total}) OVER ({w} ROWS BETWEEN {15 + n} PRECEDING AND 16 PRECEDING)",
                f"{prefix}_rolling_{n}") for n in rolling]
    tot = total if agg == "SUM" else f"ROUND({total}, 6) AS {total}"
    return PS + f""",
g AS (SELECT {keys}, date, {agg}(sales) AS {total} FROM ps GROUP BY ALL)
SELECT {keys}, date, {tot}, {', '.join(cols)} FROM g"""


@register("hier_store", sql(_hier_sql("store_nbr", "SUM", "store_total", [16, 28], "store_total", [7])))
def hier_store(src):
    """Store-day totals with lags 16/28 by date and a shifted 7-day mean."""
    return _hier(src)["store"]


@register("hier_family", sql(_hier_sql("family", "SUM", "family_national", [16, 28], "family_national")))
def hier_family(src):
    return _hier(src)["family"]


@register("hier_city", sql(_hier_sql("city", "SUM", "city_total", [16], "city_total")))
def hier_city(src):
    return _hier(src)["city"]


@register("hier_cluster_family", sql(_hier_sql("cluster, family", "AVG", "cluster_family_avg", [16],
                                               "cluster_family")))
def hier_cluster_family(src):
    return _hier(src)["cluster_family"]


@register("hier_type_family", sql(_hier_sql("store_type, family", "AVG", "type_family_avg", [16],
                                            "store_type_family")))
def hier_type_family(src):
    return _hier(src)["type_family"]


def _hier(src):
    p = src.panel.join(src.stores, "store_nbr", "left")
    return grains.hierarchical_tables(p)


# ------------------------------------------------ transactions forecast grid
TX_GRID_SQL = """
, st AS (SELECT DISTINCT store_nbr FROM series),
hd AS (SELECT date FROM cal, bounds b WHERE date > b.train_end),
g AS (SELECT st.store_nbr, hd.date FROM st CROSS JOIN hd),
lastn AS (
  SELECT store_nbr,
    AVG(transactions) FILTER (WHERE rk <= 7) AS m7, AVG(transactions) FILTER (WHERE rk <= 14) AS m14,
    AVG(transactions) FILTER (WHERE rk <= 28) AS m28
  FROM (SELECT store_nbr, transactions, ROW_NUMBER() OVER (PARTITION BY store_nbr ORDER BY date DESC) AS rk
        FROM transactions) WHERE rk <= 50 GROUP BY 1)"""


@register("tx_forecast_grid", sql(TX_GRID_SQL + """
SELECT g.store_nbr, g.date, CAST(isodow(g.date) - 1 AS INTEGER) AS dow, CAST(month(g.date) AS INTEGER) AS month,
  CAST(day(g.date) AS INTEGER) AS day, CAST(weekofyear(g.date) AS INTEGER) AS week,
  CAST(isodow(g.date) >= 6 AS INTEGER) AS is_weekend,
  t16.transactions AS tx_lag_16, t21.transactions AS tx_lag_21, t28.transactions AS tx_lag_28,
  t35.transactions AS tx_lag_35, ROUND(l.m7, 6) AS tx_last_mean_7, ROUND(l.m14, 6) AS tx_last_mean_14,
  ROUND(l.m28, 6) AS tx_last_mean_28
FROM g
LEFT JOIN transactions t16 ON t16.store_nbr = g.store_nbr AND t16.date = g.date - 16
LEFT JOIN transactions t21 ON t21.store_nbr = g.store_nbr AND t21.date = g.date - 21
LEFT JOIN transactions t28 ON t28.store_nbr = g.store_nbr AND t28.date = g.date - 28
LEFT JOIN transactions t35 ON t35.store_nbr = g.store_nbr AND t35.date = g.date - 35
LEFT JOIN lastn l ON l.store_nbr = g.store_nbr"""))
def tx_forecast_grid(src):
    """Store × horizon-day grid with calendar parts, transactions k days before
    by date lookup (self equi-join; absent -> null) and last-N known means."""
    return tx_grid(src)


def tx_grid(src):
    stores = src.store_list
    grid = stores.select("store_nbr", F.explode(F.sequence(F.date_add(src.train_end, 1),
                                                           src.panel_end)).alias("date"))
    tx = src.transactions
    out = grid.select("store_nbr", "date", F.weekday("date").alias("dow"), F.month("date").alias("month"),
                      F.dayofmonth("date").alias("day"), F.weekofyear("date").alias("week"),
                      (F.weekday("date") >= 5).cast("int").alias("is_weekend"))
    # each day's count goes to the four days that look back on it: one lookup
    lags = (16, 21, 28, 35)
    ahead = tx.select("store_nbr", "transactions", "date", F.explode(F.array(*map(F.lit, lags))).alias("_k"))
    look = (ahead.select("store_nbr", F.date_add("date", F.col("_k")).alias("date"), "_k", "transactions")
            .filter(F.col("date") > src.train_end).groupBy("store_nbr", "date")
            .agg(*[F.max(F.when(F.col("_k") == k, F.col("transactions"))).alias(f"tx_lag_{k}") for k in lags]))
    rank = F.row_number().over(Window.partitionBy("store_nbr").orderBy(F.col("date").desc()))
    last = (tx.withColumn("_rk", rank).filter(F.col("_rk") <= 28).groupBy("store_nbr")
            .agg(*[F.avg(F.when(F.col("_rk") <= n, F.col("transactions"))).alias(f"tx_last_mean_{n}")
                   for n in (7, 14, 28)]))
    return out.join(look, ["store_nbr", "date"], "left").join(last, "store_nbr", "left")


TX_FEATURE_SQL = ", ".join(f"LAG(x.transactions, {k}) OVER w AS tx_lag_{k}" for k in (16, 21, 28, 35)) + ", " + ", ".join(
    f"ROUND(AVG(x.transactions) OVER (PARTITION BY d.store_nbr ORDER BY d.date ROWS BETWEEN {15 + n} PRECEDING "
    f"AND 16 PRECEDING), 6) AS tx_rolling_mean_{n}" for n in (7, 14, 28))


@register("tx_forecast_features", sql(f"""
, d AS (SELECT st.store_nbr, c.date FROM (SELECT DISTINCT store_nbr FROM series) st CROSS JOIN cal c)
SELECT d.store_nbr, d.date, CAST(x.transactions AS DOUBLE) AS transactions,
  CAST(isodow(d.date) - 1 AS INTEGER) AS dow, CAST(month(d.date) AS INTEGER) AS month,
  CAST(day(d.date) AS INTEGER) AS day, CAST(weekofyear(d.date) AS INTEGER) AS week,
  CAST(isodow(d.date) >= 6 AS INTEGER) AS is_weekend, {TX_FEATURE_SQL}
FROM d LEFT JOIN transactions x USING (store_nbr, date)
WINDOW w AS (PARTITION BY d.store_nbr ORDER BY d.date)"""))
def tx_forecast_features(src):
    """Features of the transactions forecaster: calendar parts, lags by day and
    shifted means for every store and day, one definition for training and horizon."""
    return tx_feature_frame(src)


def tx_feature_frame(src):
    days = grains.store_days(src.store_list, src.first_date, src.panel_end)
    tx = days.join(src.transactions, ["store_nbr", "date"], "left")
    w = Window.partitionBy("store_nbr").orderBy("date")
    return tx.select(
        "store_nbr", "date", F.col("transactions").cast("double").alias("transactions"),
        F.weekday("date").alias("dow"), F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"), F.weekofyear("date").alias("week"),
        (F.weekday("date") >= 5).cast("int").alias("is_weekend"),
        *[F.lag("transactions", k).over(w).cast("double").alias(f"tx_lag_{k}") for k in (16, 21, 28, 35)],
        *[F.avg("transactions").over(shifted_frame(w, 16, n)).alias(f"tx_rolling_mean_{n}")
          for n in (7, 14, 28)])


@register("tx_forecast_applied", sql(TX_GRID_SQL + """
SELECT p.store_nbr, p.family, p.date, ROUND(COALESCE(l.m7, 0.0), 6) AS transactions_pred
FROM panel p JOIN bounds b ON p.date > b.train_end LEFT JOIN lastn l ON l.store_nbr = p.store_nbr"""))
def tx_forecast_applied(src):
    """Horizon panel rows with the store-day transactions forecast (last-7 known
    mean of the grid), looked up by (store, date) with default 0."""
    g = tx_grid(src).select("store_nbr", "date", F.col("tx_last_mean_7").alias("transactions_pred"))
    h = src.horizon_rows().select("store_nbr", "family", "date")
    return h.join(g, ["store_nbr", "date"], "left").select(
        "store_nbr", "family", "date", F.coalesce("transactions_pred", F.lit(0.0)).alias("transactions_pred"))
