"""Queries: the assembled feature matrix, its interaction features and the
category codes (inventory 22-23, 117-121, 127)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.plans.catalog import register
from shelfcast.plans.features import (CATEGORICAL, build_features, interaction_columns,
                                      training_matrix)
from shelfcast.plans.oracle import sql, sub
from shelfcast.plans.q_features import PAYDAY_SQL
from shelfcast.plans.q_grains import HOL_LOCAL_SQL, OIL_SQL

KEY = ["store_nbr", "family", "date"]
# features per aggregation pass of the profile (keeps each generated method small)
PROFILE_CHUNK = 24
SW = "PARTITION BY store_nbr, family ORDER BY date"
INTERACTIONS = ["sales_velocity_16_28", "sales_velocity_16_42", "sales_yoy_change", "promo_x_sf_mean",
                "promo_x_sf_dow_mean", "lag16_to_mean_ratio", "dow_trend_3w_4w", "dow_yoy_ratio",
                "recent_vs_overall_ratio", "promo_x_dow_avg", "oil_x_store_type", "holiday_x_payday"]


def _lag(k: int) -> str:
    return f"LAG(sales, {k}) OVER ({SW})"


_DOW4 = ("(" + " + ".join(f"COALESCE({_lag(7 * w)}, 0)" for w in (3, 4, 5, 6)) + ") / NULLIF("
         + " + ".join(f"CAST({_lag(7 * w)} IS NOT NULL AS INTEGER)" for w in (3, 4, 5, 6)) + ", 0)")

INTERACTION_SQL = f"""
, tr AS (SELECT t.*, CAST(isodow(t.date) - 1 AS INTEGER) AS _dow FROM train t WHERE t.sales IS NOT NULL),
sf AS (SELECT store_nbr, family, AVG(sales) AS sf_mean FROM tr GROUP BY 1, 2),
sfd AS (SELECT store_nbr, family, _dow, AVG(sales) AS sf_dow_mean FROM tr GROUP BY 1, 2, 3),
sfr AS (SELECT store_nbr, family, AVG(sales) AS sf_recent_mean FROM tr
        WHERE date >= (SELECT MAX(date) FROM tr) - 90 GROUP BY 1, 2),
lg AS (SELECT store_nbr, family, date, onpromotion, CAST(isodow(date) - 1 AS INTEGER) AS _dow,
         {_lag(16)} AS l16, {_lag(28)} AS l28, {_lag(42)} AS l42, {_lag(364)} AS l364, {_lag(21)} AS d3,
         {_DOW4} AS dow4
       FROM panel),
oilf AS {sub(OIL_SQL)},
hol AS {sub(HOL_LOCAL_SQL)},
pay AS {sub(PAYDAY_SQL)}
SELECT lg.store_nbr, lg.family, lg.date,
  lg.l16 - lg.l28 AS sales_velocity_16_28, lg.l16 - lg.l42 AS sales_velocity_16_42,
  lg.l28 - lg.l364 AS sales_yoy_change,
  ROUND(lg.onpromotion * sf.sf_mean, 6) AS promo_x_sf_mean,
  ROUND(lg.onpromotion * sfd.sf_dow_mean, 6) AS promo_x_sf_dow_mean,
  ROUND(lg.l16 / (sf.sf_mean + 1.0), 6) AS lag16_to_mean_ratio,
  ROUND(lg.d3 / (lg.l28 + 1.0), 6) AS dow_trend_3w_4w,
  ROUND(lg.l28 / (lg.l364 + 1.0), 6) AS dow_yoy_ratio,
  ROUND(sfr.sf_recent_mean / (sf.sf_mean + 1.0), 6) AS recent_vs_overall_ratio,
  ROUND(lg.onpromotion * lg.dow4, 6) AS promo_x_dow_avg,
  oilf.oil_regime * CAST(CASE st.store_type WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 3 WHEN 'D' THEN 2
                                             WHEN 'E' THEN 1 ELSE 3 END AS DOUBLE) AS oil_x_store_type,
  hol.is_effective_holiday * pay.is_post_payday_window AS holiday_x_payday
FROM lg JOIN stores st USING (store_nbr)
LEFT JOIN sf ON sf.store_nbr = lg.store_nbr AND sf.family = lg.family
LEFT JOIN sfd ON sfd.store_nbr = lg.store_nbr AND sfd.family = lg.family AND sfd._dow = lg._dow
LEFT JOIN sfr ON sfr.store_nbr = lg.store_nbr AND sfr.family = lg.family
LEFT JOIN oilf ON oilf.date = lg.date
LEFT JOIN hol ON hol.store_nbr = lg.store_nbr AND hol.date = lg.date
LEFT JOIN pay ON pay.date = lg.date"""


def feature_table(src):
    """The assembled feature matrix (as of train_end), checkpointed once per
    session and shared by the queries that read it."""
    from shelfcast.session import cut_lineage, session_table
    return session_table(src.spark, ("features", type(src).__name__, *src.options().values()), src.sf_dir,
                         lambda: cut_lineage(build_features(src)))


@register("interaction_features", sql(INTERACTION_SQL))
def interaction_features(src):
    """Velocities, ratios, promotion and oil/holiday interactions from the assembled matrix."""
    return feature_table(src).select(*KEY, *INTERACTIONS)


def feature_profile(matrix):
    """One row per numeric feature: non-null count, mean, min, max over all rows.

    A single aggregation pass (4 aggregates per column, partial on the map
    side) returns one wide row, which is reshaped to one row per feature."""
    from pyspark.sql import types as T
    cols = [f.name for f in matrix.schema.fields
            if f.name not in ("id", "date", "sales", "store_nbr") and f.name not in CATEGORICAL
            and isinstance(f.dataType, (T.DoubleType, T.IntegerType, T.LongType))]
    parts = []
    for start in range(0, len(cols), PROFILE_CHUNK):
        chunk = cols[start:start + PROFILE_CHUNK]
        aggs = []
        for i, c in enumerate(chunk):
            x = F.col(c).cast("double")
            aggs.append(F.struct(F.lit(c).alias("feature"), F.count(x).alias("n_non_null"),
                                 F.avg(x).alias("mean"), F.min(x).alias("min"),
                                 F.max(x).alias("max")).alias(f"_s{i}"))
        wide = matrix.agg(*aggs)
        parts.append(wide.select(F.explode(F.array(*[F.col(f"_s{i}") for i in range(len(chunk))]))
                                 .alias("s")).select("s.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("feature_matrix")
def feature_matrix(src):
    """The assembled feature matrix (every panel row, ~140 features, numeric
    nulls -> 0), profiled per feature so the result stays small.

    Rows-only here: each column group is checked exactly by its own key
    (lag_features, rolling_features, oil_features, holiday_*, tx_features,
    hier_*, target_stats_applied, interaction_features, ...); the full matrix
    is ``plans.features.training_matrix(build_features(src))``."""
    return feature_profile(training_matrix(feature_table(src)))


@register("category_codes", sql("""
, ts AS (SELECT t.family, s.store_type, s.cluster, s.city, s.state, CAST(isodow(t.date) - 1 AS INTEGER) AS dow
         FROM train t JOIN stores s USING (store_nbr)),
v AS (
  SELECT 'family' AS feature, family AS value, family AS k, 0 AS kn FROM ts
  UNION SELECT 'store_type', store_type, store_type, 0 FROM ts
  UNION SELECT 'cluster', CAST(cluster AS VARCHAR), '', cluster FROM ts
  UNION SELECT 'city', city, city, 0 FROM ts
  UNION SELECT 'state', state, state, 0 FROM ts
  UNION SELECT 'family_x_store_type', family || '_' || store_type, family || '_' || store_type, 0 FROM ts
  UNION SELECT 'family_x_cluster', family || '_' || CAST(cluster AS VARCHAR), family || '_' || CAST(cluster AS VARCHAR), 0 FROM ts
  UNION SELECT 'dow_x_family', CAST(dow AS VARCHAR) || '_' || family, CAST(dow AS VARCHAR) || '_' || family, 0 FROM ts)
SELECT feature, value, CAST(DENSE_RANK() OVER (PARTITION BY feature ORDER BY kn, k) - 1 AS INTEGER) AS code FROM v"""))
def category_codes(src):
    """Category code tables fitted on the training rows: sorted categories
    (numbers in numeric order), code = position; unseen values map to null."""
    return fit_codes(src)


def fit_codes(src):
    t = src.train_rows().join(src.stores, "store_nbr").withColumn("dow", F.weekday("date"))
    t = t.select("family", "store_type", "cluster", "city", "state",
                 F.concat_ws("_", "family", "store_type").alias("family_x_store_type"),
                 F.concat_ws("_", "family", F.col("cluster").cast("string")).alias("family_x_cluster"),
                 F.concat_ws("_", F.col("dow").cast("string"), "family").alias("dow_x_family"))
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"),
                               (F.col(c) if c == "cluster" else F.lit(0)).cast("int").alias("kn"),
                               F.lit("").alias("k") if c == "cluster" else F.col(c).alias("k")) for c in CATEGORICAL])
    v = t.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    w = Window.partitionBy("feature").orderBy("kn", "k")
    return v.select("feature", "value", (F.dense_rank().over(w) - 1).cast("int").alias("code"))


def apply_codes(df, codes):
    """Each categorical column's code as ``<column>_code`` (null if unseen). The
    code tables are dimensions; each becomes one map, looked up in place."""
    out = []
    for c in CATEGORICAL:
        own = codes.filter(F.col("feature") == c)
        lookup = own.select(F.map_from_entries(F.collect_list(F.struct("value", "code")))).scalar()
        out.append(F.try_element_at(lookup, F.col(c).cast("string")).alias(f"{c}_code"))
    return df.select("*", *out)


_CODE_SQL = """
, seen AS (SELECT DISTINCT t.family, s.store_type, s.cluster, s.city, s.state, CAST(isodow(t.date) - 1 AS VARCHAR) AS dow
           FROM train t JOIN stores s USING (store_nbr)),
c_family AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT family AS v FROM seen)),
c_store_type AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT store_type AS v FROM seen)),
c_cluster AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT cluster AS v FROM seen)),
c_city AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT city AS v FROM seen)),
c_state AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT state AS v FROM seen)),
c_ft AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT family || '_' || store_type AS v FROM seen)),
c_fc AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT family || '_' || CAST(cluster AS VARCHAR) AS v FROM seen)),
c_df AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT dow || '_' || family AS v FROM seen))
SELECT p.store_nbr, p.family, p.date, CAST(c_family.c AS INTEGER) AS family_code, CAST(c_store_type.c AS INTEGER) AS store_type_code,
  CAST(c_cluster.c AS INTEGER) AS cluster_code, CAST(c_city.c AS INTEGER) AS city_code, CAST(c_state.c AS INTEGER) AS state_code,
  CAST(c_ft.c AS INTEGER) AS family_x_store_type_code, CAST(c_fc.c AS INTEGER) AS family_x_cluster_code,
  CAST(c_df.c AS INTEGER) AS dow_x_family_code
FROM panel p JOIN stores s USING (store_nbr)
LEFT JOIN c_family ON c_family.v = p.family LEFT JOIN c_store_type ON c_store_type.v = s.store_type
LEFT JOIN c_cluster ON c_cluster.v = s.cluster LEFT JOIN c_city ON c_city.v = s.city LEFT JOIN c_state ON c_state.v = s.state
LEFT JOIN c_ft ON c_ft.v = p.family || '_' || s.store_type
LEFT JOIN c_fc ON c_fc.v = p.family || '_' || CAST(s.cluster AS VARCHAR)
LEFT JOIN c_df ON c_df.v = CAST(isodow(p.date) - 1 AS VARCHAR) || '_' || p.family"""


@register("category_encoded", sql(_CODE_SQL))
def category_encoded(src):
    """Every panel row with the codes of its eight categorical features, fitted
    on the training rows and reused on the horizon."""
    from shelfcast.functions import calendar as cal
    src = src.materialized()
    p = src.panel.join(src.stores, "store_nbr")
    rows = apply_codes(p.select("*", *cal.cross_columns()), fit_codes(src))
    return rows.select(*KEY, *[f"{c}_code" for c in CATEGORICAL])
