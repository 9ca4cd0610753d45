"""Queries: report (EDA) aggregates over the training panel (inventory 27, 45-47,
49, 71-76, 95-97, 102, 159-177). One filtered/merged DataFrame, many
aggregates; each is a single group-by with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import quantiles, rmsle
from shelfcast.functions.moments import std_samp
from shelfcast.operators import clean
from shelfcast.plans.catalog import register
from shelfcast.plans.oracle import sql
from shelfcast.plans.q_features import holdout_naive

# Fixed label tables of the reports.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# Report filter (sidebar selection) used by eda_filtered.
FILTER_YEARS = [1998, 1999]
FILTER_TYPES = ["A", "B"]
HIST_BINS = 50

TS = """
, ts AS (SELECT t.*, s.city, s.state, s.store_type, s.cluster FROM train t JOIN stores s USING (store_nbr))"""


def train_stores(src):
    return src.train_rows().join(src.stores, "store_nbr")


def _name_map(names, key):
    return F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i + (0 if key == "dow" else 1)), F.lit(n))])


@register("eda_kpis", sql("""
SELECT SUM(sales) AS total_sales, ROUND(AVG(sales), 6) AS mean_sales,
  ROUND(AVG(CAST(sales = 0 AS DOUBLE)), 6) AS zero_share, ROUND(AVG(CAST(onpromotion > 0 AS DOUBLE)), 6) AS promo_share
FROM train"""))
def eda_kpis(src):
    """Total, mean, share of zero-sales rows, share of promoted rows."""
    t = src.train_rows()
    return t.agg(F.sum("sales").alias("total_sales"), F.avg("sales").alias("mean_sales"),
                 F.avg((F.col("sales") == 0).cast("double")).alias("zero_share"),
                 F.avg((F.col("onpromotion") > 0).cast("double")).alias("promo_share"))


@register("overview_kpis", sql(TS + """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT store_nbr) AS n_stores, COUNT(DISTINCT store_type) AS n_store_types,
  COUNT(DISTINCT family) AS n_families, COUNT(DISTINCT cluster) AS n_clusters, MIN(date) AS first_date, MAX(date) AS last_date
FROM ts"""))
def overview_kpis(src):
    """Rows, distinct stores / store types / families / clusters, date range."""
    t = train_stores(src)
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("store_nbr").alias("n_stores"),
                 F.count_distinct("store_type").alias("n_store_types"),
                 F.count_distinct("family").alias("n_families"),
                 F.count_distinct("cluster").alias("n_clusters"),
                 F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@register("eda_monthly_sales", sql("""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, SUM(sales) AS sales FROM train GROUP BY 1"""))
def eda_monthly_sales(src):
    """Total sales per calendar month."""
    return src.train_rows().groupBy(F.trunc("date", "month").alias("month")).agg(F.sum("sales").alias("sales"))


@register("eda_monthly_mean", sql("""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, ROUND(AVG(sales), 6) AS sales FROM train GROUP BY 1"""))
def eda_monthly_mean(src):
    return src.train_rows().groupBy(F.trunc("date", "month").alias("month")).agg(F.avg("sales").alias("sales"))


@register("eda_dow_sales", sql("""
SELECT CAST(isodow(date) - 1 AS INTEGER) AS dow, CASE isodow(date) WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday'
  WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' ELSE 'Sunday' END AS day_name,
  ROUND(AVG(sales), 6) AS sales FROM train GROUP BY 1, 2"""))
def eda_dow_sales(src):
    """Mean sales by weekday, ordered by weekday number (not name)."""
    t = src.train_rows().withColumn("dow", F.weekday("date"))
    g = t.groupBy("dow").agg(F.avg("sales").alias("sales"))
    return g.select("dow", _name_map(DAY_NAMES, "dow")[F.col("dow")].alias("day_name"), "sales").orderBy("dow")


@register("eda_month_sales", sql("""
SELECT CAST(month(date) AS INTEGER) AS m, strftime(date, '%b') AS month, ROUND(AVG(sales), 6) AS sales
FROM train GROUP BY 1, 2"""))
def eda_month_sales(src):
    """Mean sales by calendar month with the month's short name."""
    g = src.train_rows().groupBy(F.month("date").alias("m")).agg(F.avg("sales").alias("sales"))
    return g.select("m", _name_map(MONTH_NAMES, "month")[F.col("m")].alias("month"), "sales")


@register("eda_type_share", sql(TS + """
SELECT store_type, SUM(sales) AS sales, ROUND(SUM(sales) / SUM(SUM(sales)) OVER (), 6) AS share
FROM ts GROUP BY store_type"""))
def eda_type_share(src):
    """Sales and share of total by store type (a window over the few type rows)."""
    g = train_stores(src).groupBy("store_type").agg(F.sum("sales").alias("sales"))
    return g.withColumn("share", F.col("sales") / F.sum("sales").over(Window.partitionBy()))


@register("eda_cluster_sales", sql(TS + "\nSELECT cluster, ROUND(AVG(sales), 6) AS sales FROM ts GROUP BY cluster"))
def eda_cluster_sales(src):
    return train_stores(src).groupBy("cluster").agg(F.avg("sales").alias("sales"))


@register("eda_city_type", sql(TS + """
SELECT city, store_type, ROUND(AVG(sales), 6) AS sales FROM ts GROUP BY 1, 2
ORDER BY AVG(sales) DESC, city, store_type LIMIT 40"""))
def eda_city_type(src):
    """Top 40 (city, store type) by mean sales (top-k report)."""
    g = train_stores(src).groupBy("city", "store_type").agg(F.avg("sales").alias("sales"))
    return g.orderBy(F.col("sales").desc(), "city", "store_type").limit(40)


@register("eda_family_sales", sql("SELECT family, ROUND(AVG(sales), 6) AS sales FROM train GROUP BY family"))
def eda_family_sales(src):
    return src.train_rows().groupBy("family").agg(F.avg("sales").alias("sales")).orderBy("sales")


@register("eda_top_families", sql("""
SELECT family, ROUND(AVG(sales), 6) AS mean_sales, ROUND(AVG(CAST(sales = 0 AS DOUBLE)), 6) AS zero_share
FROM train GROUP BY family ORDER BY AVG(sales) DESC, family LIMIT 10"""))
def eda_top_families(src):
    """Ten families with the highest mean sales (top-k report) and their zero share."""
    g = src.train_rows().groupBy("family").agg(
        F.avg("sales").alias("mean_sales"), F.avg((F.col("sales") == 0).cast("double")).alias("zero_share"))
    return g.orderBy(F.col("mean_sales").desc(), "family").limit(10)


@register("eda_promo_impact", sql("""
, pi AS (SELECT family, AVG(sales) FILTER (WHERE onpromotion > 0) AS promoted,
                AVG(sales) FILTER (WHERE onpromotion = 0) AS not_promoted FROM train GROUP BY family),
top AS (SELECT family FROM train GROUP BY family ORDER BY AVG(sales) DESC, family LIMIT 10)
SELECT family, status, ROUND(avg_sales, 6) AS avg_sales FROM (
  SELECT family, 'promoted' AS status, promoted AS avg_sales FROM pi
  UNION ALL SELECT family, 'not_promoted', not_promoted FROM pi) u
WHERE family IN (SELECT family FROM top)"""))
def eda_promo_impact(src):
    """Mean sales with / without promotion per family, unpivoted, top-10 families only."""
    t = src.train_rows()
    pi = t.groupBy("family").agg(
        F.avg(F.when(F.col("onpromotion") > 0, F.col("sales"))).alias("promoted"),
        F.avg(F.when(F.col("onpromotion") == 0, F.col("sales"))).alias("not_promoted"))
    long = pi.unpivot(["family"], ["promoted", "not_promoted"], "status", "avg_sales")
    top = (t.groupBy("family").agg(F.avg("sales").alias("m"))
            .orderBy(F.col("m").desc(), "family").limit(10).select("family"))
    return long.join(top, "family", "left_semi")


@register("eda_zero_by_family", sql("""
SELECT family, ROUND(AVG(CAST(sales = 0 AS DOUBLE)) * 100, 6) AS zero_pct FROM train GROUP BY family"""))
def eda_zero_by_family(src):
    return src.train_rows().groupBy("family").agg(
        (F.avg((F.col("sales") == 0).cast("double")) * 100).alias("zero_pct"))


@register("eda_oil_series", sql("SELECT date, ROUND(dcoilwtico, 6) AS dcoilwtico FROM oil WHERE dcoilwtico IS NOT NULL"))
def eda_oil_series(src):
    """Raw oil rows with a value."""
    return src.oil.filter(F.col("dcoilwtico").isNotNull())


@register("eda_oil_corr", sql("""
, sm AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, SUM(sales) AS sales FROM train GROUP BY 1),
om AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, AVG(dcoilwtico) AS oil FROM oil GROUP BY 1),
j AS (SELECT sm.month, sm.sales, om.oil FROM sm JOIN om USING (month) WHERE om.oil IS NOT NULL AND sm.sales IS NOT NULL)
SELECT COUNT(*) AS n_months, ROUND(corr(sales, oil), 6) AS corr, ROUND(regr_slope(sales, oil), 6) AS slope,
  ROUND(regr_intercept(sales, oil), 6) AS intercept FROM j"""))
def eda_oil_corr(src):
    """Monthly total sales ⋈ monthly mean oil: Pearson r and the OLS line."""
    sm = src.train_rows().groupBy(F.trunc("date", "month").alias("month")).agg(F.sum("sales").alias("sales"))
    om = src.oil.groupBy(F.trunc("date", "month").alias("month")).agg(F.avg("dcoilwtico").alias("oil"))
    j = sm.join(om, "month").dropna(subset=["sales", "oil"])
    return j.agg(F.count(F.lit(1)).alias("n_months"), F.corr("sales", "oil").alias("corr"),
                 F.regr_slope("sales", "oil").alias("slope"),
                 F.regr_intercept("sales", "oil").alias("intercept"))


@register("eda_monthly_tx", sql("""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(SUM(transactions) AS BIGINT) AS transactions
FROM transactions GROUP BY 1"""))
def eda_monthly_tx(src):
    return src.transactions.groupBy(F.trunc("date", "month").alias("month")).agg(
        F.sum("transactions").alias("transactions"))


@register("eda_holiday_effect", sql("""
SELECT t.date IN (SELECT date FROM holidays WHERE locale = 'National') AS is_holiday,
  ROUND(AVG(t.sales), 6) AS sales, COUNT(*) AS n FROM train t GROUP BY 1"""))
def eda_holiday_effect(src):
    """Mean sales on national holiday dates (transferred included) vs other days."""
    nat = src.holidays.filter(F.col("locale") == "National").select("date").distinct() \
        .withColumn("_h", F.lit(True))
    t = src.train_rows().join(nat, "date", "left")
    return t.groupBy(F.coalesce("_h", F.lit(False)).alias("is_holiday")).agg(
        F.avg("sales").alias("sales"), F.count(F.lit(1)).alias("n"))


@register("eda_holiday_types", sql("SELECT type, COUNT(*) AS count FROM holidays GROUP BY type"))
def eda_holiday_types(src):
    return src.holidays.groupBy("type").agg(F.count(F.lit(1)).alias("count"))


@register("eda_holidays_by_month", sql("""
SELECT CAST(month(date) AS INTEGER) AS month, COUNT(*) AS count FROM holidays WHERE locale = 'National' GROUP BY 1"""))
def eda_holidays_by_month(src):
    return src.holidays.filter(F.col("locale") == "National").groupBy(
        F.month("date").alias("month")).agg(F.count(F.lit(1)).alias("count"))


NUMERIC = ["sales", "onpromotion", "dcoilwtico", "transactions"]


@register("eda_null_counts", sql("""
SELECT COUNT(*) AS n_rows, """ + ", ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in
    ["sales", "onpromotion", "city", "state", "store_type", "cluster", "dcoilwtico", "transactions"]) + """
FROM panel p LEFT JOIN stores s USING (store_nbr) LEFT JOIN oil_file_filled o USING (date)
LEFT JOIN transactions x USING (store_nbr, date)"""))
def eda_null_counts(src):
    """Rows and nulls per column of the merged panel."""
    from shelfcast.plans.panelplan import merged_panel
    m = merged_panel(src)
    cols = ["sales", "onpromotion", "city", "state", "store_type", "cluster", "dcoilwtico", "transactions"]
    return m.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def _describe_sql() -> str:
    parts = []
    for c in NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({x}), 4) AS mean,
  ROUND(STDDEV_SAMP({x}), 4) AS std, ROUND(MIN({x}), 4) AS min, ROUND(quantile_cont({x}, 0.25), 4) AS p25,
  ROUND(quantile_cont({x}, 0.5), 4) AS p50, ROUND(quantile_cont({x}, 0.75), 4) AS p75, ROUND(MAX({x}), 4) AS max FROM m""")
    return """
, m AS (SELECT t.sales, t.onpromotion, o.dcoilwtico, x.transactions FROM train t
        LEFT JOIN oil_file_filled o USING (date) LEFT JOIN transactions x USING (store_nbr, date))
""" + " UNION ALL ".join(parts)


@register("eda_describe", sql(_describe_sql()))
def eda_describe(src):
    """count / mean / std / min / quartiles / max of the numeric columns (long format)."""
    from shelfcast.plans.panelplan import oil_file_filled
    t = (src.train_rows().join(oil_file_filled(src), "date", "left")
         .join(src.transactions, ["store_nbr", "date"], "left"))
    long = t.select(*[F.col(c).cast("double") for c in NUMERIC]).unpivot([], NUMERIC, "column_name", "x")
    x = F.col("x")
    moments = long.groupBy("column_name").agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), std_samp("x").alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"))
    q = quantiles(long, "x", [0.25, 0.5, 0.75], ["column_name"]).withColumnsRenamed(
        {"q0": "p25", "q1": "p50", "q2": "p75"})
    out = moments.join(q, "column_name", "left")
    # sums of non-integer prices depend on the addition order in the last
    # bits; 4 decimals is the precision the report is compared at
    stats_cols = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select("column_name", "count", *[F.round(c, 4).alias(c) for c in stats_cols])


@register("eda_sales_histogram", sql(f"""
, mm AS (SELECT MIN(sales) AS lo, MAX(sales) AS hi FROM train),
b AS (SELECT CAST(LEAST(FLOOR((t.sales - mm.lo) / NULLIF(mm.hi - mm.lo, 0) * {HIST_BINS}), {HIST_BINS - 1}) AS INTEGER) AS bin,
        mm.lo, mm.hi FROM train t, mm)
SELECT bin, ROUND(ANY_VALUE(lo) + bin * (ANY_VALUE(hi) - ANY_VALUE(lo)) / {HIST_BINS}, 6) AS bin_start,
  COUNT(*) AS n FROM b GROUP BY bin"""))
def eda_sales_histogram(src):
    """Equal-width histogram of sales (50 bins between min and max)."""
    t = src.train_rows()
    lo = t.select(F.min("sales")).scalar()
    hi = t.select(F.max("sales")).scalar()
    width = F.try_divide(hi - lo, F.lit(float(HIST_BINS)))
    b = F.least(F.floor(F.try_divide(F.col("sales") - lo, hi - lo) * HIST_BINS),
                F.lit(HIST_BINS - 1)).cast("int")
    g = t.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("bin", (lo + F.col("bin") * width).alias("bin_start"), "n")


@register("eda_filtered", sql(TS + f"""
SELECT store_nbr, family, date, sales, onpromotion, store_type FROM ts
WHERE year(date) IN ({', '.join(map(str, FILTER_YEARS))}) AND store_type IN ({', '.join(repr(t) for t in FILTER_TYPES)})"""))
def eda_filtered(src):
    """Report filter: selected years and store types (store semi-join)."""
    picked = src.stores.filter(F.col("store_type").isin(FILTER_TYPES)).select("store_nbr", "store_type")
    t = src.train_rows().filter(F.year("date").isin(FILTER_YEARS))
    return t.join(picked, "store_nbr").select("store_nbr", "family", "date", "sales", "onpromotion",
                                               "store_type")


SCORES_SQL = """
, f AS (SELECT store_nbr, family, date, sales, LAG(sales, 28) OVER (PARTITION BY store_nbr, family ORDER BY date) AS pred FROM panel),
v AS (SELECT f.* FROM f, bounds b WHERE f.date BETWEEN b.train_end - 15 AND b.train_end),
sc AS (SELECT family, SQRT(AVG(POW(ln(1 + GREATEST(COALESCE(pred, 0), 0)) - ln(1 + sales), 2))) AS score FROM v GROUP BY family),
bp AS (SELECT score, CAST(ROW_NUMBER() OVER (ORDER BY score, family) AS DOUBLE) AS rnk FROM sc),
seg AS (SELECT score AS s0, rnk AS r0, LEAD(score) OVER (ORDER BY score, rnk) AS s1, LEAD(rnk) OVER (ORDER BY score, rnk) AS r1 FROM bp),
q AS (SELECT SQRT(AVG(POW(ln(1 + 0.0) - ln(1 + sales), 2))) AS query_score FROM v)"""
RANK_SQL = """CASE WHEN q.query_score <= (SELECT MIN(score) FROM bp) THEN 1.0
             WHEN q.query_score >= (SELECT MAX(score) FROM bp) THEN (SELECT MAX(rnk) FROM bp)
             ELSE (SELECT r0 + (r1 - r0) * (q.query_score - s0) / NULLIF(s1 - s0, 0) FROM seg
                   WHERE s1 IS NOT NULL AND q.query_score >= s0 AND q.query_score < s1 ORDER BY s0 LIMIT 1) END"""


@register("interp_lookup", sql(SCORES_SQL + """
SELECT ROUND(q.query_score, 6) AS query_score,
  ROUND(""" + RANK_SQL + """, 6) AS rank
FROM q"""))
def interp_lookup(src):
    """Piecewise-linear score -> rank: the zero forecast's holdout RMSLE placed on
    the ranked per-family lag-28 scores (breakpoints by lead, range lookup)."""
    v = holdout_naive(src).withColumn("pred", F.coalesce(F.col("sales_lag_28"), F.lit(0.0)))
    sc = v.groupBy("family").agg(rmsle("sales", "pred").alias("score"))
    # breakpoints: one per family (a dimension), ordered by a global window
    w = Window.orderBy("score", "family")
    bp = sc.select("score", F.row_number().over(w).cast("double").alias("rnk"))
    w2 = Window.orderBy("score", "rnk")
    seg = bp.select(F.col("score").alias("s0"), F.col("rnk").alias("r0"),
                    F.lead("score").over(w2).alias("s1"), F.lead("rnk").over(w2).alias("r1"))
    q = v.agg(rmsle("sales", F.lit(0.0)).alias("query_score"))
    lo = bp.select(F.min("score")).scalar()
    hi = bp.select(F.max("score")).scalar()
    top = bp.select(F.max("rnk")).scalar()
    qs = q.select("query_score").scalar()
    # the breakpoint segment containing the query score, as a scalar subquery
    hit = F.col("s1").isNotNull() & (qs >= F.col("s0")) & (qs < F.col("s1"))
    mid = (seg.filter(hit).orderBy("s0").limit(1)
              .select(F.col("r0") + (F.col("r1") - F.col("r0")) * (qs - F.col("s0"))
                      / (F.col("s1") - F.col("s0"))).scalar())
    rank = (F.when(F.col("query_score") <= lo, F.lit(1.0))
            .when(F.col("query_score") >= hi, top)
            .otherwise(mid))
    return q.select("query_score", rank.alias("rank"))


@register("score_table", sql(SCORES_SQL + """,
own AS (SELECT CAST('zero forecast' AS VARCHAR) AS label, """ + RANK_SQL + """ AS rank, query_score AS score FROM q),
every AS (
  SELECT family AS label, CAST(ROW_NUMBER() OVER (ORDER BY score, family) AS DOUBLE) AS rank, score FROM sc
  UNION ALL SELECT label, rank, score FROM own)
SELECT label, ROUND(rank, 6) AS rank, ROUND(score, 6) AS score, ROUND(score - (SELECT score FROM own), 6) AS vs_own,
  score < (SELECT score FROM own) AS better,
  CAST(ROW_NUMBER() OVER (ORDER BY rank, label) AS INTEGER) AS place FROM every"""))
def score_table(src):
    """The reference scores with the own score appended at its interpolated
    rank, sorted again by rank; differences to the own score."""
    own = interp_lookup(src).select(F.lit("zero forecast").alias("label"), "rank", F.col("query_score").alias("score"))
    v = holdout_naive(src).withColumn("pred", F.coalesce(F.col("sales_lag_28"), F.lit(0.0)))
    sc = v.groupBy("family").agg(rmsle("sales", "pred").alias("score"))
    # one row a family: a dimension, ordered in one place
    ranked = sc.select(F.col("family").alias("label"),
                       F.row_number().over(Window.orderBy("score", "family")).cast("double").alias("rank"), "score")
    mine = own.select("score").scalar()
    return ranked.unionByName(own).select(
        "label", "rank", "score", (F.col("score") - mine).alias("vs_own"), (F.col("score") < mine).alias("better"),
        F.row_number().over(Window.orderBy("rank", "label")).alias("place"))
