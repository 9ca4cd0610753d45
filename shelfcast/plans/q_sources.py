"""Queries: sources, the merged panel, cleaning and splitting (inventory 1-29, 100)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import clean
from shelfcast.plans.catalog import register
from shelfcast.plans.oracle import sql
from shelfcast.plans.panelplan import merged_panel, oil_file_filled, oil_interpolated

# Event window that is masked from training (a parameter of the original run).
EVENT_START, EVENT_END = "1998-04-16", "1998-05-15"


@register("scan_sales", sql("""
SELECT (CAST((t.date - b.d0) AS BIGINT) * (SELECT MAX(store_nbr) + 1 FROM stores) + CAST(t.store_nbr AS BIGINT)) * (SELECT COUNT(*) FROM families) + f.family_code AS id,
       t.date, t.store_nbr, t.family, t.sales, t.onpromotion
FROM train t JOIN families f USING (family) CROSS JOIN bounds b"""))
def scan_sales(src):
    """Training rows of the panel with their id (sales clipped at 0 by construction)."""
    return src.with_id(src.train_rows()).select(
        "id", "date", "store_nbr", "family", "sales", "onpromotion")


@register("scan_horizon", sql("""
SELECT (CAST((p.date - b.d0) AS BIGINT) * (SELECT MAX(store_nbr) + 1 FROM stores) + CAST(p.store_nbr AS BIGINT)) * (SELECT COUNT(*) FROM families) + f.family_code AS id,
       p.date, p.store_nbr, p.family, p.onpromotion
FROM panel p JOIN families f USING (family) CROSS JOIN bounds b WHERE p.date > b.train_end"""))
def scan_horizon(src):
    """The 16 horizon days per series (no target)."""
    return src.with_id(src.horizon_rows()).select(
        "id", "date", "store_nbr", "family", "onpromotion")


@register("scan_stores", sql("SELECT * FROM stores"))
def scan_stores(src):
    return src.stores


@register("scan_transactions", sql("SELECT * FROM transactions"))
def scan_transactions(src):
    return src.transactions


@register("scan_holidays", sql("SELECT * FROM holidays"))
def scan_holidays(src):
    return src.holidays


@register("holidays_clean", sql(
    "SELECT *, COALESCE(CAST(transferred AS BOOLEAN), false) AS is_transferred FROM holidays"))
def holidays_clean(src):
    return clean.clean_holidays(src.holidays)


@register("oil_filled", sql("SELECT date, ROUND(dcoilwtico, 6) AS dcoilwtico FROM oil_file_filled"))
def oil_filled(src):
    """Oil series forward- then back-filled in date order (date grain)."""
    return oil_file_filled(src)


@register("oil_interpolated", sql("""
, k AS (
  SELECT date, dcoilwtico, ROW_NUMBER() OVER (ORDER BY date) AS rn FROM oil_cal),
nb AS (
  SELECT k.*,
    (SELECT MAX(k2.rn) FROM k k2 WHERE k2.rn <= k.rn AND k2.dcoilwtico IS NOT NULL) AS prn,
    (SELECT MIN(k2.rn) FROM k k2 WHERE k2.rn >= k.rn AND k2.dcoilwtico IS NOT NULL) AS nrn
  FROM k)
SELECT nb.date, ROUND(CASE
    WHEN nb.dcoilwtico IS NOT NULL THEN nb.dcoilwtico
    WHEN p.dcoilwtico IS NOT NULL AND n.dcoilwtico IS NOT NULL
      THEN p.dcoilwtico + (n.dcoilwtico - p.dcoilwtico) * CAST(nb.rn - nb.prn AS DOUBLE) / CAST(nb.nrn - nb.prn AS DOUBLE)
    ELSE p.dcoilwtico END, 6) AS dcoilwtico
FROM nb LEFT JOIN k p ON p.rn = nb.prn LEFT JOIN k n ON n.rn = nb.nrn"""))
def oil_interpolated_q(src):
    """Linear interpolation of the oil series on the dense calendar."""
    return oil_interpolated(src)


@register("merged_panel", sql("""
SELECT p.store_nbr, p.family, p.date, p.sales, p.onpromotion, s.city, s.state, s.store_type,
       s.cluster, ROUND(o.dcoilwtico, 6) AS dcoilwtico, t.transactions
FROM panel p LEFT JOIN stores s ON s.store_nbr = p.store_nbr
LEFT JOIN oil_file_filled o ON o.date = p.date
LEFT JOIN transactions t ON t.store_nbr = p.store_nbr AND t.date = p.date"""))
def merged_panel_q(src):
    """Panel ⟕ stores ⟕ oil ⟕ transactions (the loader's five left joins)."""
    return merged_panel(src)


@register("clean_sales", sql("""
SELECT store_nbr, family, date, CASE WHEN sales IS NOT NULL THEN GREATEST(sales, 0.0) END AS sales,
       CAST(COALESCE(onpromotion, 0) AS INTEGER) AS onpromotion FROM panel"""))
def clean_sales(src):
    return clean.clean_sales(src.panel)


@register("structural_zero_filter", sql("""
, fs AS (SELECT store_nbr, family, MIN(date) FILTER (WHERE sales > 0) AS first_sale FROM train GROUP BY 1, 2)
SELECT t.store_nbr, t.family, t.date, t.sales, t.onpromotion FROM train t JOIN fs USING (store_nbr, family)
WHERE fs.first_sale IS NULL OR t.date >= fs.first_sale"""))
def structural_zero_filter(src):
    """Training rows from each series' first sale on."""
    return clean.filter_structural_zeros(src.train_rows())


@register("structural_zero_counts", sql("""
, fs AS (SELECT store_nbr, family, MIN(date) FILTER (WHERE sales > 0) AS first_sale FROM train GROUP BY 1, 2)
SELECT t.store_nbr, t.family, MIN(fs.first_sale) AS first_sale_date, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE fs.first_sale IS NOT NULL AND t.date < fs.first_sale) AS n_removed
FROM train t JOIN fs USING (store_nbr, family) GROUP BY 1, 2"""))
def structural_zero_counts(src):
    return clean.structural_zero_counts(src.train_rows())


@register("event_exclusion", sql(f"""
SELECT store_nbr, family, date, sales, onpromotion FROM train
WHERE NOT (date BETWEEN DATE '{EVENT_START}' AND DATE '{EVENT_END}')"""))
def event_exclusion(src):
    """Training rows outside the masked event window."""
    return clean.mask_date_range(src.train_rows(), EVENT_START, EVENT_END)


@register("trailing_window", sql("""
SELECT t.store_nbr, t.family, t.date, t.sales FROM train t, bounds b
WHERE t.date >= b.train_end - 730"""))
def trailing_window(src):
    """Training rows of the last 730 days."""
    return clean.trailing_window(src.train_rows(), src.train_end).select(
        "store_nbr", "family", "date", "sales")


@register("train_horizon_split", sql("""
SELECT p.store_nbr, p.family, p.date, p.sales,
       CASE WHEN p.date <= b.train_end THEN 'train' ELSE 'horizon' END AS role
FROM panel p, bounds b WHERE p.date > b.train_end OR p.sales IS NOT NULL"""))
def train_horizon_split(src):
    """Rows tagged train (date <= train_end, target known) or horizon."""
    p = src.panel
    known = F.col("date") <= src.train_end
    return p.filter(~known | F.col("sales").isNotNull()).select(
        "store_nbr", "family", "date", "sales",
        F.when(known, F.lit("train")).otherwise(F.lit("horizon")).alias("role"))


@register("train_horizon_union", sql("""
SELECT t.store_nbr, t.family, t.date, t.sales, t.onpromotion, x.transactions
FROM train t LEFT JOIN transactions x ON x.store_nbr = t.store_nbr AND x.date = t.date
UNION ALL
SELECT p.store_nbr, p.family, p.date, CAST(NULL AS DOUBLE), p.onpromotion, CAST(NULL AS BIGINT)
FROM panel p, bounds b WHERE p.date > b.train_end"""))
def train_horizon_union(src):
    """Train rows (with transactions) ∪ horizon rows (null target and transactions)."""
    train = src.train_rows().join(src.transactions, ["store_nbr", "date"], "left")
    horizon = src.horizon_rows()
    return train.unionByName(horizon, allowMissingColumns=True).select(
        "store_nbr", "family", "date", "sales", "onpromotion", "transactions")


# ------------------------------------------------------------------- folds
FOLDS_SQL = """
, fd AS (SELECT CAST(i AS INTEGER) AS fold, b.train_end - CAST(16 * i AS INTEGER) AS val_end,
                b.train_end - CAST(16 * i AS INTEGER) - 15 AS val_start,
                b.train_end - CAST(16 * i AS INTEGER) - 31 AS tr_end
         FROM bounds b, range(0, 5) t(i)),
ok AS (SELECT fd.* FROM fd WHERE fd.tr_end >= (SELECT MIN(date) FROM train)),
tg AS (SELECT ok.fold, CASE WHEN t.date <= ok.tr_end THEN 'train' ELSE 'val' END AS role, t.date
       FROM train t JOIN ok ON t.date <= ok.tr_end OR t.date BETWEEN ok.val_start AND ok.val_end)"""


def tagged_folds(src):
    from shelfcast.operators.folds import tag_folds
    t = src.train_rows()
    return tag_folds(t, src.train_end, src.first_date)


@register("ts_folds", sql(FOLDS_SQL + "\nSELECT fold, role, date, COUNT(*) AS n_rows FROM tg GROUP BY ALL"))
def ts_folds(src):
    """Expanding-window folds with a 16-day gap: every training row tagged
    (fold, role) by a generator, counted per (fold, role, date)."""
    return tagged_folds(src).groupBy("fold", "role", "date").agg(F.count(F.lit(1)).alias("n_rows"))


@register("ts_fold_counts", sql(FOLDS_SQL + """
SELECT fold, role, COUNT(*) AS n_rows, MIN(date) AS min_date, MAX(date) AS max_date,
  COUNT(DISTINCT date) AS n_dates FROM tg GROUP BY ALL"""))
def ts_fold_counts(src):
    """Rows, first/last date and number of dates per (fold, role)."""
    from shelfcast.operators.folds import fold_counts
    return fold_counts(tagged_folds(src))
