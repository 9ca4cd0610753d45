"""Time-based splits with a gap: holdout and expanding-window folds.

Folds are a tiny table (one row per fold, computed from the max date by a
scalar subquery) joined to the panel with range predicates; rows are tagged
(fold, role) instead of being addressed by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP_DAYS = 16
VAL_DAYS = 16
N_SPLITS = 5


def holdout_bounds(max_date: Column, val_days: int = VAL_DAYS, gap_days: int = GAP_DAYS):
    """(train_end, val_start, val_end) of the last ``val_days`` with a gap."""
    val_start = F.date_sub(max_date, val_days - 1)
    return F.date_sub(val_start, gap_days), val_start, max_date


def tag_holdout(df: DataFrame, max_date: Column, date_col: str = "date",
                val_days: int = VAL_DAYS, gap_days: int = GAP_DAYS) -> DataFrame:
    """Add ``role`` = train / val / gap (rows after max_date are dropped)."""
    tr_end, v_start, v_end = holdout_bounds(max_date, val_days, gap_days)
    d = F.col(date_col)
    role = (F.when(d <= tr_end, F.lit("train"))
            .when((d >= v_start) & (d <= v_end), F.lit("val"))
            .otherwise(F.lit("gap")))
    return df.filter(d <= v_end).withColumn("role", role)


def fold_table(spark, max_date: Column, n_splits: int = N_SPLITS,
               val_days: int = VAL_DAYS, gap_days: int = GAP_DAYS) -> DataFrame:
    """One row per fold i: val_end = max - i*v, val_start = val_end - (v-1),
    train_end = val_start - gap. Fold 0 is the latest."""
    folds = spark.range(n_splits).select(F.col("id").cast("int").alias("fold"))
    val_end = F.date_sub(max_date, F.col("fold") * val_days)
    val_start = F.date_sub(val_end, val_days - 1)
    return folds.select("fold", F.date_sub(val_start, gap_days).alias("train_end"),
                        val_start.alias("val_start"), val_end.alias("val_end"))


def tag_folds(df: DataFrame, max_date: Column, min_date: Column, date_col: str = "date",
              n_splits: int = N_SPLITS, val_days: int = VAL_DAYS,
              gap_days: int = GAP_DAYS) -> DataFrame:
    """Rows tagged (fold, role) for every fold they belong to, by a generator.

    With dd = days from the row to max_date, a row is validation in fold
    floor(dd / v) and training in folds 0 .. floor((dd - (v-1) - gap) / v).
    Each row is expanded into at most ``n_splits`` copies (a parameter), no
    join. Folds whose training side would be empty (train_end before
    ``min_date``) are skipped, as in the original splitter.
    """
    dd = F.datediff(max_date, F.col(date_col))
    last_train_fold = F.least(F.floor((dd - (val_days - 1) - gap_days) / val_days),
                              F.lit(n_splits - 1)).cast("int")
    val_fold = F.floor(dd / val_days).cast("int")
    # last fold that still has training rows
    max_fold = F.least(F.floor((F.datediff(max_date, min_date) - (val_days - 1) - gap_days)
                               / val_days), F.lit(n_splits - 1)).cast("int")
    # fold numbers first (they use the scalar max_date), then the tag arrays
    staged = df.select("*", last_train_fold.alias("_ltf"), val_fold.alias("_vf"), dd.alias("_dd"),
                       max_fold.alias("_mf"))
    empty = F.array().cast("array<struct<fold:int,role:string>>")
    train_tags = F.when(F.col("_ltf") >= 0, F.transform(
        F.sequence(F.lit(0), F.col("_ltf")),
        lambda i: F.struct(i.alias("fold"), F.lit("train").alias("role")))).otherwise(empty)
    val_tags = F.when((F.col("_dd") >= 0) & (F.col("_vf") <= F.lit(n_splits - 1)), F.array(
        F.struct(F.col("_vf").alias("fold"), F.lit("val").alias("role")))).otherwise(empty)
    tagged = staged.select("*", F.explode(F.concat(train_tags, val_tags)).alias("_tag"))
    return (tagged.select("*", F.col("_tag.fold").alias("fold"), F.col("_tag.role").alias("role"))
                  .filter(F.col("fold") <= F.col("_mf"))
                  .drop("_tag", "_ltf", "_vf", "_dd", "_mf"))


def fold_counts(tagged: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows and date range per (fold, role)."""
    return tagged.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
        F.count_distinct(date_col).alias("n_dates"))
