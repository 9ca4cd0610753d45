"""Error metrics as aggregate expressions (RMSLE, F1, ROC AUC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage


def squared_log_error(y: Column | str, p: Column | str) -> Column:
    """(log1p(max(p, 0)) - log1p(y))^2; only the prediction is clipped."""
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    return F.pow(F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(y), F.lit(2.0))


def rmsle(y: Column | str, p: Column | str) -> Column:
    """Root mean squared log error as an aggregate expression."""
    return F.sqrt(F.avg(squared_log_error(y, p)))


def rmsle_by(df: DataFrame, y: str, p: str, by: list[str]) -> DataFrame:
    """RMSLE and row count per group (one aggregation, partial on the map side)."""
    return df.groupBy(*by).agg(rmsle(y, p).alias("rmsle"), F.count(F.lit(1)).alias("n"))


def range_buckets(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` cut into ranges of the columns ``order``, whose bounds Spark samples
    from the rows: ``_bucket`` numbers them upwards. The ranges hold about equally
    many rows however the values are spread. The table is checkpointed, so every
    reader sees the same bounds."""
    return cut_lineage(df.repartitionByRange(*order).withColumn("_bucket", F.spark_partition_id()))


def counts_before(per_value: DataFrame, value: str, count: str, by: list[str] = ()) -> DataFrame:
    """Adds ``before``: how many rows of the group have a smaller value.

    ``per_value`` has one row per group and value. The rows are cut into ranges
    by sampled bounds; each range is a window of its own, and only the totals of
    the ranges are added up in one place, so no task sees all values.
    """
    by = list(by)
    placed = range_buckets(per_value if by else per_value.withColumn("_g", F.lit(0)), [*by, value])
    by = by or ["_g"]
    order = Window.partitionBy(*by).orderBy("_bucket")
    totals = placed.groupBy(*by, "_bucket").agg(F.sum(count).alias("_sum")).select(
        *by, "_bucket", (F.sum("_sum").over(order) - F.col("_sum")).alias("_offset"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(totals, [*by, "_bucket"]).withColumn(
        "before", F.col("_offset") + F.coalesce(F.sum(count).over(inside), F.lit(0))).drop("_offset", "_bucket")
    return out.drop("_g")


def quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row a group and columns
    ``q0``, ``q1``, ... in the order of ``probs``. Values are first counted
    (partial aggregation), so what moves is one row per distinct value."""
    by = list(by)
    per_value = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    ranked = counts_before(per_value, "_v", "_n", by)
    size = ranked.groupBy(*by).agg(F.sum("_n").alias("_all"))
    ranked = ranked.join(size, by) if by else ranked.withColumn("_all", size.select("_all").scalar())

    def at(rank):
        hit = (F.col("before") <= rank) & (rank < F.col("before") + F.col("_n"))
        return F.max(F.when(hit, F.col("_v")))

    cols = []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("_all") - 1)
        cols += [at(F.floor(place)).alias(f"_a{i}"), at(F.ceil(place)).alias(f"_b{i}"),
                 F.max(place - F.floor(place)).alias(f"_f{i}")]
    out = ranked.groupBy(*by).agg(*cols)
    return out.select(*by, *[(F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}")).alias(f"q{i}")
                             for i in range(len(probs))])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC by the rank-sum (Mann-Whitney) formula with tied ranks
    averaged. The rows are first reduced to one per distinct score; ranks come
    from ``counts_before``."""
    per_score = df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(label) == 1).alias("_pos"))
    ranked = counts_before(per_score, "_s", "_n").withColumn("_avg_rank", F.col("before") + (F.col("_n") + 1) / 2.0)
    return ranked.agg(
        F.sum("_pos").alias("n_pos"),
        (F.sum("_n") - F.sum("_pos")).alias("n_neg"),
        F.sum(F.col("_pos") * F.col("_avg_rank")).alias("_rank_sum"),
    ).select(
        "n_pos", "n_neg",
        F.try_divide(F.col("_rank_sum") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0,
                     (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("auc"))
