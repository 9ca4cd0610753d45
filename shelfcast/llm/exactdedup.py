"""Exact dedup by content sort.

Sampled splitters range-partition the rows by the leading bytes of the
normalised text and its digest (``repartitionByRange``; the splitters stay a
few bytes long however long the texts are), each partition is sorted
externally, equal texts come to lie side by side, and the window compares
whole neighbouring texts: a group ends where the text differs. One row of each
group stays.

A group that holds more than a partition's fair share would make one sort
partition as large as itself. Those groups (fewer than four a partition, a
proven bound, hence a broadcast) are found by a pre-aggregated count of digests
and cut into pieces by a hash of the row's identifier. Each piece is sorted and
compared like any group; its head then enters a second, small sort in which the
heads of one text meet and their whole texts are compared again.

Defined cases: null text counts as empty; equal identifiers within a group are
ordered by the row's hash, and exactly one row is kept; a null identifier loses
against any other; an empty table gives an empty table. Further columns pass
through (``content_sort`` replaces those named like its results); names starting
with ``_xd_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import ascii_lower, partitions, table, written

PREFIX_CHARS = 24
HOT_PER_PARTITION = 4
RESULT = {"_xd_sha": "text_sha256", "_xd_keep": "keep_id", "_xd_size": "group_size", "_xd_kept": "kept"}


def _normalised(text: str):
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def hot_groups(df: DataFrame, text: str, parts: int) -> DataFrame:
    """Digests of groups above a quarter of a partition's fair share, with the
    number of pieces to cut them into. Fewer than ``4 * parts`` rows, since each
    holds more than a ``1 / (4 * parts)`` part of all rows."""
    counts = df.groupBy(F.sha2(_normalised(text), 256).alias("_xd_sha")).agg(F.count("*").alias("_xd_n"))
    fair = max(df.count() / (HOT_PER_PARTITION * parts), 64.0)
    return counts.where(F.col("_xd_n") > fair).select(
        "_xd_sha", F.ceil(F.col("_xd_n") / F.lit(fair)).cast("int").alias("_xd_pieces"))


def _runs(df: DataFrame, text: str, ident: str, keep: str, carry: list[str], heads_only: bool) -> DataFrame:
    """One sort of all rows, written: columns ``carry``, the group's digest and
    piece, the row's rank in it, the piece's best identifier and size, and the
    whole text of the heads of pieces."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    parts = partitions(df.sparkSession)
    order = F.col(ident).desc_nulls_last() if keep == "largest" else F.col(ident).asc_nulls_last()
    best = F.max if keep == "largest" else F.min
    hot = written(hot_groups(df, text, parts), "hot-groups")
    dealt = (df.withColumn("_xd_sha", F.sha2(_normalised(text), 256))
             .join(F.broadcast(hot), "_xd_sha", "left")
             .withColumn("_xd_lead", ascii_lower(F.substring(F.coalesce(F.col(text), F.lit("")), 1, PREFIX_CHARS)))
             .withColumn("_xd_piece", F.when(F.col("_xd_pieces").isNull(), F.lit(-1)).otherwise(
                 F.pmod(F.xxhash64(F.col(ident), F.lit(17)), F.col("_xd_pieces")).cast("int")))
             .drop("_xd_pieces"))
    keys = ["_xd_lead", "_xd_sha", "_xd_piece"]
    sorted_rows = dealt.repartitionByRange(parts, *keys).withColumn("_xd_text", _normalised(text))
    # the range partitioning satisfies the window's distribution: one exchange
    equal = Window.partitionBy(*keys, "_xd_text")
    runs = (sorted_rows
            .withColumn("_xd_rank", F.row_number().over(equal.orderBy(order, F.xxhash64(F.col(ident)))))
            .withColumn("_xd_id", best(ident).over(equal))
            .withColumn("_xd_n", F.count("*").over(equal)))
    if heads_only:
        runs = runs.where("_xd_rank = 1")
    head = (F.col("_xd_piece") >= 0) & (F.col("_xd_rank") == 1)
    return written(runs.select(*carry, *keys, "_xd_rank", "_xd_id", "_xd_n",
                               F.when(head, F.col("_xd_text")).alias("_xd_text")), "content-sort")


def _merged(runs: DataFrame, carry: list[str], keep: str) -> DataFrame:
    """The pieces of hot groups put together: the whole texts of their heads
    (few rows) meet in a second sort."""
    best = F.max if keep == "largest" else F.min
    order = F.col("_xd_id").desc_nulls_last() if keep == "largest" else F.col("_xd_id").asc_nulls_last()
    whole = runs.where("_xd_piece < 0").select(
        *carry, "_xd_sha", F.col("_xd_id").alias("_xd_keep"), F.col("_xd_n").alias("_xd_size"),
        (F.col("_xd_rank") == 1).alias("_xd_kept"))
    same = Window.partitionBy("_xd_lead", "_xd_sha", "_xd_text")
    merged = (runs.where("_xd_piece >= 0 and _xd_rank = 1")
              .select("_xd_lead", "_xd_sha", "_xd_text", "_xd_piece", "_xd_id", "_xd_n")
              .repartitionByRange(partitions(runs.sparkSession), "_xd_lead", "_xd_sha")
              .select("_xd_sha", "_xd_piece", best("_xd_id").over(same).alias("_xd_keep"),
                      F.sum("_xd_n").over(same).alias("_xd_size"),
                      (F.row_number().over(same.orderBy(order, "_xd_piece")) == 1).alias("_xd_first")))
    pieces = (runs.where("_xd_piece >= 0").drop("_xd_text")
              .join(merged, ["_xd_sha", "_xd_piece"])
              .select(*carry, "_xd_sha", "_xd_keep", "_xd_size",
                      (F.col("_xd_first") & (F.col("_xd_rank") == 1)).alias("_xd_kept")))
    return whole.unionByName(pieces)


def content_sort(df: DataFrame, text: str = "text", ident: str = "doc_id", keep: str = "smallest",
                 carry: list[str] | None = None) -> DataFrame:
    """Every row, columns ``carry`` (default: all) with ``text_sha256``,
    ``keep_id``, ``group_size`` and ``kept``. ``keep`` says which identifier of
    equal texts stays: ``smallest`` or ``largest``."""
    carry = [c for c in (df.columns if carry is None else carry) if c not in RESULT.values()]
    runs = _runs(df, text, ident, keep, carry, heads_only=False)
    return _merged(runs, carry, keep).withColumnsRenamed(RESULT)


def dedup(df: DataFrame, text: str = "text", ident: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with the columns of ``df``."""
    runs = _runs(df, text, ident, keep, df.columns, heads_only=True)
    return _merged(runs, df.columns, keep).where("_xd_kept").select(*df.columns)


def op6_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort(docs, keep="largest", carry=["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
