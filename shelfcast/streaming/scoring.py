"""Score arriving horizon files with a fitted statistical forecast.

The original scores one test file in batch. Here the same scoring (fallback
lookup -> post-process -> (id, sales)) runs on every new file of a folder:
``readStream`` of parquet horizon rows, a stateless stream-static join with
the fitted lookup tables (computed once by a batch job and broadcast only
when AQE measures them small), and a ``foreachBatch`` sink that writes each
micro-batch idempotently by batch id.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.clean import postprocess

HORIZON_SCHEMA = "id long, date date, store_nbr int, family string, onpromotion int"


def fallback_tables(train: DataFrame, as_of, recent_days: int = 90) -> dict[str, DataFrame]:
    """The four lookup levels of the fallback forecast (batch, fitted once)."""
    recent = (train.filter(F.col("sales").isNotNull() & (F.col("date") <= as_of)
                           & (F.col("date") >= F.date_sub(as_of, recent_days)))
              .withColumn("_dow", F.weekday("date")))
    return {
        "sfd": recent.groupBy("store_nbr", "family", "_dow").agg(F.avg("sales").alias("p_sfd")),
        "sf": recent.groupBy("store_nbr", "family").agg(F.avg("sales").alias("p_sf")),
        "fd": recent.groupBy("family", "_dow").agg(F.avg("sales").alias("p_fd")),
        "fm": recent.groupBy("family").agg(F.avg("sales").alias("p_fm")),
    }


def score(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(id, sales) for horizon rows (stream or batch)."""
    t = rows.withColumn("_dow", F.weekday("date"))
    t = (t.join(tables["sfd"], ["store_nbr", "family", "_dow"], "left")
          .join(tables["sf"], ["store_nbr", "family"], "left")
          .join(tables["fd"], ["family", "_dow"], "left")
          .join(tables["fm"], ["family"], "left"))
    pred = F.coalesce("p_sfd", "p_sf", "p_fd", "p_fm", F.lit(0.0))
    return t.select("id", postprocess(pred).alias("sales"))


def start_scoring(spark: SparkSession, input_dir: str, output_dir: str,
                  tables: dict[str, DataFrame], checkpoint: str,
                  trigger_once: bool = True):
    """Start the streaming query; returns the ``StreamingQuery``.

    ``checkpoint`` must be the same path in every run of this stream, on storage
    that all runs share: a restart resumes from it. (The session's checkpoint
    folder is a new one in each application, so it can't serve.)"""
    stream = spark.readStream.schema(HORIZON_SCHEMA).parquet(input_dir)
    scored = score(stream, tables)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch id: a replayed batch overwrites itself
        batch.write.mode("overwrite").parquet(os.path.join(output_dir, f"batch={batch_id}"))

    writer = scored.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()
