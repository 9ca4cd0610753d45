"""The corpus pipeline: toxic documents go, exact and near copies go, sources
are mixed to target weights, and what remains is encoded.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet to
the cluster's shared checkpoint folder and reread as the next one's ``docs``.
All but the last return the columns of ``documents``. After the mixing stage a
document comes as often as its source's weight calls for (once at least), and the
rows of each file are in the order of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import bpe, exactdedup, mixing, neardup, toxicity
from shelfcast.llm.common import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exactdedup.dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed rows. Blocks are dealt over the files by a hash, so that each file
    has the sources at their weights; its rows lie in the order of their places in
    the block permutations. The mixer sees the columns under other names, so that
    none of its own replaces one."""
    own = {c: f"doc_{i}" for i, c in enumerate(docs.columns)}
    rows = mixing.mix(docs.withColumnsRenamed(own), own["text"], own["source"], own["doc_id"])
    return rows.sortWithinPartitions("position", own["doc_id"]).select(*[F.col(new).alias(old) for old, new in own.items()])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), offsets=False)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", encoded),
]

# trained scores and components can't be put in SQL; tests/llm compare run()
# with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
