"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, opened by Spark's reader only (the path may be remote)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does just that to a text of
    ASCII only, and much faster than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def few(df: DataFrame, per_core: int) -> DataFrame:
    """``df`` in at most so many partitions a core, without a shuffle: for tables
    of which a shuffle partition would hold next to nothing, and writing a file
    of it would cost more than its rows."""
    return df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)


def written(df: DataFrame, name: str, per_core: int | None = None, compression: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, reread.
    ``per_core``: see ``few``. ``compression``: other than the session's.

    Cuts the lineage: what follows reads files every executor sees, so a lost
    executor costs its running tasks only. The folder is the cluster's
    checkpoint folder and is cleaned with it.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    if per_core:
        df = few(df, per_core)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(schema).parquet(path)


@functools.cache
def _package() -> str:
    """This package as a zip file, as ``--py-files`` would take it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcast-py-"), "shelfcast.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow``, after Spark has sent this package to the workers (once
    an application)."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        sc.addPyFile(_package())
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(run, schema)


HOT_KEYS = 1024


def join_one(rows: DataFrame, one: DataFrame, key: str, total: int, freq: str = "freq") -> DataFrame:
    """``rows`` joined with ``one``, which has a row a key and in ``freq`` the number
    of its rows. Rows of frequent keys stay where they are: fewer than ``HOT_KEYS``
    keys can hold more than that share of the ``total`` rows each, so those keys are
    broadcast, and only the rows of others are dealt by the key."""
    hot = F.col(freq) * F.lit(HOT_KEYS) > F.lit(total)
    often = F.broadcast(one.where(hot))
    rest = rows.join(F.broadcast(one.where(hot).select(key)), key, "left_anti")
    return rows.join(often, key).unionByName(rest.join(one.where(~hot), key))


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of the session makes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: pa.Array, most_bytes: int = 4 << 20, most_rows: int = 4096):
    """Cut a column of texts into runs ``(from, to)`` of at most ``most_bytes``
    (one text at least), so that the work arrays of a task stay bounded."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > most_bytes or i - start >= most_rows):
            yield start, i
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield start, len(sizes)
