"""Session helpers: the settings every job relies on, and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs depend on for correct results (dates are day grain and
# time-zone free) or for their planned physical shape (AQE re-plans joins and
# coalesces the shuffle partitions of the many small grain tables).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "shelfcast",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests, one machine) may go without: it gets a private
    folder. On a cluster a folder of the driver's own disk would be lost to the
    executors, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used before iterative work (model fits, grid searches) so that a lost
    executor recomputes from the checkpoint, not from the raw scans.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` after Spark has sent this package to the workers (once
    an application), as ``--py-files`` would."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="shelfcast-py-"), "shelfcast.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in (n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(run, schema)


def input_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and modification times of the files under ``path``, listed
    by Spark's file system layer (no job, any store Spark can read)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    listing = root.getFileSystem(conf).listFiles(root, True)
    found = []
    while listing.hasNext():
        f = listing.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


_SESSION_TABLES: dict = {}


def session_table(spark: SparkSession, key: tuple, path: str, build):
    """A checkpointed intermediate table shared by the queries of one session.

    ``build`` returns the (already checkpointed) value; it runs once per
    application, key and state of the files under ``path``, like writing a
    temporary table that later queries of the same job read. When the inputs
    change the table is built anew and the former one is let go.
    """
    k = (spark.sparkContext.applicationId, path) + tuple(key)
    state = input_state(spark, path)
    held = _SESSION_TABLES.get(k)
    if held is None or held[0] != state:
        _SESSION_TABLES.pop(k, None)
        held = _SESSION_TABLES[k] = (state, build())
    return held[1]
