"""Session construction and lineage cutting.

Cluster jobs take the shared checkpoint folder from ``spark.checkpoint.dir``;
only when that is unset (tests, local runs) do we pick a scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every designlab job wants; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of ranks are removed once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "designlab",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the designlab defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's setting, else a local one (tests only)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: exact ranks and rows "
                               "that are read several times are checkpointed there")
        # local runs and tests only: a scratch folder on this machine
        conf_dir = tempfile.mkdtemp(prefix="designlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: rows of a table that is broadcast at most (statistics per group, buckets, cut points)
BROADCAST_ROWS = 100_000


def measured(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` computed once: a broadcast table if it has ``most`` rows at most, else a written one that
    joins by a shuffle."""
    found = df.limit(most + 1).toArrow()
    if found.num_rows <= most:
        return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))
    return cut_lineage(df)
