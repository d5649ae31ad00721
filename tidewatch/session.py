"""Session construction and lineage cutting.

On a cluster the session is handed to us; we only fill in settings that are
unset. ``spark.checkpoint.dir`` must point at shared storage there: we read it
from the session and only invent a scratch folder when it is unset (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewatch", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one (tests / bench)."""
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Where the setting is absent, a local master gets a scratch folder (tests, bench); any
    other master raises, as its executors would not see a folder of the driver's machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        d = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint dir and read it back."""
    path = os.path.join(checkpoint_dir(df.sparkSession), "tables", name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_scratch: list[str] = []


def scratch_table(df: DataFrame, name: str, declared: Callable[[StructType], StructType] = lambda schema: schema) -> DataFrame:
    """Write ``df`` under a new name in the checkpoint folder and read it back (lineage ends there), with the schema
    that ``declared`` makes of its own."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _scratch.append(path)
    return spark.read.schema(declared(df.schema)).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has written; call it when no result that reads them is needed
    any more. Returns how many there were."""
    jvm = spark.sparkContext._jvm
    n = len(_scratch)
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n
