"""Session helpers: building a session for tests/bench and finding the
shared folder for lineage cuts and round-trip files."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "linfold",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests / bench.

    On a cluster the session is normally supplied by the launcher and this
    simply returns it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("LINFOLD_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("LINFOLD_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LINFOLD_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Where the session names none, a local master (tests) gets a private folder;
    on a cluster, whose executors could not see one, this stops."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="linfold-ckpt-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/linfold-{tag}-{uuid.uuid4().hex}"


def stage_parquet(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as parquet under the shared folder and read it back.

    Loops that pass over the same rows many times read this compact copy
    instead of re-deriving the rows from the source each time, and a lost
    executor rereads a file rather than recomputing the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder through the cluster's file system client."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 -- best effort; the folder is scratch
        pass


def at_exit_remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder when the driver ends; for frames that are read
    lazily after their builder has returned."""
    atexit.register(remove_path, spark, path)
