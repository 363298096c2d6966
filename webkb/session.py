"""Session helpers: local session for tests/bench, shared scratch folders.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by
the cluster); only when it is unset and the master is local do we make one
under /tmp, as tests do.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DIR: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "webkb") -> SparkSession:
    """Session for tests and the bench: UI off, AQE on, UTC, Arrow on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Python steps (HTML, PDF) are CPU-bound: keep small shuffles spread
        # over the cores instead of coalescing them into one or two tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.driver.memory", "8g")
        # checkpoint files of BFS levels and conversions are removed once
        # their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir``; when unset on a local master (tests),
    makes one under /tmp and sets it. On a cluster an unset value is an error:
    a machine-local folder would not survive an executor loss.
    """
    global _LOCAL_DIR
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        base = conf_dir
    else:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="webkb-", dir="/tmp")
        base = _LOCAL_DIR
        spark.conf.set("spark.checkpoint.dir", base)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(base, "rdd-checkpoints"))
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def checkpoint(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (never localCheckpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df, name: str):
    """``df`` written to the shared folder once and read from there by column,
    with the path: for wide rows that several steps read in part."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete_path(spark: SparkSession, path: str, encoded: bool = False) -> None:
    """Remove a folder or file that nothing reads any more; ``encoded``: the
    path is a percent-encoded URI, as Spark's file metadata gives it."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI with the scheme of the file system that Spark reads it by."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
