"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "quarry") -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE, Arrow).

    On a cluster the master and partition counts come from spark-submit; the
    arguments only matter for local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if (master or "").startswith("local"):  # on a cluster spark-submit sets it
        builder = builder.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """True where driver and executors are one process, so that a local folder is a shared one."""
    return master == "local" or master.startswith("local[")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark itself would use for it, in the form ``pyarrow.fs`` reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(conf).makeQualified(p).toString()
    return "file://" + full[len("file:") :] if full.startswith("file:/") and not full.startswith("file://") else full


def _checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when a local session has none (tests) a folder is created and
    registered, so that ``DataFrame.checkpoint`` and phase outputs work. On a
    cluster a missing setting is an error: a machine-local folder would lose
    what the executors write.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises
            base = None
    if not base:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one output."""
    base = _checkpoint_base(spark).rstrip("/")
    return f"{base}/quarry/{name}-{uuid.uuid4().hex[:12]}"


def _filesystem(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def discard(spark: SparkSession, path: str) -> None:
    """Removes an output of this library that another, complete one has replaced."""
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return _checkpoint_base(spark)


def materialize(df, name: str = "phase"):
    """Phase boundary: write ``df`` as Parquet into a fresh folder of the
    shared checkpoint folder and continue from the written table.

    Later branches that read the phase output (counts, joins, unions) no
    longer recompute it, and a lost executor only costs the work after the
    boundary. Unlike ``RDD.checkpoint`` (which computes an unpersisted
    input twice) the plan runs once; the folder is shared storage, never a
    machine-local one.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._folder = path  # for ``release``
    return out


def release(*tables, sweep: bool = True) -> None:
    """Removes the folders of ``materialize`` outputs that no later step reads.

    For tables whose readers have all been written; frames that are not such an
    output themselves are left alone. With ``sweep`` the driver also lets go of
    what it no longer refers to, so that Spark clears those shuffle files.
    """
    spark = None
    for df in tables:
        path = getattr(df, "_folder", None)
        if path:
            spark = df.sparkSession
            discard(spark, path)
    if spark is not None and sweep:
        spark.sparkContext._jvm.System.gc()
