"""Session helpers: sane defaults for local runs and a shared checkpoint folder."""

from __future__ import annotations

import atexit
import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "colloquy", driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session. On a cluster pass master=None and let the
    launcher decide; shuffle partitions default to 2x cores locally."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    cores = os.cpu_count() or 8
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.sql.shuffle.partitions",
                  str(shuffle_partitions or 2 * cores)))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``). Only a ``local`` master may run without one
    (tests, local runs): it gets a private scratch folder. On any other
    master an unset folder raises, since executors do not see the driver's
    disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()  # below spark.checkpoint.dir where that is set
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    require_local(sc.master)
    local = tempfile.mkdtemp(prefix="colloquy-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def require_local(master: str) -> None:
    """Raise unless ``master`` runs its executors inside the driver."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir is not set and the master is {master!r}: "
                         "name a folder that all executors share")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the checkpoint folder. It is deleted
    when the driver's Python ends normally."""
    sc = spark.sparkContext
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/colloquy-{sc.applicationId}"
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(_delete_folder, sc, root)
    return root


_SCRATCH: set[str] = set()


def _delete_folder(sc, path: str) -> None:
    if sc._jsc is None:  # the session was stopped before
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    (``spark.checkpoint.dir``) and return a DataFrame reading it back.

    The rows are computed once and written by the same job; the lineage of
    the result is just the scan. (``Dataset.checkpoint`` would compute the
    plan a second time to write its files unless it were cached first.) The
    folder is the cluster's reliable storage, so the table survives executor
    loss, unlike a local checkpoint."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/cut-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # unnamed, the schema would be read by a job of its own
    out._cut_path = path
    return out


def compiled_only(spark: SparkSession) -> None:
    """Let Spark leave whole-stage code whose methods HotSpot never compiles
    (above 8000 bytes of code): long column expressions, split into small
    methods, then run compiled. A limit that was set before stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, "8000")


def small_batches(spark: SparkSession) -> None:
    """Let Spark send rows to Python and back in batches of some MB. By default
    a batch is 10,000 rows of up to 64 MB together, which the executor and its
    worker hold several times outside the heap. A limit that was set before stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).lower() in ("67108864b", "67108864", "64m", "64mb"):
        spark.conf.set(name, "4m")


def discard(df: DataFrame) -> None:
    """Delete the table behind a ``cut_lineage`` result that no later result
    reads any more."""
    _delete_folder(df.sparkSession.sparkContext, df._cut_path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted now. Spark's cleaner does
    it when the driver's JVM has collected what refers to them, which a driver
    with little to do puts off (``spark.cleaner.periodicGC.interval``)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
