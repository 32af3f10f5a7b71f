"""Session helpers.

The library never invents a storage location on a cluster: lineage is cut with
``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``. Only local sessions (tests, the bench, the driver's
smoke run) get a fresh scratch folder when that setting is missing.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "lexgrid", scratch: str | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session tuned for the library: AQE on, UI off, UTC, Arrow on. A local session runs its
    tasks in the driver, so ``driver_memory`` is theirs too; without it the session's own default holds."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if driver_memory is not None:
        builder = builder.config("spark.driver.memory", driver_memory)
    if scratch is not None:
        builder = builder.config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``lexgrid`` importable in the Python workers (once per SparkContext).

    Model and tokenizer callables are pickled by reference to their module, so
    the workers need the package; ``addPyFile`` distributes a zip of it through
    Spark itself. Harmless when the package is already installed everywhere.
    """
    import shutil

    import lexgrid
    sc = spark.sparkContext
    if getattr(sc, "_lexgrid_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(lexgrid.__file__)))
    staging = tempfile.mkdtemp(prefix="lexgrid-pkg-")
    archive = shutil.make_archive(os.path.join(staging, "lexgrid"), "zip", root_dir=root,
                                  base_dir="lexgrid")
    sc.addPyFile(archive)
    sc._lexgrid_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. A local session
    without one gets a fresh scratch folder; a cluster session without one is
    an error, because a machine-local folder would not survive a lost executor.
    """
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS, S3, ...)")
    local = tempfile.mkdtemp(prefix="lexgrid-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """Base folder for tables the library writes to cut lineage or round-trip."""
    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
