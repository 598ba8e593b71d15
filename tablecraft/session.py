"""Session helpers.

Library functions never build a session themselves; they take ``spark`` or a
``DataFrame``.  ``local_session`` exists for tests, the bench and notebooks.
Scratch output (round-trip writes, saved results) goes under the shared folder
named by ``spark.checkpoint.dir`` so that it survives the loss of an executor
and is visible to every node of a cluster.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tablecraft") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder
        .master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TABLECRAFT_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Hour, day and epoch conversions follow the session zone; pin it to UTC."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ...) before running jobs that write scratch tables")
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the configured checkpoint folder; set one only where none is set.

    A fallback folder is only chosen for local-mode sessions (tests, the
    bench); on a cluster an unset ``spark.checkpoint.dir`` is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)")
        root = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "tablecraft-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tablecraft`` importable in Python workers (what ``--py-files`` does).

    Analyses with a Python step send functions that import ``tablecraft`` on
    the executors.  The package's source is zipped once per application and
    handed to Spark with ``addPyFile``: the driver serves it to every executor
    and to any that replaces a lost one, whatever store the data is in.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import tempfile
    import zipfile
    from pathlib import Path

    pkg = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tablecraft-")) / "tablecraft-src.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for f in sorted(pkg.rglob("*.py")):
            zf.write(f, f.relative_to(pkg.parent).as_posix())
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tablecraft/{name}-{uuid.uuid4().hex[:12]}"
