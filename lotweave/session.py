"""Session construction and durable checkpoints."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "lotweave") -> SparkSession:
    """Session for tests and local benchmarks; a cluster supplies its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # expressions here have many nodes; recording a Python call site for each costs more than the job
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # below the largest value Spark adds up the bytes of every list column after each row, 30 microseconds a row
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1))
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a session
    that runs inside one machine (tests) may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="lotweave-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so lost executors cost nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lotweave-code-"), "lotweave.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
