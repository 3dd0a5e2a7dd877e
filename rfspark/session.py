"""Session settings the engine relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str = "*", app: str = "rfspark", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Packet rows hold up to megabytes of payload: a Python batch of 10 000 would not fit.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        .config("spark.driver.memory", os.environ.get("RFSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``.

    Only a session without that setting (a test) gets a local one, created once
    and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut(df, purpose: str):
    """Write a table to the shared folder and read it back.

    For a result that several later passes read: each pass then scans only its
    own columns, and a lost executor costs a re-read, not the work before it.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, once.

    The zip is handed to Spark, which distributes it; a cluster that has the
    package installed needs no such call.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "rfspark")
    path = shutil.make_archive(base, "zip", os.path.dirname(here), os.path.basename(here))
    spark.sparkContext.addPyFile(path)
    # The worker that prepares a stateful query runs beside the driver and takes
    # no such files, only the path of its environment.
    paths = [os.path.dirname(here), spark.sparkContext.environment.get("PYTHONPATH")]
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)
    _shipped.add(app)
