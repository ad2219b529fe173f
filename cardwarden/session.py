"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings, all of them valid on a live session. The joins here are planned by
# size, so they need AQE for the runtime sizes and for splitting hot keys. The "force"
# flag keeps the split even where it costs one more exchange of the (small) result.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The keys of a small batch reach the Parquet scan one by one, for its Bloom filters.
    "spark.sql.parquet.pushdown.inFilterThreshold": "256",
}


_shipped: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a live session and see that its executors know the package."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(package_archive())
        _shipped.add(context.applicationId)
    return spark


def package_archive() -> str:
    """The package as a zip file, for Spark to hand to the Python workers.

    The workbook reader and the training-data operators run in them. The file stays with
    the driver, which serves it.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(), "cardwarden")
    return shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))


def local_session(cores: int | str = "*", name: str = "cardwarden", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    partitions = str(os.cpu_count() if cores == "*" else cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir.

    Intermediate tables must outlive any executor, so a machine-local folder is used only
    when the whole session runs on one machine and names no folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = os.path.join(tempfile.gettempdir(), "cardwarden")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
