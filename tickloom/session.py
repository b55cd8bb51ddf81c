"""SparkSession with the settings every job here relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that hold on a cluster as well as on a laptop.  Shuffle width is left
# to the cluster: adaptive execution coalesces a generous width, so only local
# runs lower it.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # See operators/stacking.py.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

# For jobs over texts: a batch is as large as its texts are long, so what a task holds of it is bounded by bytes where Spark
# counts rows (Arrow batches for Python workers), and by fewer rows where it can't (vectors of the Parquet reader).
TEXT_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def bound_text_batches(spark: SparkSession) -> None:
    """Sets ``TEXT_BATCHES`` in the session, but for what its user has set."""
    for key, value in TEXT_BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application: Python operators need it there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "tickloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, top))
    context.addPyFile(archive)


def build_session(app: str = "tickloom", master: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**COMMON, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def local_session(cores: int | str = "*", extra: dict | None = None) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    width = str(cores) if str(cores).isdigit() else "8"
    local = {
        "spark.sql.shuffle.partitions": width,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **(extra or {}),
    }
    spark = build_session(master=f"local[{cores}]", extra=local)
    spark.sparkContext.setLogLevel("ERROR")
    return spark
