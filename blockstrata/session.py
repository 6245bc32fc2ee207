"""Session settings for jobs and the cut of long lineages."""

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores="*", partitions=8, app="blockstrata"):
    """Session for tests and benchmarks on one machine."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
               .config("spark.sql.shuffle.partitions", str(partitions)))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark):
    """Send this package to the workers, once per application.

    Only needed where it is not installed there. The archive is a file of the
    driver that Spark itself hands to every executor, late ones too.
    """
    context = spark.sparkContext
    if getattr(context, "_blockstrata_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="blockstrata-"), "blockstrata.zip")
    with open(path, "wb") as out:
        out.write(held.getvalue())
    context.addPyFile(path)
    context._blockstrata_shipped = True


def shared_folder(spark):
    """Folder for intermediate tables: the session's ``spark.checkpoint.dir``.
    A folder of this machine is made only in local mode without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="blockstrata-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df):
    """Write an intermediate table to the shared folder and read it back.

    The table outlives lost executors, starts a new plan, and gives the next
    steps columns to prune and sizes to plan with.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
