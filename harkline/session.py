"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package is written for.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # payload and request columns are large: bound a batch by bytes, not only by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # a speculative copy of an annotation task would call the model again
    "spark.speculation": "false",
}


def build_session(app: str = "harkline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the tasks, once a session, so that it need not be installed there."""
    if spark.conf.get("harkline.shipped", None):
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="harkline-"), "harkline"), "zip", os.path.dirname(folder), os.path.basename(folder)
    )
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("harkline.shipped", "true")


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="harkline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _app_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/harkline/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder name below the scratch root that no other call gets."""
    return f"{_app_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on any file system; nothing happens if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the scratch folder."""
    delete_folder(spark, _app_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet in the scratch folder and read it back.

    Cuts the lineage at a point that must not be evaluated twice (a sampled range
    partitioning, a model call); survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """`file:/a`, `file:///a` or `/a` as a plain path; other schemes unchanged."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path
