"""Micro-batches of arriving lines with a position in the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Files of one micro-batch at most; also bounds the table of file ranks.
MAX_FILES = 1000


def stream_lines(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """Lines of files as they arrive, with what is needed to order them.

    A batch takes `max_files` files, `MAX_FILES` at most.
    """
    if max_files > MAX_FILES:
        raise ValueError(f"a batch of positions takes at most {MAX_FILES} files, not {max_files}")
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_modification_time").alias("_mtime"),
            F.col("_metadata.file_block_start").alias("_start"),
        )
    )


def batch_positions(batch: DataFrame) -> DataFrame:
    """(value, source_file, pos): order by file time, file name and line in the batch."""
    row = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    lines = batch.select("value", "source_file", (F.col("_start") + row + F.when(F.col("_start") > 0, 1).otherwise(0)).alias("_line"))
    # at most MAX_FILES rows, see stream_lines
    files = batch.groupBy("source_file").agg(F.max("_mtime").alias("_mtime"))
    ranks = files.select("source_file", F.row_number().over(Window.orderBy("_mtime", "source_file")).alias("_rank"))
    return lines.join(F.broadcast(ranks), "source_file").select(
        "value", "source_file", (F.shiftleft(F.col("_rank").cast("bigint"), 40) + F.col("_line")).alias("pos")
    )
