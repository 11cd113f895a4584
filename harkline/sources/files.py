"""Paths: patterns, file order, line positions, bytes on any file system."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.session import local_path

log = logging.getLogger("harkline")

#: A table known on the driver is broadcast up to this size, joined by key beyond it.
BROADCAST_BYTES = 64 << 20

#: A position holds the file's rank above the line's place; both are checked.
_FILE_BITS = 40
_MOST_FILES = 1 << (63 - _FILE_BITS)


def existing(spark: SparkSession, patterns: str | Iterable[str]) -> list[str]:
    """The patterns that match something, in argument order; a warning for the others."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for pattern in [patterns] if isinstance(patterns, str) else list(patterns):
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        if path.getFileSystem(conf).globStatus(path):
            found.append(pattern)
        else:
            log.warning("%s does not exist, skipped", pattern)
    return found


def small_table(spark: SparkSession, columns: dict[str, list], size: int) -> DataFrame:
    """A driver-made table, marked for broadcast only if its known size is bounded."""
    df = spark.createDataFrame(pa.table(columns))
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def read_lines(spark: SparkSession, patterns: str | Iterable[str], name_filter: str | None = None) -> DataFrame:
    """Lines of text files as (value, source_file, pos).

    `pos` is unique and follows (argument order, file name, line): the file's rank in
    the upper bits, below it split start plus row number in the task. A line takes at
    least one byte, so a split's numbers end before the next split starts; only the
    last split of a file shares a task with others, and nothing follows it.
    """
    def reader():
        r = spark.read.option("recursiveFileLookup", "true")
        return r.option("pathGlobFilter", name_filter) if name_filter else r

    paths = existing(spark, patterns)
    if not paths:
        return spark.createDataFrame([], "value string, source_file string, pos bigint")
    lines = reader().text(paths)
    files: dict[str, int] = {}
    if len(paths) == 1:
        listed = [lines.inputFiles()]
    else:
        listed = [reader().text(p).inputFiles() for p in paths]
    for names in listed:
        for file in sorted(names):
            # the listing writes file:///a where file metadata writes file:/a
            files.setdefault(re.sub("^file:/+", "file:/", file), len(files))
    if len(files) > _MOST_FILES:
        raise ValueError(f"{len(files)} files: at most {_MOST_FILES} can be read as one log")
    size = sum(len(f) + 16 for f in files)
    ranks = small_table(spark, {"source_file": list(files), "_rank": list(files.values())}, size)
    start = F.col("_metadata.file_block_start")
    row = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    place = start + row + F.when(start > 0, 1).otherwise(0)
    too_long = F.raise_error(F.concat(F.lit("file too long for line positions: "), F.col("_metadata.file_path")))
    known = F.coalesce("_rank", F.raise_error(F.concat(F.lit("not in the listing: "), "source_file")).cast("bigint"))
    return (
        lines.select(
            "value",
            F.col("_metadata.file_path").alias("source_file"),
            F.when(place < F.lit(1 << _FILE_BITS), place).otherwise(too_long.cast("bigint")).alias("_line"),
        )
        .join(ranks, "source_file", "left")
        .select("value", "source_file", (F.shiftleft(known, _FILE_BITS) + F.col("_line")).alias("pos"))
    )


def open_file(path: str):
    """A seekable binary file: local paths directly, other schemes through Arrow."""
    path = local_path(path)
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)
