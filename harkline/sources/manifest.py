"""Manifests: reading, profiling, listing media, writing."""

from __future__ import annotations

import os
import stat
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.functions.text import is_command, strip, two_fields, utt_from_path
from harkline.session import local_path, scratch_path, written
from harkline.sources.files import read_lines

# Default subset folders and file suffixes of a listing.
SUBSETS = [
    "train-clean-100",
    "train-clean-360",
    "train-other-500",
    "dev-clean",
    "dev-other",
    "test-clean",
    "test-other",
]
SUFFIXES = [".flac", ".wav"]


def parse_manifest(lines: DataFrame, value: str = "value") -> DataFrame:
    """Entries (utt, src, is_command, other columns) of manifest lines.

    Blank lines, comments and lines of one field give no entry; `src` keeps its
    inner spaces.
    """
    text = F.col("_text")
    kept = [c for c in lines.columns if c != value]
    return (
        lines.withColumn("_text", strip(F.col(value)))
        .where((text != "") & ~F.startswith(text, F.lit("#")))
        .withColumn("_parts", two_fields(text))
        .where(F.size("_parts") == 2)
        .select(F.col("_parts")[0].alias("utt"), F.col("_parts")[1].alias("src"), *kept)
        .withColumn("is_command", is_command(F.col("src")))
    )


def read_manifest(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return parse_manifest(read_lines(spark, paths))


def manifest_profile(lines: DataFrame, value: str = "value") -> DataFrame:
    """Line counts by class, with the two totals reports and splitter go by.

    `progress_total` counts everything that is neither blank nor a comment after
    stripping; `split_total` takes only `#` in the first column for a comment.
    """
    text = strip(F.col(value))
    blank, comment = text == "", F.startswith(text, F.lit("#"))
    entry = ~blank & ~comment & (F.size(two_fields(text)) == 2)
    # the splitter's blank lines hold ASCII whitespace only
    split_blank = F.rlike(F.col(value), F.lit(r"^[ \t\n\x0B\f\r]*$"))
    return lines.agg(
        F.count("*").alias("total"),
        F.count_if(blank).alias("blank"),
        F.count_if(comment).alias("comment"),
        F.count_if(~blank & ~comment & ~entry).alias("malformed"),
        F.count_if(entry).alias("entries"),
        F.count_if(~blank & ~comment).alias("progress_total"),
        F.count_if(~split_blank & ~F.startswith(F.col(value), F.lit("#"))).alias("split_total"),
    )


_LISTING = "subset string, path string, is_dir boolean, length bigint, mtime double"


def _children(folder: str) -> Iterator[tuple[str, bool, int, float]]:
    if "://" in folder:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder)
        scheme = folder.split("://")[0]
        for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            folder_like = info.type == fs.FileType.Directory
            yield f"{scheme}://{info.path}", folder_like, info.size or 0, (info.mtime_ns or 0) / 1e9
        return
    try:
        entries = os.scandir(folder)
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            folder_like = entry.is_dir(follow_symlinks=False)
            if not folder_like and entry.is_dir():
                continue  # a linked folder is not walked
            try:
                info = entry.stat()
            except FileNotFoundError:
                info = entry.stat(follow_symlinks=False)
            yield entry.path, folder_like, 0 if stat.S_ISDIR(info.st_mode) else info.st_size, info.st_mtime


#: Folders that are opened for one row of a round; those found beyond go to the next round.
OPENED = 32


def _expand(batches: Iterator[pd.DataFrame], suffixes: tuple[str, ...], opened: int) -> Iterator[pd.DataFrame]:
    """Files with one of the suffixes below folder rows, and the folders that are still to open."""
    columns = ["subset", "path", "is_dir", "length", "mtime"]
    out: list[tuple] = []
    for batch in batches:
        for row in batch.itertuples(index=False):
            todo, left = deque([row.path]), opened
            while todo and left:
                left -= 1
                for path, folder, length, mtime in _children(todo.popleft()):
                    if folder:
                        todo.append(path)
                    elif path.endswith(suffixes):
                        out.append((row.subset, path, False, length, mtime))
                    if len(out) >= 5000:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
            out += [(row.subset, path, True, 0, 0.0) for path in todo]
    yield pd.DataFrame(out, columns=columns)


def list_media(
    spark: SparkSession,
    root: str,
    subsets: list[str] | None = None,
    suffixes: list[str] | None = None,
    opened: int = OPENED,
) -> DataFrame:
    """Media files below the subset folders: (subset, utt, src, length, mtime).

    The tree is opened in rounds until no folder is left: each spreads the folders that the
    one before left over all tasks, opens up to `opened` for each and writes what it finds,
    so neither the driver nor one task holds the listing or a large subtree. Missing subsets give no
    rows; the suffix test is case-sensitive; hidden names count; linked folders are not
    opened.
    """
    ends = tuple(suffixes or SUFFIXES)
    base = local_path(root).rstrip("/")
    names = list(subsets or SUBSETS)
    seeds = {"subset": names, "path": [f"{base}/{n}" for n in names]}
    folders = spark.createDataFrame(pa.table(seeds)).selectExpr("subset", "path", "true AS is_dir", "0L AS length", "0D AS mtime")
    rounds: list[str] = []
    while True:
        rounds.append(scratch_path(spark, "listing"))
        spread = folders.repartition(spark.sparkContext.defaultParallelism, "path")
        spread.mapInPandas(lambda it: _expand(it, ends, opened), _LISTING).write.parquet(rounds[-1])
        folders = spark.read.schema(_LISTING).parquet(rounds[-1]).where("is_dir")
        if folders.isEmpty():
            break
    files = spark.read.schema(_LISTING).parquet(*rounds).where("not is_dir")
    return files.select(
        "subset",
        utt_from_path(F.col("path")).alias("utt"),
        F.col("path").alias("src"),
        "length",
        F.timestamp_micros((F.col("mtime") * 1e6).cast("bigint")).alias("mtime"),
    )


def write_manifest(listing: DataFrame, path: str) -> None:
    """`utt src` lines, one folder of files per subset."""
    listing.select("subset", F.concat_ws(" ", "utt", "src").alias("value")).write.partitionBy(
        "subset"
    ).text(path)


def write_chunks(assigned: DataFrame, path: str, source: str, written_at: str) -> None:
    """Chunk files with four header lines each; an earlier split is replaced.

    `assigned` has chunk_id, chunk_name, idx, utt, src. Lines are range partitioned
    by (chunk, index): a large chunk becomes several files in order.
    """
    # read by the header counts, the sampling of the sort and the lines
    assigned = written(assigned.select("chunk_id", "chunk_name", "idx", "utt", "src"), "chunks")
    lines = assigned.select("chunk_id", "chunk_name", "idx", F.concat_ws(" ", "utt", "src").alias("value"))
    heads = assigned.groupBy("chunk_id", "chunk_name").agg(F.count("*").alias("n"))
    header = F.array(
        F.format_string("# %s of %s", "chunk_name", F.lit(source)),
        F.lit(f"# written at {written_at}"),
        F.format_string("# entries: %d", "n"),
        F.lit(""),
    )
    headers = heads.select("chunk_id", "chunk_name", F.posexplode(header).alias("_i", "value")).select(
        "chunk_id", "chunk_name", (F.col("_i") - 4).cast("bigint").alias("idx"), "value"
    )
    (
        lines.unionByName(headers)
        .repartitionByRange("chunk_id", "idx")
        .sortWithinPartitions("chunk_id", "idx")
        .select("chunk_id", "value")
        .write.mode("overwrite")
        .partitionBy("chunk_id")
        .text(path)
    )
