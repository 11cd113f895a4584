"""Packed shards: index, shard files, byte slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harkline.operators.ordering import global_index
from harkline.sources.files import BROADCAST_BYTES, existing, open_file

# Columns of the shard index file and the names used here.
INDEX_COLUMNS = {
    "bin_index": "bin_index",
    "start_byte_offset": "start",
    "file_size_bytes": "size",
    "sample_rate": "sr",
    "channels": "ch",
}
OPTIONAL = {"sample_rate", "channels"}
INDEX_FILE = "metadata.parquet"
SHARD_PATTERN = "arkive_*.bin"

#: Payload bytes and items one slicing task reads at most.
TASK_BYTES = 1 << 30
TASK_ITEMS = 20_000
_YIELD_BYTES = 32 << 20
#: Ranges of a shard are read together across gaps of up to so many bytes, and up to so many bytes.
READ_GAP = 64 << 10
READ_BYTES = 8 << 20

_SOURCE, _ZONES = "_source", "_zones"


def shard_index_rows(raw: DataFrame) -> DataFrame:
    """The five index columns as long; null or missing optional columns are -1."""
    missing = [c for c in INDEX_COLUMNS if c not in raw.columns and c not in OPTIONAL]
    if missing:
        raise ValueError(f"shard index lacks {', '.join(missing)}")

    def column(name: str):
        if name not in raw.columns:
            return F.lit(-1).cast("bigint")
        value = F.col(name).cast("bigint")
        return F.coalesce(value, F.lit(-1)) if name in OPTIONAL else value

    others = [c for c in raw.columns if c not in INDEX_COLUMNS]
    return raw.select(*[column(c).alias(n) for c, n in INDEX_COLUMNS.items()], *others)


def sorted_index(index: DataFrame) -> DataFrame:
    return index.orderBy("bin_index", "start")


def read_shard_index(spark: SparkSession, path: str, stored: str | None = None) -> DataFrame:
    """Index rows with their dense position `idx` in (shard, offset) order.

    Rows of equal offset keep the order they have in the file. `stored` names a folder for
    the numbered index: it is built there once, see `store_shard_index`, and read from there
    afterwards. `stored_range` and `stored_items` read the part of it they need.
    """
    if stored:
        store_shard_index(spark, path, stored)
        return spark.read.parquet(stored)
    return _numbered(spark, path)


def _source_files(spark: SparkSession, path: str) -> DataFrame:
    """The index files of a shard folder with their lengths and times."""
    listing = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{INDEX_FILE}")
    return listing.select("path", "length", F.unix_micros("modificationTime").alias("time"))


def store_shard_index(spark: SparkSession, path: str, stored: str) -> None:
    """Build the numbered index in `stored`, unless the one there was made of the index files as they are now.

    Each of its files holds a stretch of positions; beside them stand the stretch of each file
    and, written last, the source files that it was made of. A build that was broken off has
    no such list and is made again, as is the index of a shard folder that has changed since.
    """
    stored = stored.rstrip("/")
    now = sorted(map(tuple, _source_files(spark, path).collect()))  # an index has few files
    if existing(spark, f"{stored}/{_SOURCE}/_SUCCESS"):
        if sorted(map(tuple, spark.read.parquet(f"{stored}/{_SOURCE}").collect())) == now:
            return
    # the tasks of a scan hold files from anywhere: ranges once more, so that a file is one stretch
    ranges = _numbered(spark, path).repartitionByRange("idx").sortWithinPartitions("idx")
    ranges.write.mode("overwrite").parquet(stored)
    zones = spark.read.parquet(stored).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("idx").alias("first"), F.max("idx").alias("last")
    )
    zones.coalesce(1).write.mode("overwrite").parquet(f"{stored}/{_ZONES}")
    spark.createDataFrame(now, "path string, length long, time long").coalesce(1).write.mode("overwrite").parquet(f"{stored}/{_SOURCE}")


def _stored_files(spark: SparkSession, stored: str, files: list[str]) -> DataFrame:
    """Rows of some files of a stored index."""
    whole = spark.read.parquet(stored)
    return spark.read.schema(whole.schema).parquet(*files) if files else whole.where("false")


def stored_range(spark: SparkSession, stored: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows of a stored index with start <= idx < end, from the files whose stretch meets the range."""
    zones = spark.read.parquet(f"{stored.rstrip('/')}/{_ZONES}").where(F.col("last") >= start)
    if end is not None:
        zones = zones.where(F.col("first") < end)
    files = [r.file for r in zones.orderBy("first").collect()]
    rows = _stored_files(spark, stored, files).where(F.col("idx") >= start)
    return rows if end is None else rows.where(F.col("idx") < end)


def stored_items(spark: SparkSession, stored: str, ids: DataFrame, idx: str = "idx") -> DataFrame:
    """Rows of a stored index at the positions `ids`, from the files whose stretch holds one.

    The stretches (a row for each file) travel to the tasks that hold the ids, which tell
    the files they need.
    """
    zones = sorted(map(tuple, spark.read.parquet(f"{stored.rstrip('/')}/{_ZONES}").select("first", "last", "file").collect()))
    first, last = (np.array([z[k] for z in zones], dtype=np.int64) for k in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.zeros(len(first), dtype=bool)
        for batch in batches:
            at = np.asarray(batch["wanted"], dtype=np.int64)
            zone = np.searchsorted(first, at, side="right") - 1
            needed[zone[(zone >= 0) & (at <= last[zone])]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(needed))], ["zone"])

    wanted = ids.select(F.col(idx).cast("long").alias("wanted")).where("wanted is not null")
    found = wanted.mapInArrow(run, "zone long").distinct().collect()
    rows = _stored_files(spark, stored, [zones[r.zone][2] for r in sorted(found)])
    return rows.join(wanted.distinct(), F.col("idx") == F.col("wanted"), "left_semi")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.parquet(f"{path.rstrip('/')}/{INDEX_FILE}")
    present = [c for c in INDEX_COLUMNS if c in raw.columns]
    rows = shard_index_rows(
        raw.select(*present, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    )
    return global_index(rows, ["bin_index", "start", "_file", "_row"]).select(
        "idx", *INDEX_COLUMNS.values()
    )


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """Shard files (bin_index, path, length) numbered by sorted name."""
    if not existing(spark, f"{path.rstrip('/')}/{SHARD_PATTERN}"):
        raise FileNotFoundError(f"no {SHARD_PATTERN} in {path}")
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", SHARD_PATTERN)
        .load(path)
        .select("path", "length")
    )
    # one row per shard file: a listing, not data
    number = F.row_number().over(Window.orderBy("path")) - 1
    numbered = listing.select(number.cast("bigint").alias("bin_index"), "path", "length")
    size = sum(len(f) + 32 for f in listing.inputFiles())
    return F.broadcast(numbered) if size <= BROADCAST_BYTES else numbered


def shard_path_join(index: DataFrame, files: DataFrame) -> DataFrame:
    """Index rows with the path of their shard; null where no such shard exists.

    `shard_files` marks a listing of bounded size for broadcast; a larger one is
    joined by shard number, which the range partitioning after it spreads again.
    """
    return index.join(files.select("bin_index", "path"), "bin_index", "left")


def _joined(wanted: list[tuple], gap: int, most: int) -> Iterator[tuple[int, int, bool]]:
    """Stretches [begin, end) of rows that are read together, and whether their ranges are whole numbers of bytes.

    Rows are (path, shard, start, size). A range alone may be longer than `most`.
    """
    def valid(row: tuple) -> bool:
        path, shard, start, size = row
        return None not in row and shard >= 0 and start >= 0 and size >= 0

    begin = 0
    while begin < len(wanted):
        end = begin + 1
        if not valid(wanted[begin]):
            yield begin, end, False
            begin = end
            continue
        path, _, start, size = wanted[begin]
        until = start + size
        while end < len(wanted) and valid(wanted[end]) and wanted[end][0] == path and wanted[end][2] >= wanted[end - 1][2]:
            further = max(until, wanted[end][2] + wanted[end][3])
            if wanted[end][2] > until + gap or further - start > most:
                break
            until, end = further, end + 1
        yield begin, end, True
        begin = end


def _slices(batches: Iterator[pa.RecordBatch], open_shard: Callable = open_file) -> Iterator[pa.RecordBatch]:
    """Bytes of sorted ranges: neighbours in one read, each range cut out of what was read.

    Columns stay Arrow arrays, so that a null range fails its own row only; so does a range
    that can't be read, which is then tried alone.
    """
    handle, opened = None, None

    def read(path: str, start: int, size: int) -> bytes:
        nonlocal handle, opened
        if opened != path:
            if handle is not None:
                handle.close()
            handle, opened = None, None
            handle, opened = open_shard(path), path
        handle.seek(start)
        return handle.read(size)

    def alone(path, shard, start, size) -> tuple[bytes | None, str | None]:
        if path is None or shard is None or shard < 0:
            return None, f"no shard {shard}"
        if start is None or size is None or start < 0 or size < 0:
            return None, f"bad range {start}+{size}"
        try:
            return read(path, start, size), None
        except Exception as problem:
            return None, str(problem)

    def together(rows: list[tuple]) -> list[tuple[bytes | None, str | None]]:
        base = rows[0][2]
        try:
            block = memoryview(read(rows[0][0], base, max(start + size for _, _, start, size in rows) - base))
        except Exception:
            return [alone(*row) for row in rows]
        return [(bytes(block[start - base:start - base + size]), None) for _, _, start, size in rows]

    try:
        for batch in batches:
            wanted = list(zip(*(batch[n].to_pylist() for n in ("path", "bin_index", "start", "size"))))
            done, contents, errors, held = 0, [], [], 0
            for begin, end, whole in _joined(wanted, READ_GAP, READ_BYTES):
                rows = wanted[begin:end]
                for content, error in together(rows) if whole and len(rows) > 1 else map(alone, *zip(*rows)):
                    contents.append(content)
                    errors.append(error)
                    held += len(content or b"")
                if held >= _YIELD_BYTES or end == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(done, end - done).columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())],
                        [*batch.schema.names, "content", "error"],
                    )
                    done, contents, errors, held = end, [], [], 0
    finally:
        if handle is not None:
            handle.close()


def slice_shards(index: DataFrame, files: DataFrame, task_bytes: int = TASK_BYTES, task_items: int = TASK_ITEMS) -> DataFrame:
    """Bytes of every index row: + content, compressed_size, error.

    Rows are range partitioned by (shard, offset): a task reads one stretch of a
    shard in order, and a shard of any size is shared by many tasks. The number of
    tasks follows payload bytes and items, which the row sizes say nothing about.
    """
    spark = index.sparkSession
    items, total = index.agg(F.count("*"), F.coalesce(F.sum(F.greatest("size", F.lit(0))), F.lit(0))).head()
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes), -(-items // task_items))
    placed = (
        shard_path_join(index, files)
        .repartitionByRange(tasks, "bin_index", "start")
        .sortWithinPartitions("bin_index", "start")
    )
    schema = T.StructType(
        placed.schema.fields
        + [T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())]
    )
    return placed.mapInArrow(_slices, schema).withColumn("compressed_size", F.octet_length("content"))


def lookup_items(index: DataFrame, files: DataFrame, ids: DataFrame, idx: str = "idx") -> DataFrame:
    """Bytes and index fields of a set of positions; `stored_items` gives those of a stored index."""
    wanted = index.join(ids.select(idx).distinct(), idx, "left_semi")
    return slice_shards(wanted, files)
