"""Streams whose result is the state of one stateful operator, and reading that state back.

The operator keeps a row per key in Spark's state store (RocksDB, with changelog
checkpoints), so a batch costs what its own keys cost, and a batch that is repeated after a
failure starts from the state before it. Reports read the state of the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harkline.session import delete_folder, scratch_path
from harkline.sources.files import existing

# Settings of the streams' own sessions.
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: Gets the rows of a batch's keys as they are after it, and the batch's number.
Output = Callable[[DataFrame, int], None]


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for streams with state; the caller's settings stay as they are."""
    session = spark.newSession()
    # what the caller set counts for the stream too, the number of state partitions first
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    for name, value in _STATE_CONF.items():
        session.conf.set(name, value)
    return session


def arriving_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of files as they arrive; `_start` is where the split of a line begins."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_start"))
    )


def in_file_order(rows: DataFrame) -> DataFrame:
    """Rows of `arriving_lines`, or made of them, with `pos`: their file and place in it, in place of its columns.

    The place is the split's start plus the row's number in the split. A row takes a byte at
    least, so places of a split end before the next one starts.
    """
    others = [f for f in rows.schema.fields if f.name not in ("source_file", "_start")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["source_file string", "_place long"])
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            files, starts = batch["source_file"], np.asarray(batch["_start"], dtype=np.int64)
            same = np.asarray(pc.equal(files[1:], files[:-1])) & (starts[1:] == starts[:-1])
            first = np.concatenate(([True], ~same.astype(bool)))
            begun = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            row = np.arange(len(first)) - begun
            if now == (files[0].as_py(), starts[0]):
                row[begun == 0] += count
            now, count = (files[-1].as_py(), starts[-1]), int(row[-1]) + 1
            place = starts + row + (starts > 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), files, pa.array(place)], [*names, "source_file", "_place"]
            )

    numbered = rows.mapInArrow(run, schema)
    return numbered.select(*names, F.struct("source_file", F.col("_place").alias("place")).alias("pos"))


def start_stream(
    changes: DataFrame, checkpoint: str, interval: str | None, output: Output | None = None, mode: str = "update"
) -> StreamingQuery:
    """Start a stateful stream; `interval=None` takes what is there and ends.

    Its result is the state. `output` gets the changed rows of each batch, at least once, from
    a table of the batch: the state is complete whatever part of them it reads.
    """

    def handed_on(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        path = scratch_path(session, "changes")
        batch.write.parquet(path)
        try:
            output(session.read.schema(batch.schema).parquet(path), batch_id)
        finally:
            delete_folder(session, path)

    writer = changes.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(handed_on) if output else writer.format("noop")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def state_rows(spark: SparkSession, checkpoint: str, names: list[str]) -> DataFrame | None:
    """Key columns and `names`, the values of the state in their order; None before the first committed batch.

    An aggregate has a value for each of its buffers: two for `max_by` and `min_by` (value,
    order), one for others used here.
    """
    if not existing(spark, f"{checkpoint.rstrip('/')}/commits/*"):
        return None
    state = spark.read.format("statestore").load(checkpoint)
    fields = state.schema["value"].dataType.fields
    if len(fields) != len(names):
        raise ValueError(f"state of {checkpoint} has {len(fields)} values, not {', '.join(names)}")
    kind = ", ".join(f"`{n}`: {f.dataType.simpleString()}" for n, f in zip(names, fields))
    return state.select("key.*", F.col("value").cast(f"struct<{kind}>").alias("value")).select(
        *[F.col(f"`{f.name}`") for f in state.schema["key"].dataType.fields], "value.*"
    )
