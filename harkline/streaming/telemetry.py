"""Telemetry as it arrives: metrics of snapshots kept as state, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harkline.operators.telemetry import COUNTS, METRICS, parse_gpu, parse_metrics, telemetry_alerts
from harkline.streaming.state import Output, arriving_lines, in_file_order, start_stream, state_rows, stream_session

#: Values of the state of `parse_metrics`, by aggregate: each metric with its line's position.
_STATE = [n for metric in METRICS.values() for n in (metric, f"_{metric}")] + ["bad_lines"]
#: Folder and number in a file's name: the server and the snapshot it is of.
_NAME = r"/([^/]*)/[^/0-9]*([0-9]{1,18})[^/]*$"


def snapshot_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of metric files as they arrive: `server`, `snapshot_id`, `line` and `pos`.

    A file is of the server its folder is named after and of the snapshot whose number is in
    its own name; a snapshot may have several files. Files without a number are left out.
    """
    lines = in_file_order(arriving_lines(stream_session(spark), path, max_files)).where(F.rlike("pos.source_file", F.lit(_NAME)))
    server, number = (F.regexp_extract("pos.source_file", _NAME, k) for k in (1, 2))
    return lines.select(F.url_decode(server).alias("server"), number.cast("bigint").alias("snapshot_id"), F.col("value").alias("line"), "pos")


def stream_metrics(lines: DataFrame, checkpoint: str, interval: str | None = "5 seconds", output: Output | None = None) -> StreamingQuery:
    """Keep the metrics of each snapshot of each server as state; lines of one may come in several batches.

    `lines` are those of `snapshot_lines`, or any stream with these columns. `output` gets the
    snapshots that a batch changed, parsed as `parse_metrics` does.
    """
    keyed = lines.select(F.struct("server", "snapshot_id").alias("_of"), "line", "pos")
    parsed = parse_metrics(keyed, "_of").select("_of.*", *METRICS.values(), "bad_lines")
    return start_stream(parsed, checkpoint, interval, output)


def metrics_view(spark: SparkSession, checkpoint: str, closed: bool = False) -> DataFrame:
    """`server`, `snapshot_id` and what `parse_metrics` gives for the lines so far.

    `closed` leaves out the last snapshot of each server, which may still grow.
    """
    state = state_rows(spark, checkpoint, _STATE)
    if state is None:
        shape = ", ".join(f"{n} {'bigint' if n in COUNTS else 'double'}" for n in METRICS.values())
        return spark.createDataFrame([], f"server string, snapshot_id bigint, {shape}, bad_lines bigint")
    values = [F.col(n).try_cast("bigint").alias(n) if n in COUNTS else F.col(n) for n in METRICS.values()]
    rows = state.select("_of.*", *values, "bad_lines")
    if not closed:
        return rows
    # one row per server: combines before its shuffle
    newest = rows.groupBy(F.col("server").alias("_server")).agg(F.max("snapshot_id").alias("_newest"))
    joined = rows.join(newest, F.col("server").eqNullSafe(F.col("_server")))
    return joined.where("snapshot_id < _newest").drop("_server", "_newest")


def alerts_view(spark: SparkSession, checkpoint: str, closed: bool = True) -> DataFrame:
    """Queue alerts (`server`, `source`, `snapshot`, `alert`, `value`) of the snapshots so far."""
    return telemetry_alerts(metrics_view(spark, checkpoint, closed), keep=["server"])


def stream_gpu_alerts(
    spark: SparkSession, path: str, table: str, checkpoint: str, interval: str | None = "5 seconds", max_files: int = 1000
) -> StreamingQuery:
    """Append the alerts of GPU lines to a table, each once: `source_file`, `source`, `snapshot` (place), `alert`, `value`.

    A line is a reading of its own, so there is no state; the table's log of files keeps a
    repeated batch from adding anything.
    """
    lines = in_file_order(arriving_lines(spark, path, max_files))
    gpus = parse_gpu(lines.select(F.col("value").alias("line"), "pos.source_file", F.col("pos.place").alias("pos")))
    alerts = telemetry_alerts(gpus=gpus, keep=["source_file"])
    writer = alerts.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
