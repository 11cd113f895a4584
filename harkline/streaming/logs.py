"""Streams over result logs: progress, merge, resume state, rates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harkline.operators.progress import progress_partials, progress_totals
from harkline.sources.results import RECORD, parse_results
from harkline.streaming.state import Output, arriving_lines, in_file_order, start_stream, state_rows, stream_session

_PROGRESS = ["utt", "idx", "status", "processing_time", "audio_duration"]
#: Values of the state of `progress_partials`, by aggregate.
_PROGRESS_STATE = ["lines", "any_ok", "last_failed", "_last", "last_pos", "processing_time", "audio_duration"]


def _records(spark: SparkSession, log_path: str, columns: list[str] | None, kept: list[str], max_files: int) -> DataFrame:
    """Records of a log as they arrive: `kept`, and `pos`, which orders them by file and line."""
    lines = arriving_lines(spark, log_path, max_files)
    return in_file_order(parse_results(lines, columns=columns).select(*kept, "source_file", "_start"))


def stream_progress(
    spark: SparkSession,
    log_path: str,
    checkpoint: str,
    key: str = "utt",
    interval: str | None = "5 seconds",
    output: Output | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Keep the progress of each key of a growing log as state.

    The last line of a key is the one of the last file by name, however files arrive: the
    state is what the whole log gives when it is read at once.
    """
    log = _records(stream_session(spark), log_path, _PROGRESS, _PROGRESS, max_files)
    return start_stream(progress_partials(log, key), checkpoint, interval, output)


def progress_view(spark: SparkSession, checkpoint: str, key: str = "utt") -> DataFrame:
    """The row that `progress_stats` gives for the log read so far."""
    per_key = state_rows(spark, checkpoint, _PROGRESS_STATE)
    if per_key is None:
        shape = f"{key} string, lines long, any_ok boolean, last_failed boolean, last_pos long, processing_time double, audio_duration double"
        per_key = spark.createDataFrame([], shape)
    sums = {n: F.coalesce(n, F.lit(0.0)) for n in ("processing_time", "audio_duration")}
    return progress_totals(per_key.withColumns(sums), key)


# --- merge

_MERGED = [*RECORD, "raw"]


def stream_merge(
    spark: SparkSession,
    log_path: str,
    checkpoint: str,
    key: str = "utt",
    interval: str | None = "5 seconds",
    output: Output | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Keep the records of each key that a merge may choose as state: the first ok one and the last one.

    A batch changes the state of its own keys only. `output` gets their rows (`key`, `first_ok`,
    `last`), which `chosen_records` turns into records, for a table that is kept elsewhere.
    """
    log = _records(stream_session(spark), log_path, None, _MERGED, max_files).where(F.col(key).isNotNull())
    record = F.struct(*[c for c in _MERGED if c != key])
    ok_pos = F.when(F.col("status") == "ok", F.col("pos"))
    best = log.groupBy(key).agg(F.min_by(record, ok_pos).alias("first_ok"), F.max_by(record, "pos").alias("last"))
    return start_stream(best, checkpoint, interval, output)


def chosen_records(best: DataFrame, key: str = "utt", prefer_success: bool = True) -> DataFrame:
    """The record to keep of each key, from rows (`key`, `first_ok`, `last`)."""
    chosen = F.coalesce("first_ok", "last") if prefer_success else F.col("last")
    return best.select(key, chosen.alias("_r")).select(key, "_r.*").select(*_MERGED)


def merged_view(spark: SparkSession, checkpoint: str, key: str = "utt", prefer_success: bool = True) -> DataFrame:
    """The rows that `merge_results` gives for the log read so far, without their positions."""
    best = state_rows(spark, checkpoint, ["first_ok", "_first", "last", "_last"])
    if best is None:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in {**RECORD, "raw": "string"}.items()))
    return chosen_records(best, key, prefer_success)


# --- resume state

_RESUME = ["utt", "idx", "status", "retry_attempt"]
#: Keys a task folds before it sends them on.
_FOLDED = 100_000
#: What orders the rows of a key that `_folded` gives.
_PART = ["source_file", "_start", "_turn"]


def _folded(rows: DataFrame, key: str, kind: str) -> DataFrame:
    """Lines of a task folded by key and split: ever ok, the counter that was set last, plain failures after it.

    Lines of a split stand in their order, so a key with most of the lines is a row per split
    and turn (the times a task sends on what it has).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded: dict = {}
        turn = 0

        def told() -> pa.RecordBatch:
            nonlocal turn
            columns = [list(x) for x in zip(*[(*k, turn, *v) for k, v in folded.items()])]
            folded.clear()
            turn += 1
            types = [keys.type, pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        names = [key, *_PART, "ok", "counter", "plain"]
        for batch in batches:
            keys = batch[key]
            fields = [batch[n].to_pylist() for n in (key, "source_file", "_start", "status", "retry_attempt")]
            for k, file, start, status, attempt in zip(*fields):
                if status not in ("ok", "fail"):
                    continue
                entry = folded.setdefault((k, file, start), [False, None, 0])
                if status == "ok":
                    entry[:] = True, 0, 0
                elif attempt is not None:
                    entry[1:] = attempt, 0
                else:
                    entry[2] += 1
            if len(folded) > _FOLDED:
                yield told()
        if folded:
            yield told()

    return rows.mapInArrow(run, f"{key} {kind}, source_file string, _start long, _turn long, ok boolean, counter long, plain long")


def stream_resume(
    spark: SparkSession, log_path: str, checkpoint: str, key: str = "utt", interval: str | None = None, max_files: int = 1000
) -> StreamingQuery:
    """Keep what the resume state of each key of a growing log is made of: see `resume_view`.

    Lines of a key that stand in one split of a file are a row of state, so a batch costs what
    its own lines cost, and no Python runs for each key. Files count in the order of their
    names, however they arrive: the files of a run follow those of the run before it.
    """
    kind = RECORD[key]
    lines = arriving_lines(stream_session(spark), log_path, max_files)
    rows = parse_results(lines, columns=_RESUME).select(key, "source_file", "_start", "status", "retry_attempt")
    # a group is one row: a file is in one batch, a split in one task
    changes = _folded(rows, key, kind).groupBy(key, *_PART).agg(
        F.max("ok").alias("ok"), F.max("counter").alias("counter"), F.max("plain").alias("plain")
    )
    return start_stream(changes, checkpoint, interval)


def resume_view(spark: SparkSession, checkpoint: str, key: str = "utt") -> DataFrame:
    """The rows that `resume_state` gives for the log read so far: key, `done`, `retry`."""
    rows = state_rows(spark, checkpoint, ["ok", "counter", "plain"])
    if rows is None:
        return spark.createDataFrame([], f"{key} {RECORD[key]}, done boolean, retry long")
    part = F.struct(*_PART)
    sets = F.when(F.col("counter").isNotNull(), part)
    # the counter that was set last, and the plain failures of its row and of those after it
    last = rows.withColumn("_last", F.max(sets).over(Window.partitionBy(key)))
    counted = F.col("_last").isNull() | (part >= F.col("_last"))
    return last.groupBy(key).agg(
        F.max("ok").alias("done"),
        (
            F.coalesce(F.max_by("counter", sets), F.lit(0)) + F.coalesce(F.sum(F.when(counted, F.col("plain"))), F.lit(0))
        ).cast("bigint").alias("retry"),
    )


# --- rates


def _windows(lines: DataFrame, at: str, window: str) -> DataFrame:
    return lines.groupBy(F.window(at, window).alias("window")).agg(F.count("*").alias("lines"))


def stream_recent_rate(
    spark: SparkSession,
    lines: DataFrame,
    checkpoint: str,
    at: str = "ts",
    window: str = "5 seconds",
    interval: str | None = "5 seconds",
    output: Output | None = None,
) -> StreamingQuery:
    """Keep the line count of each time window of a stream with a time column, without watermark.

    A window is one row of state, so the state grows with time and not with lines, and a
    line counts however late it comes. Lines without time count in no window.
    """
    return start_stream(_windows(lines, at, window), checkpoint, interval, output)


def rate_view(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Count and lines per second of every window."""
    counts = state_rows(spark, checkpoint, ["lines"])
    if counts is None:
        counts = spark.createDataFrame([], "window struct<start: timestamp, end: timestamp>, lines long")
    seconds = F.unix_micros(F.col("window_end")) - F.unix_micros(F.col("window_start"))
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "lines"
    ).withColumn("recent_per_sec", F.col("lines") * 1e6 / seconds)


def stream_closed_rate(
    spark: SparkSession,
    lines: DataFrame,
    table: str,
    checkpoint: str,
    at: str = "ts",
    window: str = "5 seconds",
    delay: str = "1 minute",
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Append the count of a window to a table once, when the watermark has passed it.

    A line more than `delay` behind the newest one may come after its window was closed: it
    is not in this table, and `late_lines` counts it.
    """
    counts = _windows(lines.withWatermark(at, delay), at, window)
    closed = counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "lines")
    writer = closed.writeStream.outputMode("append").format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def late_lines(spark: SparkSession, table: str, checkpoint: str) -> DataFrame:
    """Lines that came after their window was closed, by window; none is lost.

    `table` is that of `stream_closed_rate`, `checkpoint` that of `stream_recent_rate` over
    the same lines.
    """
    closed = spark.read.schema("window_start timestamp, window_end timestamp, lines long").parquet(table)
    closed = closed.select("window_start", F.col("lines").alias("on_time"))
    met = rate_view(spark, checkpoint).join(closed, "window_start")
    return met.select("window_start", "window_end", "lines", "on_time", (F.col("lines") - F.col("on_time")).alias("late")).where("late > 0")
