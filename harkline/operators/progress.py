"""Progress of a run, read from its result log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harkline.functions.text import error_label, error_type, eta_label, percent, with_duration


def _not_ok() -> Column:
    return ~F.coalesce(F.col("status") == "ok", F.lit(False))


def progress_partials(log: DataFrame, key: str = "utt", pos: str = "pos") -> DataFrame:
    """Per key: lines, ever ok, outcome of the last line, time and duration sums."""
    spent = F.col("processing_time")
    return log.groupBy(key).agg(
        F.count("*").alias("lines"),
        F.max(~_not_ok()).alias("any_ok"),
        F.max_by(_not_ok(), F.col(pos)).alias("last_failed"),
        F.max(pos).alias("last_pos"),
        F.coalesce(F.sum(F.when(spent > 0, spent)), F.lit(0.0)).alias("processing_time"),
        F.coalesce(F.sum(with_duration(F.col("audio_duration"))), F.lit(0.0)).alias("audio_duration"),
    )


def progress_totals(partials: DataFrame, key: str = "utt", order: str | Column = "last_pos") -> DataFrame:
    """One row over `progress_partials`. A key can be successful and failed at once."""
    keyed = F.col(key).isNotNull()
    return partials.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).cast("bigint").alias("total_lines"),
        F.count_if(keyed).alias("unique_keys"),
        F.count_if(keyed & F.col("any_ok")).alias("successful"),
        F.count_if(keyed & F.col("last_failed")).alias("failed"),
        F.coalesce(F.sum(F.when(~keyed, F.col("lines"))), F.lit(0)).cast("bigint").alias("null_key_lines"),
        F.coalesce(F.sum("processing_time"), F.lit(0.0)).alias("total_processing_time"),
        F.coalesce(F.sum("audio_duration"), F.lit(0.0)).alias("total_audio_duration"),
        F.max_by(key, order).alias("last_key"),
        F.max_by(F.when(F.col("last_failed"), "not ok").otherwise("ok"), order).alias("last_outcome"),
    )


def progress_stats(log: DataFrame, key: str = "utt", pos: str = "pos") -> DataFrame:
    """One row of counters and sums over the whole log."""
    return progress_totals(progress_partials(log, key, pos), key)


def progress_report(
    stats: DataFrame, expected: int | Column | None = None, file_span_seconds: float | Column | None = None
) -> DataFrame:
    """Percentages, rates, time left and the 960 h forecast over `progress_stats`.

    `expected` may be a scalar subquery; null or zero leaves the progress columns
    null. `file_span_seconds` is last change minus creation of the log files.
    """
    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    total = F.nullif(column(expected).cast("bigint"), F.lit(0))
    span = column(file_span_seconds).cast("double")
    some_time = (F.col("total_lines") > 0) & (F.col("total_processing_time") > 0)
    out = stats.select(
        "*",
        percent(F.col("successful"), F.col("unique_keys")).alias("successful_pct"),
        percent(F.col("failed"), F.col("unique_keys")).alias("failed_pct"),
        total.alias("expected"),
        F.when(some_time, F.col("total_processing_time") / F.col("total_lines")).alias("avg_seconds"),
        F.when((F.col("total_audio_duration") > 0) & (span > 0), F.col("total_audio_duration") / span).alias(
            "rtf_file_span"
        ),
    )
    rate = F.lit(1.0) / F.col("avg_seconds")
    remaining = F.col("expected") - F.col("successful")
    eta = remaining / rate
    return out.select(
        "*",
        (100.0 * F.col("successful") / F.col("expected")).alias("progress_pct"),
        remaining.alias("remaining"),
        rate.alias("samples_per_sec"),
        (rate * 3600).alias("samples_per_hour"),
        eta.alias("eta_seconds"),
        eta_label(eta).alias("eta_label"),
        (F.lit(960.0) / F.col("rtf_file_span")).alias("gpu_hours_960h"),
    )


def retry_distribution(log: DataFrame) -> DataFrame:
    """Lines and share per attempt number; a line without one is a first attempt."""
    counted = log.groupBy(
        F.coalesce(F.col("retry_attempt"), F.lit(1)).cast("bigint").alias("retry_attempt")
    ).agg(F.count("*").alias("lines"))
    lines = counted.agg(F.sum("lines")).scalar()
    return counted.withColumn("pct", percent(F.col("lines"), lines)).orderBy("retry_attempt")


def error_histogram(log: DataFrame, pos: str = "pos") -> DataFrame:
    """Lines per error type over all lines that are not ok."""
    return (
        log.where(_not_ok())
        .groupBy(error_type(F.col("error")).alias("error_type"))
        .agg(F.count("*").alias("lines"), F.min(pos).alias("first_pos"))
    )


def top_errors(log: DataFrame, n: int = 5, pos: str = "pos") -> DataFrame:
    """The `n` most frequent error types, ties as first seen, and how many are left out."""
    kinds = error_histogram(log, pos)
    others = F.greatest(kinds.agg(F.count("*")).scalar() - n, F.lit(0))
    return (
        kinds.orderBy(F.desc("lines"), "first_pos")
        .limit(n)
        .select("error_type", error_label(F.col("error_type")).alias("label"), "lines", others.alias("others"))
    )


def last_processed(log: DataFrame, key: str = "utt", pos: str = "pos") -> DataFrame:
    return log.agg(
        F.max_by(key, pos).alias("last_key"), F.max_by("status", pos).alias("last_status")
    )


def recent_rate(
    snapshots: DataFrame, source: str, at: str = "mtime", lines: str = "total_lines"
) -> DataFrame:
    """Lines per second between successive snapshots of the same log.

    `at` is in seconds. The rate is null where lines or time did not grow.
    """
    by_time = Window.partitionBy(source).orderBy(at)
    d_lines = F.col(lines) - F.lag(lines).over(by_time)
    d_time = F.col(at) - F.lag(at).over(by_time)
    rate = F.when((d_time > 0) & (d_lines > 0), d_lines / d_time)
    return snapshots.select(
        "*", rate.alias("recent_per_sec"), (rate * 3600).alias("recent_per_hour")
    )
