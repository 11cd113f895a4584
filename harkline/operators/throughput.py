"""Throughput, real-time factors and GPU-hour forecasts.

Three real-time factors are kept apart: `rtf_wall` divides audio by elapsed wall
time, `rtf_latency` by the sum of request times, `rtf_file_span` (progress report)
by the age of the log file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harkline.functions.text import percent, with_duration
from harkline.operators.merge import ok_filter
from harkline.operators.ordering import BLOCK, line_index, position_block, running_totals

# Bounds below which no statistics or forecasts are given.
MIN_ELAPSED = 0.1
MIN_SAMPLES = 10
MIN_SAMPLES_PER_HOUR = 0.1
CORPUS_HOURS = 960

# Default forecast targets (name, hours of audio).
TARGET_NAMES = ["LibriSpeech-960h", "100h", "500h", "1000h", "5000h"]
TARGET_HOURS = [960, 100, 500, 1000, 5000]


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def throughput_stats(
    log: DataFrame,
    elapsed: float | None = None,
    ts: str = "ts",
    weight: str | None = None,
) -> DataFrame:
    """One row over the ok lines; rates are null for less than 0.1 s.

    `elapsed` in seconds, or the span of the time column over the whole log.
    `weight` names the column a sampled duration counts with.
    """
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    duration = F.when(ok, with_duration(F.col("audio_duration")))
    weighted = duration * F.coalesce(F.col(weight), F.lit(1.0)) if weight else duration
    seconds = (
        F.lit(float(elapsed))
        if elapsed is not None
        else (F.max(F.unix_micros(F.col(ts).cast("timestamp"))) - F.min(F.unix_micros(F.col(ts).cast("timestamp")))) / 1e6
    )
    totals = log.agg(
        seconds.alias("elapsed_seconds"),
        F.count_if(ok).alias("processed"),
        F.count_if(duration.isNotNull()).alias("samples_with_duration"),
        F.count_if(ok & duration.isNull()).alias("samples_without_duration"),
        _sum(F.when(ok, F.col("processing_time"))).alias("total_processing_time"),
        _sum(weighted).alias("_audio"),
    )
    measured = F.col("elapsed_seconds") >= MIN_ELAPSED
    rate = F.when(measured, F.col("processed") / F.col("elapsed_seconds"))
    return totals.select(
        "elapsed_seconds",
        "processed",
        rate.alias("samples_per_sec"),
        (rate * 3600).alias("samples_per_hour"),
        F.when(measured & (F.col("_audio") > 0), F.col("_audio") / F.col("elapsed_seconds")).alias("rtf_wall"),
        "samples_with_duration",
        "samples_without_duration",
        percent(F.col("samples_with_duration"), F.col("processed")).alias("with_duration_pct"),
        "total_processing_time",
        (F.col("_audio") / 3600).alias("audio_hours"),
    )


def duration_error_hist(log: DataFrame) -> DataFrame:
    """Ok lines without duration by the reason given, most frequent first."""
    missing = with_duration(F.col("audio_duration")).isNull()
    reason = F.col("audio_duration_error")
    return (
        ok_filter(log)
        .where(missing & reason.isNotNull() & (reason != ""))
        .groupBy("audio_duration_error")
        .agg(F.count("*").alias("samples"))
        .orderBy(F.desc("samples"), "audio_duration_error")
    )


def gpu_hours_estimate(stats: DataFrame, total_samples: int | Column) -> DataFrame:
    """Hours for a number of samples and for 960 h of audio, over `throughput_stats`."""
    total = total_samples if isinstance(total_samples, Column) else F.lit(total_samples)
    enough = (F.col("processed") >= MIN_SAMPLES) & (F.col("samples_per_hour") >= MIN_SAMPLES_PER_HOUR)
    return stats.select(
        total.cast("bigint").alias("total_samples"),
        F.when(enough, total / F.col("samples_per_hour")).alias("gpu_hours_total"),
        F.when(enough, F.lit(float(CORPUS_HOURS)) / F.col("rtf_wall")).alias("gpu_hours_960h"),
    )


def run_metrics(log: DataFrame, weight: str | None = None) -> DataFrame:
    """One row over the ok lines; no row where nothing was measured.

    With `weight`, `rtf_latency_weighted` also counts sampled durations in full.
    """
    duration = with_duration(F.col("audio_duration"))
    weighted = duration * F.coalesce(F.col(weight), F.lit(1.0)) if weight else duration
    spent = F.col("total_processing_time")
    out = (
        ok_filter(log)
        .agg(
            F.count("*").alias("successful"),
            _sum(F.col("processing_time")).alias("total_processing_time"),
            _sum(duration).alias("total_audio_duration"),
            _sum(weighted).alias("_weighted"),
        )
        .where((F.col("successful") > 0) & (spent != 0))
    )
    columns = [
        "successful",
        "total_processing_time",
        "total_audio_duration",
        F.when(F.col("total_audio_duration") > 0, F.col("total_audio_duration") / spent).alias("rtf_latency"),
        (spent / F.col("successful")).alias("avg_processing_time"),
    ]
    if weight:
        columns.append(F.when(F.col("_weighted") > 0, F.col("_weighted") / spent).alias("rtf_latency_weighted"))
    return out.select(*columns)


def throughput_rate(metrics: DataFrame) -> DataFrame:
    """Sample rates over `run_metrics`."""
    per_hour = F.lit(3600.0) / F.col("avg_processing_time")
    return metrics.select(
        (F.lit(1.0) / F.col("avg_processing_time")).alias("samples_per_sec"),
        per_hour.alias("samples_per_hour"),
        (per_hour * 24).alias("samples_per_gpu_day"),
    )


def forecast_datasets(
    metrics: DataFrame, names: list[str] | None = None, hours: list[float] | None = None
) -> DataFrame:
    """GPU hours per target over `run_metrics`; the shorter of the two lists wins."""
    targets = zip(names or TARGET_NAMES, hours or TARGET_HOURS)
    rows = [F.struct(F.lit(n).alias("name"), F.lit(float(h)).alias("hours")) for n, h in targets]
    return (
        metrics.where("rtf_latency > 0")
        .select("rtf_latency", F.posexplode(F.array(*rows)).alias("pos", "target"))
        .select(
            "pos",
            "target.name",
            F.col("target.hours").alias("audio_hours"),
            (F.col("target.hours") / F.col("rtf_latency")).alias("gpu_hours"),
        )
    )


def sample_weighted(
    log: DataFrame, share: float, key: str = "utt", duration: str = "audio_duration", seed: int = 0
) -> DataFrame:
    """Keep the duration of a repeatable sample of items and weigh each by 1 / share.

    An item is in the sample if the first 32 bits of the MD5 of seed and key lie below
    the share; a rerun picks the same items. Rows outside the sample, and sampled
    rows without a duration, have weight 1.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    chosen = F.coalesce(draw < int(share * (1 << 32)), F.lit(False))
    kept = F.when(chosen, with_duration(F.col(duration)))
    return log.withColumns(
        {
            "sampled": chosen,
            duration: kept,
            "sample_weight": F.when(kept.isNotNull(), F.lit(1.0 / max(share, 1e-8))).otherwise(F.lit(1.0)),
        }
    )


def _outcomes() -> dict[str, Column]:
    ok = F.coalesce(F.col("status") == "ok", F.lit(False)).cast("bigint")
    return {"ok_so_far": ok, "fail_so_far": 1 - ok}


def running_counts(log: DataFrame, pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """Ok and failed lines up to and including every line."""
    return running_totals(log, pos, _outcomes(), block)


def checkpoint_series(
    log: DataFrame, every: int = 100, pos: str = "pos", dense: bool = False
) -> DataFrame:
    """Cumulative counters after each `every` lines.

    Lines are numbered first; `dense` promises that positions are 0, 1, 2, ... already.
    """
    if not dense:
        log, pos = line_index(log, pos, "_line"), "_line"
    duration = F.when(F.col("status") == "ok", with_duration(F.col("audio_duration")))
    counters = {**_outcomes(), "with_duration": duration.isNotNull().cast("bigint"), "audio_seconds": duration}
    buckets = (
        log.groupBy(position_block(pos, every).alias("bucket"))
        .agg(
            F.count("*").alias("lines"),
            *[_sum(c).cast("bigint" if n != "audio_seconds" else "double").alias(f"in_{n}") for n, c in counters.items()],
        )
    )
    summed = running_totals(buckets, "bucket", {n: F.col(f"in_{n}") for n in counters})
    return summed.where(F.col("lines") == every).select(
        ((F.col("bucket") + 1) * every).alias("processed"),
        *counters,
        F.when(F.col("with_duration") > 0, F.col("audio_seconds") / F.col("with_duration")).alias("avg_audio_seconds"),
    )
