"""Collected server and GPU telemetry: parsing, queue shares, alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harkline.functions.text import last_field, strip

# Metric names looked for in a line, in order, with the column they fill.
METRICS = {
    "vllm:num_requests_running": "running",
    "vllm:num_requests_waiting": "waiting",
    "vllm:num_requests_swapped": "swapped",
    "vllm:gpu_cache_usage_perc": "gpu_cache_pct",
    "vllm:avg_generation_throughput_toks_per_s": "gen_throughput",
    "vllm:avg_prompt_throughput_toks_per_s": "prompt_throughput",
}
COUNTS = ["running", "waiting", "swapped"]

# Alert bounds.
QUEUE_LOW, QUEUE_HIGH = 100, 2000
GPU_UTIL_LOW, GPU_TEMP_HIGH = 50, 80


def parse_metrics(
    lines: DataFrame, snapshot: str = "snapshot_id", pos: str = "pos", line: str = "line", pick: str = "last"
) -> DataFrame:
    """One row per snapshot; the last (or first) line of a metric gives its value.

    Comments and blank lines are skipped. A value that is no number leaves its
    metric null and is counted in `bad_lines`.
    """
    if pick not in ("last", "first"):
        raise ValueError("pick is 'last' or 'first'")
    text = F.col(line)
    used = ~F.startswith(text, F.lit("#")) & (strip(text) != "")
    metric = reduce(
        lambda chain, item: chain.when(F.contains(text, F.lit(item[0])), item[1]),
        list(METRICS.items())[1:],
        F.when(F.contains(text, F.lit(next(iter(METRICS)))), METRICS[next(iter(METRICS))]),
    )
    rows = (
        lines.select(snapshot, F.col(pos).alias("_pos"), line)
        .withColumn("_last", F.when(used, last_field(text)))
        .select(
            snapshot,
            "_pos",
            F.when(F.col("_last") != "", metric).alias("_metric"),
            F.col("_last").try_cast("double").alias("_value"),
        )
    )
    by = F.max_by if pick == "last" else F.min_by
    values = []
    for name in METRICS.values():
        value = by("_value", F.when(F.col("_metric") == name, F.col("_pos")))
        values.append((value.try_cast("bigint") if name in COUNTS else value).alias(name))
    bad = F.col("_metric").isNotNull() & F.col("_value").isNull()
    return rows.groupBy(snapshot).agg(*values, F.count_if(bad).alias("bad_lines"))


def queue_shares(metrics: DataFrame) -> DataFrame:
    """Requests in the queue and the share of each state; a missing state is 0."""
    filled = metrics.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in COUNTS})
    total = F.col("total_requests")
    return filled.withColumn("total_requests", reduce(Column.__add__, [F.col(c) for c in COUNTS])).withColumns(
        {f"{c}_share": F.col(c) / F.nullif(total, F.lit(0)) for c in COUNTS}
    )


def parse_gpu(lines: DataFrame, line: str = "line") -> DataFrame:
    """`util, used, total, temp` as integers; lines of fewer than 4 fields are dropped."""
    parts = F.transform(F.split(F.col(line), ","), strip)
    names = ["util", "mem_used", "mem_total", "temp"]
    typed = lines.where(F.size(F.split(F.col(line), ",")) >= 4).withColumns(
        {n: F.get(parts, F.lit(i)).try_cast("bigint") for i, n in enumerate(names)}
    )
    return typed.withColumn("mem_pct", 100.0 * F.col("mem_used") / F.nullif("mem_total", F.lit(0)))


def _alert(condition: Column, kind: str, value: Column) -> Column:
    return F.when(condition, F.struct(F.lit(kind).alias("alert"), value.cast("bigint").alias("value")))


def _exploded(df: DataFrame, keep: list[str], source: str, ident: str, *alerts: Column) -> DataFrame:
    return df.select(
        *keep,
        F.lit(source).alias("source"),
        F.col(ident).cast("bigint").alias("snapshot"),
        F.inline(F.array_compact(F.array(*alerts))),
    )


def telemetry_alerts(
    metrics: DataFrame | None = None,
    gpus: DataFrame | None = None,
    snapshot: str = "snapshot_id",
    gpu_snapshot: str = "pos",
    keep: list[str] | None = None,
) -> DataFrame:
    """Alert rows (source, snapshot, alert, value) from parsed telemetry, with the columns `keep` before them.

    Swapped requests do not count as queued; a snapshot without any metric gives none.
    """
    parts = []
    if metrics is not None:
        seen = reduce(Column.__or__, [F.col(c).isNotNull() for c in METRICS.values()])
        queued = F.coalesce("running", F.lit(0)) + F.coalesce("waiting", F.lit(0))
        parts.append(
            _exploded(
                metrics.where(seen),
                keep or [],
                "queue",
                snapshot,
                _alert(queued < QUEUE_LOW, "queue_low", queued),
                _alert(queued > QUEUE_HIGH, "queue_high", queued),
            )
        )
    if gpus is not None:
        parts.append(
            _exploded(
                gpus,
                keep or [],
                "gpu",
                gpu_snapshot,
                _alert(F.col("util") < GPU_UTIL_LOW, "gpu_util_low", F.col("util")),
                _alert(F.col("temp") > GPU_TEMP_HIGH, "gpu_temp_high", F.col("temp")),
            )
        )
    if not parts:
        raise ValueError("no telemetry given")
    return reduce(DataFrame.unionByName, parts)
