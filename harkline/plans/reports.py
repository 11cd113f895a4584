"""Reports over result logs: merge, progress, forecasts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.operators.merge import counted_stats, merge_counted
from harkline.operators.progress import progress_report, progress_stats, retry_distribution, top_errors
from harkline.operators.throughput import forecast_datasets, run_metrics, throughput_rate
from harkline.session import written
from harkline.sources.files import read_lines
from harkline.sources.manifest import manifest_profile
from harkline.sources.results import log_span, read_results, write_merged
from harkline.streaming.logs import progress_view, stream_progress


def merge_logs(
    spark: SparkSession,
    paths: str | Iterable[str],
    out: str,
    tsv_out: str | None = None,
    key: str = "utt",
    prefer_success: bool = True,
) -> DataFrame:
    """Merge logs into one sorted log (and caption table); returns the counters.

    The logs are read and grouped once; outputs and counters come from that table.
    """
    columns = [key, "status", "caption"]
    log = read_results(spark, paths, columns).select(*columns, "raw", "pos")
    counted = written(merge_counted(log, key, prefer_success=prefer_success), "merged")
    write_merged(counted.where(F.col(key).isNotNull()), out, tsv_out, key)
    return counted_stats(counted, key)


def _expected(spark: SparkSession, manifest: str | None, total: int | None) -> int | Column | None:
    if total is None and manifest:
        return manifest_profile(read_lines(spark, manifest)).select("progress_total").scalar()
    return total


def progress_of(
    spark: SparkSession, log_paths: str | Iterable[str], manifest: str | None = None, total: int | None = None, key: str = "utt"
) -> dict[str, DataFrame]:
    """Report frames of a run: summary, retries, errors.

    The lines are parsed once into a table that all three read.
    """
    columns = [key, "status", "error", "processing_time", "audio_duration", "retry_attempt"]
    log = written(read_results(spark, log_paths, columns).select(*columns, "pos"), "log")
    return {
        "summary": progress_report(progress_stats(log, key), _expected(spark, manifest, total), log_span(spark, log_paths).scalar()),
        "retries": retry_distribution(log),
        "errors": top_errors(log),
    }


def progress_since(
    spark: SparkSession, log_path: str, state: str, manifest: str | None = None, total: int | None = None, key: str = "utt"
) -> dict[str, DataFrame]:
    """The summary of a run whose counters are kept in `state`: only files that came since are read.

    Files of the log are read once; a file that grows afterwards is not read again (those
    that runs of this package write never do).
    """
    stream_progress(spark, log_path, state, key, interval=None).awaitTermination()
    stats = progress_view(spark, state, key)
    return {"summary": progress_report(stats, _expected(spark, manifest, total), log_span(spark, log_path).scalar())}


def forecast_of(
    spark: SparkSession,
    log_paths: str | Iterable[str],
    names: list[str] | None = None,
    hours: list[float] | None = None,
) -> dict[str, DataFrame]:
    """Report frames of an estimate: metrics, datasets, rates."""
    columns = ["status", "processing_time", "audio_duration"]
    log = written(read_results(spark, log_paths, columns).select(*columns), "log")
    metrics = run_metrics(log)
    return {
        "metrics": metrics,
        "datasets": forecast_datasets(metrics, names, hours),
        "rates": throughput_rate(metrics.where(F.col("rtf_latency") > 0)),
    }
