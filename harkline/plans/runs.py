"""Annotation runs: manifests and packed shards, from catalogue to result log."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.functions.payload import build_request, data_url, mime_by_extension, mime_by_magic
from harkline.operators.annotate import ClientFactory, annotate, annotate_retry, result_record
from harkline.operators.journal import Journal
from harkline.operators.ordering import line_index
from harkline.operators.planning import assign_chunks, range_slice
from harkline.operators.resume import MAX_RETRIES
from harkline.operators.throughput import sample_weighted
from harkline.session import written
from harkline.sources.manifest import read_manifest
from harkline.sources.payloads import content_duration, load_payload
from harkline.sources.shards import read_shard_index, shard_files, slice_shards, store_shard_index, stored_range

#: Pending items, and a journal for `annotate` or none, to records.
Attempt = Callable[..., DataFrame]


def manifest_attempt(
    client: ClientFactory, model: str, threads: int = 16, probe: bool = True, temperature: float = 0.2, max_tokens: int = 400
) -> Attempt:
    """Pending manifest rows to result records."""

    def attempt(todo: DataFrame, journal: Journal | None = None) -> DataFrame:
        loaded = load_payload(todo, probe=probe)
        url = data_url(F.col("content"), mime_by_extension(F.col("src")))
        request = F.when(F.col("load_error").isNull(), build_request(url, model, temperature, max_tokens))
        kept = ["utt", "retry_attempt", *[c for c in ("audio_duration", "audio_duration_error", "chunk_id") if c in loaded.columns]]
        called = annotate(
            loaded.select(*kept, request.alias("request"), F.col("load_error").alias("request_error")),
            client,
            threads=threads,
            journal=journal,
        )
        return result_record(called)

    return attempt


def shard_attempt(
    files: DataFrame,
    client: ClientFactory,
    model: str,
    threads: int = 16,
    temperature: float = 0.2,
    max_tokens: int = 400,
    rtf_share: float = 0.0,
) -> Attempt:
    """Pending index rows to result records; a share of the items gets a duration."""

    def attempt(todo: DataFrame, journal: Journal | None = None) -> DataFrame:
        sliced = slice_shards(todo, files)
        content = F.col("content")
        if rtf_share > 0:
            # decide by key first: only sampled payloads are looked into
            drawn = sample_weighted(sliced.withColumn("audio_duration", F.lit(1.0)), rtf_share, "idx")
            sliced = drawn.withColumn("audio_duration", content_duration(F.when(F.col("sampled"), content)))
            # a sampled item without duration stands for itself only
            sliced = sliced.withColumn("sample_weight", F.when(F.col("audio_duration").isNotNull(), F.col("sample_weight")).otherwise(1.0))
        kept = ["idx", "retry_attempt", "compressed_size"]
        kept += [c for c in ("audio_duration", "sample_weight", "chunk_id") if c in sliced.columns]
        request = build_request(data_url(content, F.col("mime_type")), model, temperature, max_tokens)
        requests = sliced.withColumn("mime_type", mime_by_magic(content)).select(
            *kept,
            F.col("sr").alias("sample_rate"),
            "mime_type",
            F.when(F.col("error").isNull(), request).alias("request"),
            F.col("error").alias("request_error"),
        )
        return result_record(annotate(requests, client, threads=threads, journal=journal), "idx")

    return attempt


def manifest_plan(spark: SparkSession, paths: str | Iterable[str], chunks: int, base: str = "manifest") -> DataFrame:
    """Manifest entries with dense index and chunk, parsed and numbered once."""
    return assign_chunks(written(line_index(read_manifest(spark, paths)), "manifest"), chunks, base)


def run_manifest(
    spark: SparkSession,
    paths: str | Iterable[str],
    log_path: str,
    run_id: str,
    client: ClientFactory,
    model: str,
    chunks: int = 1,
    max_retries: int = MAX_RETRIES,
    **options,
) -> DataFrame:
    """Annotate what the log does not hold yet; returns the log."""
    items = manifest_plan(spark, paths, chunks).select("utt", "src", "idx", "chunk_id")
    return annotate_retry(items, log_path, run_id, manifest_attempt(client, model, **options), "utt", max_retries, "chunk_id", journal=Journal.of(log_path))


def run_shards(
    spark: SparkSession,
    path: str,
    log_path: str,
    run_id: str,
    client: ClientFactory,
    model: str,
    start: int = 0,
    end: int | None = None,
    max_retries: int = MAX_RETRIES,
    stored_index: str | None = None,
    **options,
) -> DataFrame:
    """Annotate an index range of a shard folder; returns the log.

    Runs over several ranges share the numbered index in `stored_index`.
    """
    if stored_index:
        store_shard_index(spark, path, stored_index)
        index = stored_range(spark, stored_index, start, end)
    else:
        index = range_slice(read_shard_index(spark, path), start, end)
    attempt = shard_attempt(shard_files(spark, path), client, model, **options)
    # slicing places the rows itself
    return annotate_retry(
        index, log_path, run_id, attempt, "idx", max_retries, place=False, journal=Journal.of(log_path)
    )
