"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.catalog import fixtures as fx
from harkline.functions import payload, text
from harkline.operators import annotate as ann
from harkline.operators import merge, ordering, planning, progress, resume, telemetry, throughput
from harkline.plans.runs import manifest_attempt
from harkline.session import local_path, scratch_path, written
from harkline.sources import manifest, payloads, results, shards
from harkline.streaming import intake, logs
from harkline.streaming import telemetry as arriving

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MODEL = "captioner"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fixture(spark, sf, fx.RUN_LOG)


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fixture(spark, sf, fx.MANIFEST_ITEMS)


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed manifest entries with a dense index."""
    entries = manifest.parse_manifest(fx.fixture(spark, sf, fx.MANIFEST_LINES))
    return written(ordering.line_index(entries), "entries")


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fixture(spark, sf, fx.PAYLOADS)


def _r(column, digits: int = 6):
    return F.round(column, digits)


# --- sources


@query
def read_manifest(spark, sf):
    path = fx.write_lines(fx.fixture(spark, sf, fx.MANIFEST_LINES), "pos", "manifest")
    entries = manifest.read_manifest(spark, path)
    return ordering.line_index(entries).select("idx", "utt", "src", "is_command")


@query
def manifest_profile(spark, sf):
    return manifest.manifest_profile(fx.fixture(spark, sf, fx.MANIFEST_LINES))


@query
def list_media(spark, sf):
    root = fx.media_tree(spark, sf)
    listing = manifest.list_media(spark, root)
    return listing.select("subset", "utt", F.expr(f"substring(src, {len(local_path(root)) + 2})").alias("name"), "length")


@query
def read_shard_index(spark, sf):
    return shards.read_shard_index(spark, fx.shard_folder(spark, sf))


@query
def shard_files(spark, sf):
    files = shards.shard_files(spark, fx.shard_folder(spark, sf))
    return files.select("bin_index", text.base_name(F.col("path")).alias("name"), "length")


@query
def read_results(spark, sf):
    path = fx.write_lines(fx.fixture(spark, sf, fx.RESULT_LINES), "pos", "results")
    log = results.read_results(spark, path)
    return ordering.line_index(log.drop("idx")).select(
        "idx", "utt", "status", "caption", "error", "retry_attempt", "usage"
    )


@query
def bad_records(spark, sf):
    return results.bad_records(fx.fixture(spark, sf, fx.RESULT_LINES)).select("pos", "raw")


@query
def latest_run(spark, sf):
    root = local_path(scratch_path(spark, "runs"))
    runs = (
        fx.table(spark, sf, "events")
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), F.unix_micros(F.max("ts").cast("timestamp")).alias("at"))
    )

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for run, n, at in zip(batch["event_type"], batch["n"], batch["at"]):
                path = f"{root}/captions-arkive-{run}.jsonl"
                os.makedirs(root, exist_ok=True)
                with open(path, "w") as file:
                    file.write(json.dumps({"lines": int(n)}) + "\n")
                os.utime(path, (at / 1e6, at / 1e6))
        yield pd.DataFrame({"n": [0]})

    runs.mapInPandas(put, "n bigint").agg(F.sum("n")).collect()
    return results.latest_run(spark, root).select("run_id")


@query
def load_payload(spark, sf):
    root = local_path(fx.payload_files(spark, sf))
    src = F.when(F.col("doc_id") % 19 == 0, F.concat(F.lit("cat "), "path", F.lit(" |"))).otherwise(
        F.concat(F.lit(f"{root}/"), fx.payload_name())
    )
    loaded = payloads.load_payload(_payloads(spark, sf).select("doc_id", src.alias("src")))
    return loaded.select(
        "doc_id",
        F.md5("content").alias("digest"),
        F.octet_length("content").cast("bigint").alias("size"),
        F.col("load_error").isNotNull().alias("failed"),
    )


def _sliced(spark, sf):
    folder = fx.shard_folder(spark, sf)
    return shards.read_shard_index(spark, folder), shards.shard_files(spark, folder)


@query
def slice_shards(spark, sf):
    index, files = _sliced(spark, sf)
    return shards.slice_shards(index, files).select(
        "idx", F.md5("content").alias("digest"), F.col("compressed_size").cast("bigint").alias("compressed_size"), "error"
    )


@query
def lookup_items(spark, sf):
    index, files = _sliced(spark, sf)
    ids = fx.table(spark, sf, "labels").select(F.col("doc_id").alias("idx"))
    return shards.lookup_items(index, files, ids).select(
        "idx", "bin_index", "start", "size", "sr", "ch", F.md5("content").alias("digest")
    )


def _stored(spark, sf):
    stored = scratch_path(spark, "stored-index")
    shards.store_shard_index(spark, fx.shard_folder(spark, sf), stored)
    return stored


@query
def stored_items(spark, sf):
    """The same positions as `lookup_items`, from the files of a stored index that hold them."""
    ids = fx.table(spark, sf, "labels").select(F.col("doc_id").alias("idx"))
    return shards.stored_items(spark, _stored(spark, sf), ids)


@query
def stored_range(spark, sf):
    return shards.stored_range(spark, _stored(spark, sf), 100, 700)


# --- sinks


@query
def write_results(spark, sf):
    path = scratch_path(spark, "log")
    log = _log(spark, sf).withColumn("usage", F.format_string('{"total_tokens":%d}', "pos")).withColumn("chunk", F.col("pos") % 4)
    results.write_results(log, path, "run-1", "chunk")
    back = results.read_results(spark, path)
    return back.select(
        "utt", "status", "caption", "error", "processing_time", "retry_attempt", "audio_duration",
        "audio_duration_error", "usage", F.regexp_extract("source_file", "chunk_id=([0-9]+)", 1).cast("bigint").alias("chunk_id"),
    )


@query
def write_captions_tsv(spark, sf):
    path = scratch_path(spark, "tsv")
    results.write_captions_tsv(_log(spark, sf), path)
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(parts[0].alias("utt"), parts[1].alias("caption"))


def _log_lines(spark, sf):
    return results.parse_results(fx.fixture(spark, sf, fx.LOG_LINES))


@query
def write_merged(spark, sf):
    path = scratch_path(spark, "merged")
    chosen = merge.merge_results(_log_lines(spark, sf).select("utt", "status", "caption", "raw", "pos"))
    results.write_merged(written(chosen, "merged"), path, f"{path}-tsv")
    back = results.read_results(spark, path)
    return ordering.line_index(back.drop("idx")).select("idx", "raw")


@query
def write_chunks(spark, sf):
    path = scratch_path(spark, "chunks")
    assigned = planning.assign_chunks(_entries(spark, sf), 7)
    manifest.write_chunks(assigned, path, "manifest", "2024-01-01 00:00:00")
    back = manifest.read_manifest(spark, path)
    chunk = F.regexp_extract("source_file", "chunk_id=([0-9]+)", 1).cast("int")
    return back.select(chunk.alias("chunk_id"), "utt", "src")


@query
def write_manifest(spark, sf):
    path = scratch_path(spark, "subsets")
    root = fx.media_tree(spark, sf)
    manifest.write_manifest(manifest.list_media(spark, root), path)
    back = manifest.read_manifest(spark, path)
    return back.select(
        F.regexp_extract("source_file", "subset=([^/]+)/", 1).alias("subset"),
        "utt",
        F.expr(f"substring(src, {len(local_path(root)) + 2})").alias("name"),
    )


# --- projections


@query
def utt_from_path(spark, sf):
    return _payloads(spark, sf).select("doc_id", text.utt_from_path(F.col("path")).alias("utt"))


@query
def mime_by_extension(spark, sf):
    return _payloads(spark, sf).select("doc_id", payload.mime_by_extension(F.col("path")).alias("mime"))


@query
def mime_by_magic(spark, sf):
    content = F.col("content")
    return _payloads(spark, sf).select(
        "doc_id",
        payload.mime_by_magic(content).alias("mime"),
        payload.mime_by_magic(content, strict=False).alias("mime_box"),
    )


def _url():
    return payload.data_url(F.col("content"), payload.mime_by_magic(F.col("content")))


@query
def data_url(spark, sf):
    return _payloads(spark, sf).select("doc_id", F.md5(_url()).alias("digest"), F.length(_url()).cast("bigint").alias("chars"))


@query
def build_request(spark, sf):
    request = payload.build_request(_url(), MODEL)
    return _payloads(spark, sf).select(
        "doc_id", F.md5(request).alias("digest"), F.length(request).cast("bigint").alias("chars")
    )


@query
def parse_response(spark, sf):
    rows = fx.fixture(spark, sf, fx.RESPONSES)
    return rows.select("pos", payload.parse_response(F.col("body")).alias("a")).select("pos", "a.content", "a.usage")


@query
def one_line_caption(spark, sf):
    docs = fx.table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(text.one_line_caption(F.col("text"))).alias("digest"))


@query
def audio_probe(spark, sf):
    probed = payloads.audio_probe(manifest.list_media(spark, fx.media_tree(spark, sf), suffixes=[""]))
    return probed.groupBy("subset", "container", "sample_rate", "channels").agg(
        F.count("*").alias("files"),
        _r(F.sum("audio_duration"), 9).alias("seconds"),
        F.count("audio_duration_error").alias("without_duration"),
    )


@query
def result_record(spark, sf):
    called = fx.fixture(spark, sf, fx.RESPONSES).select(
        F.concat(F.lit("u"), "pos").alias("utt"),
        F.when(F.col("pos") % 5 == 0, F.lit(None)).otherwise(F.col("body")).alias("response"),
        F.when(F.col("pos") % 5 == 0, "timed out").alias("call_error"),
        F.lit(0.5).alias("processing_time"),
        (F.col("pos") % 3 + 1).alias("retry_attempt"),
        (F.col("pos") * 0.5).alias("audio_duration"),
    )
    return ann.result_record(called)


# --- filters, ranges, chunks, samples


@query
def global_index(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return ordering.global_index(docs, ["source", "n_chars", "doc_id"]).select("idx", "doc_id")


@query
def range_slice(spark, sf):
    index = shards.read_shard_index(spark, fx.shard_folder(spark, sf))
    return planning.range_slice(index, 100, 700)


@query
def assign_chunks(spark, sf):
    return planning.assign_chunks(_entries(spark, sf), 6).select("idx", "utt", "chunk_id", "chunk_name")


@query
def chunk_ranges(spark, sf):
    return planning.chunk_ranges(fx.table(spark, sf, "documents"), 64)


@query
def chunk_summary(spark, sf):
    return planning.chunk_summary(planning.assign_chunks(_entries(spark, sf), 16))


@query
def ok_filter(spark, sf):
    return merge.ok_filter(_log(spark, sf)).select("pos", "utt", "caption", "processing_time")


@query
def sample_weighted(spark, sf):
    return throughput.sample_weighted(_log(spark, sf), 0.25).select(
        "pos", "sampled", "audio_duration", "sample_weight"
    )


# --- joins


@query
def pending(spark, sf):
    return resume.pending(_items(spark, sf), resume.resume_state(_log(spark, sf)))


@query
def exhausted_items(spark, sf):
    return resume.exhausted_items(_items(spark, sf), resume.resume_state(_log(spark, sf)))


@query
def shard_path_join(spark, sf):
    index, files = _sliced(spark, sf)
    return shards.shard_path_join(index, files).select(
        "idx", "bin_index", text.base_name(F.col("path")).alias("name")
    )


@query
def forecast_datasets(spark, sf):
    out = throughput.forecast_datasets(throughput.run_metrics(_log(spark, sf)))
    return out.withColumn("gpu_hours", _r("gpu_hours"))


# --- aggregations


@query
def resume_state(spark, sf):
    return resume.resume_state(_log(spark, sf))


@query
def resume_report(spark, sf):
    return resume.resume_report(_items(spark, sf), resume.resume_state(_log(spark, sf)))


@query
def merge_results(spark, sf):
    return merge.merge_results(_log(spark, sf)).drop("ts")


@query
def merge_last(spark, sf):
    return merge.merge_results(_log(spark, sf), prefer_success=False).drop("ts")


@query
def merge_stats(spark, sf):
    return merge.merge_stats(_log(spark, sf))


@query
def throughput_stats(spark, sf):
    log = throughput.sample_weighted(_log(spark, sf), 0.25)
    out = throughput.throughput_stats(log, weight="sample_weight")
    doubles = [n for n, t in out.dtypes if t == "double"]
    return out.withColumns({n: _r(n) for n in doubles})


@query
def duration_error_hist(spark, sf):
    return throughput.duration_error_hist(_log(spark, sf))


@query
def gpu_hours_estimate(spark, sf):
    stats = throughput.throughput_stats(_log(spark, sf))
    total = _items(spark, sf).agg(F.count("*")).scalar()
    out = throughput.gpu_hours_estimate(stats, total)
    return out.withColumns({n: _r(n) for n in ("gpu_hours_total", "gpu_hours_960h")})


@query
def run_metrics(spark, sf):
    out = throughput.run_metrics(_log(spark, sf))
    return out.withColumns({n: _r(n) for n, t in out.dtypes if t == "double"})


@query
def throughput_rate(spark, sf):
    out = throughput.throughput_rate(throughput.run_metrics(_log(spark, sf)))
    return out.select(*[_r(c).alias(c) for c in out.columns])


@query
def progress_stats(spark, sf):
    out = progress.progress_stats(_log(spark, sf))
    return out.withColumns({n: _r(n) for n, t in out.dtypes if t == "double"})


@query
def progress_report(spark, sf):
    profile = manifest.manifest_profile(fx.fixture(spark, sf, fx.MANIFEST_LINES))
    expected = (profile.select("progress_total").scalar() * 40).alias("e")
    out = progress.progress_report(progress.progress_stats(_log(spark, sf)), expected, 86400.0)
    return out.select(
        "expected", "remaining", "eta_label",
        *[_r(n).alias(n) for n in ("successful_pct", "failed_pct", "avg_seconds", "progress_pct", "samples_per_sec",
                                   "samples_per_hour", "eta_seconds", "rtf_file_span", "gpu_hours_960h")],
    )


@query
def retry_distribution(spark, sf):
    return progress.retry_distribution(_log(spark, sf)).withColumn("pct", _r("pct"))


@query
def error_histogram(spark, sf):
    return progress.error_histogram(_log(spark, sf))


# --- windows, sorts, sets


@query
def running_counts(spark, sf):
    return throughput.running_counts(_log(spark, sf)).select("pos", "status", "ok_so_far", "fail_so_far")


@query
def checkpoint_series(spark, sf):
    out = throughput.checkpoint_series(_log(spark, sf), 100)
    return out.withColumns({"audio_seconds": _r("audio_seconds"), "avg_audio_seconds": _r("avg_audio_seconds", 8)})


@query
def recent_rate(spark, sf):
    """Hourly snapshots of one log per user."""
    events = fx.table(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    hourly = events.groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count("*").alias("n"), (F.max(at) / 1e6).alias("mtime")
    )
    so_far = "sum(n) over (partition by user_id order by hour rows unbounded preceding)"
    snapshots = hourly.select("user_id", "mtime", F.expr(so_far).alias("total_lines"))
    out = progress.recent_rate(snapshots, "user_id")
    return out.select(
        "user_id", "total_lines", _r("mtime", 3).alias("mtime"),
        _r("recent_per_sec").alias("recent_per_sec"), _r("recent_per_hour", 4).alias("recent_per_hour"),
    )


@query
def last_processed(spark, sf):
    return progress.last_processed(_log(spark, sf))


@query
def top_errors(spark, sf):
    return progress.top_errors(_log(spark, sf))


@query
def sorted_index(spark, sf):
    index = shards.shard_index_rows(fx.fixture(spark, sf, fx.SHARD_INDEX)).drop("doc_id")
    return shards.sorted_index(index)


@query
def sorted_keys(spark, sf):
    return merge.sorted_keys(merge.merge_results(_log(spark, sf))).select("utt", "status", "pos")


@query
def union_logs(spark, sf):
    second = _log_lines(spark, sf).select("utt", "status", "caption", "retry_attempt", "pos")
    both = merge.union_logs(_log(spark, sf).select("utt", "status", "caption", "retry_attempt", "pos"), second)
    return both.drop("retry_attempt")


@query
def distinct_keys(spark, sf):
    return merge.distinct_keys(_log(spark, sf))


# --- model call


def stub_factory():
    """Deterministic model: the answer is the request's digest; some requests fail."""
    def call(request: str) -> str:
        digest = hashlib.md5(request.encode("utf-8")).hexdigest()
        if digest[0] == "0":
            raise RuntimeError(f"busy {digest[:4]}")
        if digest[0] == "1":
            return '{"error": "no answer"}'
        return json.dumps({"choices": [{"message": {"content": digest}}], "usage": {"total_tokens": len(request)}})

    return call


def _requests(items: DataFrame) -> DataFrame:
    return items.select("utt", "retry_attempt", payload.build_request(_url(), MODEL).alias("request"))


def _attempt(todo: DataFrame) -> DataFrame:
    return ann.result_record(ann.annotate(_requests(todo), stub_factory))


def _named(spark, sf):
    return _payloads(spark, sf).withColumn("utt", F.concat(F.lit("d"), "doc_id"))


@query
def annotate(spark, sf):
    items = _named(spark, sf).withColumn("retry_attempt", F.lit(1).cast("bigint"))
    called = written(_attempt(items), "called")
    return called.select("utt", "status", "caption", "usage", "error", "retry_attempt")


@query
def annotate_retry(spark, sf):
    """Items are names only; a pass fetches the payloads of what is pending."""
    rows = _named(spark, sf)

    def attempt(todo: DataFrame) -> DataFrame:
        return _attempt(rows.join(todo.select("utt", "retry_attempt"), "utt"))

    log = ann.annotate_retry(rows.select("utt"), scratch_path(spark, "retry"), "run", attempt)
    return log.select("utt", "status", "caption", "error", "retry_attempt")


# --- streams and telemetry


def _stream_log(spark, sf):
    return fx.write_lines(fx.fixture(spark, sf, fx.LOG_LINES), "pos", "stream-log")


def _drain(started):
    started.awaitTermination()
    return started


@query
def stream_progress(spark, sf):
    state = scratch_path(spark, "state")
    _drain(logs.stream_progress(spark, _stream_log(spark, sf), state, interval=None))
    out = logs.progress_view(spark, state)
    return out.select("total_lines", "unique_keys", "successful", "failed", "null_key_lines", "last_key")


@query
def stream_merge(spark, sf):
    state = scratch_path(spark, "state")
    _drain(logs.stream_merge(spark, _stream_log(spark, sf), state, interval=None))
    return logs.merged_view(spark, state).select("utt", "status", "caption", "retry_attempt")


@query
def stream_resume(spark, sf):
    """Resume state kept by a stream of the log."""
    state = scratch_path(spark, "state")
    _drain(logs.stream_resume(spark, _stream_log(spark, sf), state))
    return logs.resume_view(spark, state)


def _timed_lines(spark, sf):
    path = scratch_path(spark, "timed")
    _log(spark, sf).select("utt", "status", F.col("ts").cast("timestamp").alias("ts")).write.parquet(path)
    return spark.readStream.schema("utt string, status string, ts timestamp").parquet(path)


@query
def stream_recent_rate(spark, sf):
    state = scratch_path(spark, "state")
    _drain(logs.stream_recent_rate(spark, _timed_lines(spark, sf), state, window="1 hour", interval=None))
    return logs.rate_view(spark, state).select(
        (F.unix_micros("window_start") / 1e6).cast("bigint").alias("window_start"), "lines", _r("recent_per_sec").alias("recent_per_sec")
    )


@query
def stream_closed_rate(spark, sf):
    """Windows that the watermark has passed, a day behind the newest line."""
    table, state = scratch_path(spark, "closed"), scratch_path(spark, "state")
    _drain(logs.stream_closed_rate(spark, _timed_lines(spark, sf), table, state, window="1 hour", delay="1 day", interval=None))
    closed = spark.read.parquet(table)
    return closed.select((F.unix_micros("window_start") / 1e6).cast("bigint").alias("window_start"), "lines")


@query
def stream_annotate(spark, sf):
    root = local_path(fx.payload_files(spark, sf))
    rows = _named(spark, sf).select(
        F.concat("utt", F.lit(f" {root}/"), fx.payload_name()).alias("value"), "doc_id"
    )
    source, log, state = fx.write_lines(rows, "doc_id", "arriving"), scratch_path(spark, "log"), scratch_path(spark, "state")
    attempt = manifest_attempt(stub_factory, MODEL, probe=False)
    _drain(intake.stream_annotate(spark, source, log, state, "stream", attempt, interval=None))
    merged = merge.merge_results(results.read_results(spark, log))
    return merged.select("utt", "status", "caption", "retry_attempt", F.coalesce(F.startswith("error", F.lit("[Errno 2]")), F.lit(False)).alias("unreadable"))


def _metrics(spark, sf, pick="last"):
    return telemetry.parse_metrics(fx.fixture(spark, sf, fx.METRIC_LINES), pick=pick)


@query
def parse_metrics(spark, sf):
    first = _metrics(spark, sf, "first").select("snapshot_id", F.col("waiting").alias("first_waiting"))
    return _metrics(spark, sf).join(first, "snapshot_id")


@query
def queue_shares(spark, sf):
    out = telemetry.queue_shares(_metrics(spark, sf))
    return out.select(
        "snapshot_id", "total_requests", *[_r(f"{c}_share").alias(f"{c}_share") for c in telemetry.COUNTS]
    )


def _gpus(spark, sf):
    return telemetry.parse_gpu(fx.fixture(spark, sf, fx.GPU_LINES))


@query
def parse_gpu(spark, sf):
    return _gpus(spark, sf).drop("line").withColumn("mem_pct", _r("mem_pct"))


@query
def telemetry_alerts(spark, sf):
    return telemetry.telemetry_alerts(_metrics(spark, sf), _gpus(spark, sf))


@query
def stream_metrics(spark, sf):
    """Queue alerts of all snapshots, from metrics that a stream keeps."""
    path, state = scratch_path(spark, "metric-lines"), scratch_path(spark, "state")
    fx.fixture(spark, sf, fx.METRIC_LINES).select(F.lit("s").alias("server"), "snapshot_id", "line", "pos").write.parquet(path)
    lines = spark.readStream.schema("server string, snapshot_id bigint, line string, pos bigint").parquet(path)
    _drain(arriving.stream_metrics(lines, state, interval=None))
    return arriving.alerts_view(spark, state, closed=False).drop("server")


@query
def stream_gpu_alerts(spark, sf):
    lines = fx.fixture(spark, sf, fx.GPU_LINES).select("pos", F.col("line").alias("value"))
    source, table, state = fx.write_lines(lines, "pos", "gpu-lines"), scratch_path(spark, "alerts"), scratch_path(spark, "state")
    _drain(arriving.stream_gpu_alerts(spark, source, table, state, interval=None))
    return spark.read.parquet(table).groupBy("alert", "value").agg(F.count("*").alias("times"))
