"""Command line: `python -m harkline COMMAND ...` (or through spark-submit)."""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.operators.annotate import http_client
from harkline.operators.journal import Journal
from harkline.operators.planning import chunk_ranges, chunk_summary
from harkline.operators.resume import MAX_RETRIES
from harkline.operators.telemetry import parse_gpu, parse_metrics, queue_shares, telemetry_alerts
from harkline.plans import reports, runs
from harkline.plans.runs import manifest_attempt
from harkline.session import build_session, clear_scratch
from harkline.sources.files import read_lines
from harkline.sources.manifest import SUBSETS, list_media, write_chunks, write_manifest
from harkline.sources.payloads import audio_probe, probe_summary
from harkline.sources.results import bad_records, latest_own_run, latest_run
from harkline.streaming.intake import stream_annotate


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="harkline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, about: str) -> argparse.ArgumentParser:
        return commands.add_parser(name, help=about)

    def model_options(sub: argparse.ArgumentParser, tokens: int) -> None:
        sub.add_argument("--log", required=True, help="result log folder")
        sub.add_argument("--base-url", required=True)
        sub.add_argument("--model", required=True)
        sub.add_argument("--run-id", default="run")
        sub.add_argument("--threads", type=int, default=16, help="calls under way per task")
        sub.add_argument("--timeout", type=float, default=180)
        sub.add_argument("--max-retries", type=int, default=MAX_RETRIES)
        sub.add_argument("--temperature", type=float, default=0.2)
        sub.add_argument("--max-tokens", type=int, default=tokens)

    sub = command("list-media", "write one manifest per subset")
    sub.add_argument("root")
    sub.add_argument("out")
    sub.add_argument("--subsets", nargs="+", default=SUBSETS)
    sub = command("probe", "header inventory of a media tree")
    sub.add_argument("root")
    sub.add_argument("--subsets", nargs="+", default=SUBSETS)
    sub = command("split", "cut a manifest into chunk files")
    sub.add_argument("manifest")
    sub.add_argument("chunks", type=int)
    sub.add_argument("out")
    sub = command("ranges", "index ranges of a shard folder")
    sub.add_argument("shards")
    sub.add_argument("chunks", type=int)
    sub = command("annotate-manifest", "annotate what the log does not hold")
    sub.add_argument("manifest")
    sub.add_argument("--chunks", type=int, default=1)
    model_options(sub, 400)
    sub = command("annotate-shards", "annotate an index range of a shard folder")
    sub.add_argument("shards")
    sub.add_argument("--start", type=int, default=0)
    sub.add_argument("--end", type=int)
    sub.add_argument("--rtf-share", type=float, default=0.0)
    sub.add_argument("--index", help="folder that keeps the numbered index for all ranges")
    model_options(sub, 400)
    sub = command("annotate-arriving", "annotate manifests as they arrive in a folder")
    sub.add_argument("folder")
    sub.add_argument("--state", required=True, help="folder of the stream's checkpoint")
    sub.add_argument("--once", action="store_true", help="take what is there and end")
    model_options(sub, 400)
    sub = command("merge", "best record per key of result logs")
    sub.add_argument("logs", nargs="+")
    sub.add_argument("--out", required=True)
    sub.add_argument("--tsv")
    sub.add_argument("--key", default="utt", choices=["utt", "idx"])
    sub.add_argument("--last", action="store_true", help="keep the last record, not the first success")
    sub = command("progress", "progress report of a result log")
    sub.add_argument("logs", nargs="+")
    sub.add_argument("--manifest")
    sub.add_argument("--total", type=int)
    sub.add_argument("--key", default="utt", choices=["utt", "idx"])
    sub.add_argument("--watch", type=float, help="seconds between reports")
    sub.add_argument("--state", help="folder that keeps the state of one log folder: only files new since the last report are read")
    sub = command("estimate", "GPU-hour forecasts from a finished run")
    sub.add_argument("logs", nargs="+")
    sub.add_argument("--names", nargs="+")
    sub.add_argument("--hours", nargs="+", type=float)
    sub = command("bad-lines", "lines of result logs that are no records")
    sub.add_argument("logs", nargs="+")
    sub.add_argument("out")
    sub = command("latest-run", "newest shard log of a folder")
    sub.add_argument("folder")
    sub = command("telemetry", "queue shares and alerts of collected snapshots (one file each)")
    sub.add_argument("--metrics")
    sub.add_argument("--gpus")
    for name in ("probe", "split", "ranges", "estimate", "telemetry"):
        commands.choices[name].add_argument("--save", help="folder for the whole reports as JSON lines")
    return parser


#: Rows of a report that are printed; all of them go to the folder of --save.
PREVIEW = 50


def _show(df: DataFrame, save: str | None = None, name: str = "report") -> None:
    """Print the first rows, and say so if there are more; write all rows if asked."""
    if save:
        df.write.mode("overwrite").json(f"{save.rstrip('/')}/{name}")
    df.show(PREVIEW, truncate=False, vertical=len(df.columns) > 8)
    if len(df.take(PREVIEW + 1)) > PREVIEW:
        print(f"first {PREVIEW} of {df.count()} rows of {name}" + ("" if save else "; all with --save FOLDER"))


def _progress(spark: SparkSession, args: argparse.Namespace) -> None:
    before = None
    while True:
        if args.state:
            (log,) = args.logs
            frames = reports.progress_since(spark, log, args.state, args.manifest, args.total, args.key)
        else:
            frames = reports.progress_of(spark, args.logs, args.manifest, args.total, args.key)
        for frame in frames.values():
            _show(frame)
        if not args.watch:
            return
        now, lines = time.time(), frames["summary"].select("total_lines").first()[0]
        if before and lines > before[1]:
            print(f"recent: {(lines - before[1]) / (now - before[0]):.2f} lines/s")
        before = (now, lines)
        time.sleep(args.watch)


def _telemetry(spark: SparkSession, args: argparse.Namespace) -> None:
    metrics = gpus = None
    if args.metrics:
        lines = read_lines(spark, args.metrics).withColumnRenamed("value", "line")
        snapshot = F.shiftright("pos", 40)  # one file is one snapshot
        metrics = parse_metrics(lines.withColumn("snapshot_id", snapshot))
        _show(queue_shares(metrics), args.save, "queues")
    if args.gpus:
        gpus = parse_gpu(read_lines(spark, args.gpus).withColumnRenamed("value", "line"))
        _show(gpus, args.save, "gpus")
    _show(telemetry_alerts(metrics, gpus).groupBy("source", "alert").agg(F.count("*").alias("times")))


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "list-media":
        write_manifest(list_media(spark, args.root, args.subsets), args.out)
    elif args.command == "probe":
        _show(probe_summary(audio_probe(list_media(spark, args.root, args.subsets)), "subset", "container"), args.save, "media")
    elif args.command == "split":
        base = args.manifest.rstrip("/").rsplit("/", 1)[-1].removesuffix(".scp")
        plan = runs.manifest_plan(spark, args.manifest, args.chunks, base)
        write_chunks(plan, args.out, args.manifest, time.strftime("%Y-%m-%d %H:%M:%S"))
        _show(chunk_summary(plan).orderBy("chunk_id"), args.save, "chunks")
    elif args.command == "ranges":
        _show(chunk_ranges(spark.read.parquet(f"{args.shards}/metadata.parquet"), args.chunks), args.save, "ranges")
    elif args.command in ("annotate-manifest", "annotate-shards"):
        client = http_client(args.base_url, args.timeout)
        options = dict(
            threads=args.threads, max_retries=args.max_retries, temperature=args.temperature, max_tokens=args.max_tokens
        )
        if args.command == "annotate-manifest":
            log = runs.run_manifest(spark, args.manifest, args.log, args.run_id, client, args.model, args.chunks, **options)
        else:
            log = runs.run_shards(
                spark, args.shards, args.log, args.run_id, client, args.model, args.start, args.end,
                stored_index=args.index, rtf_share=args.rtf_share, **options,
            )
        _show(log.groupBy("status").agg(F.count("*").alias("lines")))
    elif args.command == "annotate-arriving":
        attempt = manifest_attempt(
            http_client(args.base_url, args.timeout), args.model, args.threads, temperature=args.temperature, max_tokens=args.max_tokens
        )
        stream_annotate(
            spark, args.folder, args.log, args.state, args.run_id, attempt, args.max_retries, None if args.once else "30 seconds",
            journal=Journal.of(args.log),
        ).awaitTermination()
    elif args.command == "merge":
        _show(reports.merge_logs(spark, args.logs, args.out, args.tsv, args.key, not args.last))
    elif args.command == "progress":
        _progress(spark, args)
    elif args.command == "estimate":
        for name, frame in reports.forecast_of(spark, args.logs, args.names, args.hours).items():
            _show(frame, args.save, name)
    elif args.command == "bad-lines":
        bad_records(read_lines(spark, args.logs)).select("source_file", "pos", "raw").write.json(args.out)
    elif args.command == "latest-run":
        own = latest_own_run(spark, args.folder)
        _show(latest_run(spark, args.folder) if own.isEmpty() else own)
    elif args.command == "telemetry":
        _telemetry(spark, args)


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    try:
        run(spark, args)
    finally:
        clear_scratch(spark)
