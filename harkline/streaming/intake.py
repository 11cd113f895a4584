"""Continuous annotation of arriving manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from harkline.operators.annotate import annotate_retry
from harkline.operators.journal import Journal
from harkline.operators.resume import MAX_RETRIES
from harkline.plans.runs import Attempt
from harkline.sources.files import existing
from harkline.sources.manifest import parse_manifest
from harkline.streaming.batches import batch_positions, stream_lines
from harkline.streaming.logs import resume_view, stream_resume


def stream_annotate(
    spark: SparkSession,
    manifest_path: str,
    log_path: str,
    checkpoint: str,
    run_id: str,
    attempt: Attempt,
    max_retries: int = MAX_RETRIES,
    interval: str | None = "30 seconds",
    max_files: int = 16,
    journal: Journal | None = None,
) -> StreamingQuery:
    """Annotate the entries of every new manifest file.

    Results are appended. The resume state of the log is kept as a stream's state beside
    `checkpoint`: a batch takes in the log files written since the last one and looks its
    entries up there, so it does not read the log before it. A batch that runs again after
    a failure finds what it had written in the same way and sends only the rest; with
    `journal` also what its tasks had answered (see `annotate_retry`).
    """
    state = f"{checkpoint.rstrip('/')}-resume"

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if existing(session, log_path):
            stream_resume(session, log_path, state).awaitTermination()
        items = parse_manifest(batch_positions(batch)).select("utt", "src", "pos")
        known = resume_view(session, state)
        annotate_retry(items, log_path, f"{run_id}-{batch_id:08d}", attempt, "utt", max_retries, state=known, journal=journal)

    writer = (
        stream_lines(spark, manifest_path, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
