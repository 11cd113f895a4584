"""Plans stay as designed: no one-task exchange over rows, pruned scans, payload after resume."""

import re

import pytest
from pyspark.sql import functions as F

from harkline.catalog import fixtures as fx
from harkline.catalog import queries as q
from harkline.functions.payload import data_url
from harkline.operators import merge, ordering, progress, resume, telemetry, throughput
from harkline.sources import payloads, shards
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def node_below(text, name):
    """First operator line below each line that holds `name`."""
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if name in line]


ROWS = ["resume_state", "merge_results", "pending", "exhausted_items", "error_histogram", "distinct_keys", "ok_filter", "sample_weighted", "parse_gpu", "parse_response", "sorted_keys", "sorted_index"]


@pytest.mark.parametrize("name", ROWS)
def test_rows_are_never_sent_to_one_task(spark, name):
    text = plan(q.QUERIES[name](spark, SMALL))
    for below in node_below(text, "Exchange SinglePartition"):
        assert "partial_" in below or "HashAggregate" in below, text


def test_running_counts_single_task_is_block_totals_only(spark):
    text = plan(throughput.running_counts(fx.fixture(spark, SMALL, fx.RUN_LOG)))
    assert all("HashAggregate(keys=[_super" in b for b in node_below(text, "Exchange SinglePartition"))


def test_reports_aggregate_before_the_shuffle(spark):
    log = fx.fixture(spark, SMALL, fx.RUN_LOG)
    for df in (progress.progress_stats(log), merge.merge_stats(log), throughput.run_metrics(log), telemetry.parse_metrics(fx.fixture(spark, SMALL, fx.METRIC_LINES))):
        text = plan(df)
        assert "partial_" in text and not re.search(r"SortAggregate\(key=\[\w", text)


def test_columns_are_pruned(spark):
    events = fx.table(spark, SMALL, "events").withColumnRenamed("event_type", "status")
    text = plan(merge.ok_filter(events).select("event_id"))
    assert re.search(r"ReadSchema: struct<event_id:bigint,event_type:string>", text)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,ok)]" in text


def test_listing_reads_no_content(spark):
    folder = fx.shard_folder(spark, SMALL)
    text = plan(shards.shard_files(spark, folder))
    assert "content" not in text


def test_resume_comes_before_the_payload(spark):
    log = fx.fixture(spark, SMALL, fx.RUN_LOG)
    todo = resume.pending(fx.fixture(spark, SMALL, fx.MANIFEST_ITEMS), resume.resume_state(log))
    text = plan(payloads.load_payload(todo).select("utt", data_url(F.col("content"), F.lit("a/b"))))
    assert text.index("MapInArrow") < text.index("Join")


def test_index_is_written_once(spark):
    docs = fx.table(spark, SMALL, "documents").select("doc_id", "n_chars")
    text = plan(ordering.global_index(docs, ["n_chars", "doc_id"]))
    assert "rangepartitioning" not in text and "documents.parquet" not in text
