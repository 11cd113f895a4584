"""Answers of lost tasks and runs: finished calls are not repeated, in either way of losing them."""

import json
import os
import signal
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from harkline.operators import annotate as ann
from harkline.operators.journal import Journal
from harkline.operators.resume import resume_state
from harkline.sources.results import read_results
from tests.test_runs import called


def client(calls, deadly_after=None, fail=()):
    """Notes each answer in a file; kills its process (as a lost executor would be) after some."""
    def factory():
        def call(request):
            if deadly_after is not None and len(os.listdir(calls)) >= deadly_after:
                os.kill(os.getpid(), signal.SIGKILL)
            open(f"{calls}/{request}-{uuid.uuid4().hex}", "w").close()
            if request in fail:
                raise RuntimeError("busy")
            return json.dumps({"choices": [{"message": {"content": f"said {request}"}}]})

        return call

    return factory


def attempt_with(factory, threads=1):
    def attempt(todo, journal=None):
        rows = todo.withColumn("request", F.col("utt"))
        return ann.result_record(ann.annotate(rows, factory, threads=threads, journal=journal))

    return attempt


@pytest.fixture
def calls(folder):
    os.makedirs(f"{folder}/calls")
    return f"{folder}/calls"


def items_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "utt string").coalesce(1)


def journal_files(log):
    return [f"{at}/{f}" for at, _, files in os.walk(f"{log}/_journal") for f in files if f.startswith("answers-")]


def test_killed_run_repeats_no_finished_call(spark, folder, calls):
    log, names = f"{folder}/log", [f"u{i}" for i in range(200)]
    journal = Journal.of(log, rows=1, seconds=0.0)
    items = items_of(spark, names)
    with pytest.raises(Exception):
        ann.annotate_retry(items, log, "a", attempt_with(client(calls, 120)), journal=journal, task_items=1000)
    before = called(calls)
    assert 120 <= len(before) < 200 and read_results(spark, log).count() == 0
    # a file can hold several answers that came at once
    kept = sum(pq.read_metadata(f).num_rows for f in journal_files(log))
    # a task may lose what its queue of two holds and the answer it was about to write
    assert kept >= 120 - 3 * spark.sparkContext.defaultParallelism
    out = ann.annotate_retry(items, log, "b", attempt_with(client(calls)), journal=journal)
    assert out.where("status = 'ok'").count() == 200 == out.select("utt").distinct().count()
    repeated = sum(n - 1 for n in called(calls).values())
    # tasks that were not killed may have kept more until they were ended
    assert repeated <= len(before) - kept
    assert journal_files(log) == [] and {r.caption for r in out.collect()} == {f"said {n}" for n in names}


def test_failures_taken_over_count_as_attempts(spark, folder, calls):
    log, names = f"{folder}/log", [f"u{i}" for i in range(20)]
    journal = Journal.of(log, rows=1, seconds=0.0)
    items, fail = items_of(spark, names), {f"u{i}" for i in range(10)}
    with pytest.raises(Exception):
        ann.annotate_retry(items, log, "a", attempt_with(client(calls, 12, fail)), journal=journal)
    out = ann.annotate_retry(items, log, "b", attempt_with(client(calls, None, fail)), journal=journal, max_retries=2)
    state = {r.utt: (r.done, r.retry) for r in resume_state(out).collect()}
    assert state == {n: (False, 2) if n in fail else (True, 0) for n in names}
    assert out.count() == 10 * 2 + 10


def test_task_that_runs_again_takes_its_answers(spark, folder, calls):
    names = [f"u{i}" for i in range(40)]
    rows = items_of(spark, names).select("utt", F.lit(1).alias("retry_attempt"), F.array(F.lit(0.5), F.lit(None)).alias("more"), F.col("utt").alias("request"))
    journal = Journal(f"{folder}/j", rows=4, seconds=0.0)
    with pytest.raises(Exception):
        ann.annotate(rows, client(calls, 25), threads=1, journal=journal).collect()
    kept = called(calls)
    got = ann.annotate(rows, client(calls), threads=1, journal=journal).collect()
    assert sorted(r.utt for r in got) == sorted(names) and all(r.more == [0.5, None] and r.ts is not None for r in got)
    repeated = sum(n - 1 for n in called(calls).values())
    assert len(kept) >= 25 and repeated <= 6


def test_repeated_rows_and_no_rows(spark, folder, calls):
    rows = items_of(spark, ["a", "a", "b", None]).withColumn("request", F.col("utt"))
    journal = Journal(f"{folder}/j", rows=1, seconds=0.0)
    for _ in range(2):
        assert sorted(str(r.utt) for r in ann.annotate(rows, client(calls), journal=journal).collect()) == ["None", "a", "a", "b"]
    assert called(calls) == {"a": 2, "b": 1}
    assert ann.annotate(rows.where("false"), client(calls), journal=journal).count() == 0


def test_answers_of_a_run_under_way_stay(spark, folder, calls):
    log = f"{folder}/log"
    journal = Journal.of(log, rows=1, seconds=0.0)
    other = items_of(spark, ["x", "y"]).select("utt", F.lit(1).cast("bigint").alias("retry_attempt"), F.col("utt").alias("request"))
    ann.annotate(other, client(calls), journal=journal.below("other", 0)).collect()
    out = ann.annotate_retry(items_of(spark, ["x", "z"]), log, "own", attempt_with(client(calls)), journal=journal)
    assert {r.utt for r in out.collect()} == {"x", "z"} and called(calls) == {"x": 1, "y": 1, "z": 1}
    # y is no item of this run: its answer stays for the run that asked
    assert journal_files(log)
    out = ann.annotate_retry(items_of(spark, ["x", "y"]), log, "next", attempt_with(client(calls)), journal=journal)
    assert out.count() == 3 and called(calls) == {"x": 1, "y": 1, "z": 1} and journal_files(log) == []
