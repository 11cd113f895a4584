"""Resume, merge and order against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from harkline.operators import merge, ordering, planning, progress, resume, throughput

LOG = "pos bigint, utt string, status string, retry_attempt bigint"


def random_log(n, keys, seed, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for pos in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        key = None if rng.random() < 0.02 else key
        status = rng.choice(["ok", "fail", "fail", "fail", "fail", "skipped", None])
        attempt = rng.choice([None, None, rng.randrange(1, 6)])
        rows.append((pos, key, status, attempt))
    return rows


def fold(rows):
    done, retry = set(), {}
    for _, key, status, attempt in rows:
        if status == "ok":
            done.add(key)
            retry.pop(key, None)
        elif status == "fail":
            retry[key] = attempt if attempt is not None else retry.get(key, 0) + 1
    return done, retry


@pytest.mark.parametrize("hot,block", [(0.0, 1 << 24), (0.4, 64), (0.4, 1), (0.9, 7)])
def test_resume_state_equals_fold(spark, hot, block):
    rows = random_log(3000, 150, 7 + block, hot)
    shuffled = random.Random(1).sample(rows, len(rows))
    state = resume.resume_state(spark.createDataFrame(shuffled, LOG), block=block)
    done, retry = fold(rows)
    got = {r.utt: (r.done, r.retry) for r in state.collect()}
    keys = done | set(retry)
    assert got == {k: (k in done, retry.get(k, 0)) for k in keys}


def test_pending_and_reports(spark):
    rows = random_log(2000, 300, 3, 0.3)
    done, retry = fold(rows)
    items = [(i, random.Random(i).choice(["hot"] * 3 + [f"k{i % 400}"] * 4)) for i in range(1500)]
    df = spark.createDataFrame(items, "pos int, utt string")
    state = resume.resume_state(spark.createDataFrame(rows, LOG))
    wanted = sorted((i, k, retry.get(k, 0) + 1) for i, k in items if k not in done and retry.get(k, 0) < 3)
    assert sorted(map(tuple, resume.pending(df, state).collect())) == wanted
    out = sorted((i, k) for i, k in items if retry.get(k, 0) >= 3)
    assert sorted(map(tuple, resume.exhausted_items(df, state).collect())) == out
    report = resume.resume_report(df, state).first().asDict()
    assert report == {"total": len(items), "already_done": len(done), "exhausted": len(out), "to_process": len(wanted)}


@pytest.mark.parametrize("prefer", [True, False])
def test_merge(spark, prefer):
    rows = random_log(4000, 200, 11, 0.35)
    by_key = {}
    for row in rows:
        by_key.setdefault(row[1], []).append(row)
    missing = len(by_key.pop(None, []))
    chosen = {}
    for key, records in by_key.items():
        ok = [r for r in records if r[2] == "ok"] if prefer else []
        chosen[key] = ok[0] if ok else records[-1]
    df = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), LOG)
    assert {r.utt: tuple(r) for r in merge.merge_results(df, prefer_success=prefer).collect()} == chosen
    good = sum(r[2] == "ok" for r in chosen.values())
    assert merge.merge_stats(df, prefer_success=prefer).first().asDict() == {
        "unique_keys": len(chosen), "successful": good, "failed": len(chosen) - good,
        "duplicates_resolved": sum(len(r) - 1 for r in by_key.values()), "missing_key": missing,
    }


def test_sorted_keys_order(spark):
    df = spark.createDataFrame([("é",), ("z",), ("a",), ("\U0001F600",), ("￮",)], "utt string")
    assert [r.utt for r in merge.sorted_keys(df).collect()] == sorted(["é", "z", "a", "\U0001F600", "￮"])
    numbers = spark.createDataFrame([(10,), (9,), (2,)], "idx bigint")
    assert [r.idx for r in merge.sorted_keys(numbers, "idx").collect()] == [2, 9, 10]


def test_union_logs_keeps_order(spark):
    a = spark.createDataFrame([(0, "x"), (5, "y")], "pos bigint, utt string")
    b = spark.createDataFrame([(0, "z")], "pos bigint, utt string")
    both = merge.union_logs(a, b, b).orderBy("pos").collect()
    assert [(r.pos, r.utt) for r in both] == [(0, "x"), (5, "y"), (6, "z"), (7, "z")]


def test_global_index_with_equal_keys(spark):
    rows = [(i, i % 3 == 0 and 7 or i % 5) for i in range(5000)]
    df = spark.createDataFrame(random.Random(3).sample(rows, len(rows)), "id int, k int")
    got = {r.id: r.idx for r in ordering.global_index(df, ["k", "id"]).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0]: i for i, r in enumerate(order)}


@pytest.mark.parametrize("block", [1, 37, 1 << 24])
def test_running_counts(spark, block):
    rows = random_log(2000, 10, 5)
    df = spark.createDataFrame(random.Random(4).sample(rows, len(rows)), LOG)
    ok = fail = 0
    wanted = []
    for pos, _, status, _ in rows:
        ok, fail = ok + (status == "ok"), fail + (status != "ok")
        wanted.append((pos, ok, fail))
    got = throughput.running_counts(df, block=block).select("pos", "ok_so_far", "fail_so_far").orderBy("pos")
    assert list(map(tuple, got.collect())) == wanted


def test_line_index_and_sparse_checkpoints(spark):
    rows = [(i * i * 1000, "ok" if i % 3 else "fail", 2.0 if i % 2 else 0.0) for i in range(1050)]
    df = spark.createDataFrame(rows, "pos bigint, status string, audio_duration double")
    index = ordering.line_index(df, block=1 << 14).orderBy("pos").collect()
    assert [r.idx for r in index] == list(range(1050))
    series = throughput.checkpoint_series(df, 100, dense=False).orderBy("processed").collect()
    assert [r.processed for r in series] == [100 * i for i in range(1, 11)]
    assert all(r.ok_so_far == sum(1 for i in range(r.processed) if i % 3) for r in series)
    assert all(r.with_duration == sum(1 for i in range(r.processed) if i % 3 and i % 2) for r in series)


def split_rule(n, jobs):
    jobs = min(jobs, n)
    size = (n + jobs - 1) // jobs
    return [list(range(n))[i : i + size] for i in range(0, n, size)]


@pytest.mark.parametrize("n,jobs", [(10, 6), (10, 1), (10, 10), (10, 99), (1, 5), (97, 8), (100, 7)])
def test_chunks(spark, n, jobs):
    df = spark.range(n).select(F.col("id").alias("idx"))
    chunks = split_rule(n, jobs)
    got = {r.idx: (r.chunk_id, r.chunk_name) for r in planning.assign_chunks(df, jobs, "m%").collect()}
    assert got == {i: (c, f"m%_chunk_{c:04d}") for c, members in enumerate(chunks) for i in members}
    ranges = planning.chunk_ranges(df, jobs).orderBy("chunk_id").collect()
    assert [(r.start_idx, r.end_idx) for r in ranges] == [(c[0], c[-1] + 1) for c in chunks]
    assert ranges[0].run_id == f"ark_chunk_0_0_{len(chunks[0])}"
    lines = {r.chunk_id: r.lines for r in planning.chunk_summary(planning.assign_chunks(df, jobs)).collect()}
    assert lines == {c: len(m) for c, m in enumerate(chunks)}


def test_empty_inputs(spark):
    empty = spark.range(0).select(F.col("id").alias("idx"))
    assert planning.chunk_ranges(empty, 4).count() == 0
    assert planning.assign_chunks(empty, 4).count() == 0
    assert planning.range_slice(spark.range(9).select(F.col("id").alias("idx")), 5, 5).count() == 0
    log = spark.createDataFrame([], LOG + ", error string, processing_time double, audio_duration double")
    assert resume.resume_state(log).count() == 0
    assert merge.merge_stats(log).first().unique_keys == 0
    assert progress.progress_stats(log).first().total_lines == 0
    assert throughput.run_metrics(log).count() == 0
    assert progress.top_errors(log).count() == 0
    with pytest.raises(ValueError):
        planning.assign_chunks(empty, 0)


def test_merge_beyond_any_bit_width(spark):
    top = (1 << 61) + 5
    rows = [(top, "a", "ok"), (top + 1, "a", "fail"), (top + 2, "a", "ok"), (3, "b", "fail"), (top, "b", None)]
    df = spark.createDataFrame(rows, "pos bigint, utt string, status string")
    assert {r.utt: r.pos for r in merge.merge_results(df).collect()} == {"a": top, "b": top}
    last = merge.merge_results(df, prefer_success=False)
    assert {r.utt: r.pos for r in last.collect()} == {"a": top + 2, "b": top}


def test_hot_and_null_keys_of_items(spark):
    rows = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i}",) for i in range(3000)]
    items = spark.createDataFrame(rows, "utt string")
    state = spark.createDataFrame([("hot", True, 0), ("k3", False, 3), ("k6", False, 2)], "utt string, done boolean, retry bigint")
    left = [r.utt for r in resume.pending(items, state).collect()]
    assert sorted(map(str, left)) == sorted(str(k) for (k,) in rows if k not in ("hot", "k3"))
    assert [r.utt for r in resume.exhausted_items(items, state).collect()] == ["k3"]


def test_throughput_limits(spark):
    rows = [("ok", 1.0, 2.0, None)] * 9 + [("ok", 1.0, 0.0, "e"), ("fail", 9.0, None, None)]
    df = spark.createDataFrame(rows, "status string, processing_time double, audio_duration double, audio_duration_error string")
    stats = throughput.throughput_stats(df, elapsed=5.0)
    row = stats.first()
    assert (row.processed, row.samples_per_sec, row.rtf_wall, row.samples_without_duration) == (10, 2.0, 3.6, 1)
    forecast = throughput.gpu_hours_estimate(stats, 7200).first()
    assert forecast.gpu_hours_total == 1.0 and abs(forecast.gpu_hours_960h - 960 / 3.6) < 1e-9
    short = throughput.throughput_stats(df, elapsed=0.05)
    assert short.first().samples_per_sec is None and throughput.gpu_hours_estimate(short, 1).first().gpu_hours_total is None
    few = throughput.throughput_stats(df.limit(9), elapsed=5.0)
    assert throughput.gpu_hours_estimate(few, 1).first().gpu_hours_total is None
    assert throughput.forecast_datasets(throughput.run_metrics(df), ["a", "b"], [18.0]).count() == 1


def test_progress_key_can_be_both(spark):
    rows = [(0, "a", "ok", None, 1.0, 2.0), (1, "a", "fail", "e" * 120, -1.0, None), (2, "b", None, None, 2.0, 0.0), (3, None, "ok", None, None, None)]
    df = spark.createDataFrame(rows, "pos bigint, utt string, status string, error string, processing_time double, audio_duration double")
    row = progress.progress_stats(df).first()
    assert (row.total_lines, row.unique_keys, row.successful, row.failed, row.null_key_lines) == (4, 2, 1, 2, 1)
    assert (row.total_processing_time, row.total_audio_duration, row.last_outcome) == (3.0, 2.0, "ok")
    kinds = {r.error_type: r.lines for r in progress.error_histogram(df).collect()}
    assert kinds == {"e" * 100: 1, "Unknown error": 1}
    report = progress.progress_report(progress.progress_stats(df), 0).first()
    assert report.progress_pct is None and report.eta_seconds is None
