"""Whole runs with a stub model: one call per row and pass, resume, streams equal batches."""

import json
import os
import random
import socket
import tempfile
import time
import uuid

import pytest
from pyspark.sql import functions as F

from harkline.operators import annotate as ann
from harkline.operators import merge, progress, resume, throughput
from harkline.plans import reports, runs
from harkline.sources.files import read_lines
from harkline.sources.results import latest_own_run, log_span, read_results
from harkline.streaming import batches, intake, logs, state
from tests.test_sources import flac, put


def stub(calls, fail=(), broken=()):
    """Client that notes each call in a file of its own; payload text decides failures."""
    def factory():
        import base64

        def call(request):
            url = json.loads(request)["messages"][0]["content"][0]["audio_url"]["url"]
            data = base64.b64decode(url.split(",")[1])
            name = data.split(b"|")[1].decode()
            open(f"{calls}/{name}-{uuid.uuid4().hex}", "w").close()
            if name in fail:
                raise RuntimeError(f"busy {name}")
            if name in broken:
                return '{"choices": []}'
            return json.dumps({"choices": [{"message": {"content": f"said {name}"}}], "usage": {"n": len(data)}})

        return call

    return factory


def called(calls):
    out = {}
    for name in os.listdir(calls):
        out[name.rsplit("-", 1)[0]] = out.get(name.rsplit("-", 1)[0], 0) + 1
    return out


@pytest.fixture
def media(folder):
    names = [f"m{i}" for i in range(40)]
    for name in names:
        put(f"{folder}/audio/{name}.flac", flac(16000, 1, 32000) + f"|{name}|".encode())
    put(f"{folder}/m.scp", "# list\n" + "".join(f"{n} {folder}/audio/{n}.flac\n" for n in names) + f"gone {folder}/audio/gone.flac\ncmd cat x |\n")
    os.makedirs(f"{folder}/calls")
    return folder, names


def test_manifest_run_resume_and_reports(spark, media):
    folder, names = media
    log, calls = f"{folder}/log", f"{folder}/calls"
    client = stub(calls, fail={"m3"}, broken={"m5"})
    runs.run_manifest(spark, f"{folder}/m.scp", log, "first", client, "m", chunks=4, threads=3, max_retries=2)
    wanted = {n: 2 if n in ("m3", "m5") else 1 for n in names}
    assert called(calls) == wanted
    rows = read_results(spark, log).collect()
    assert len(rows) == 38 + 4 * 2 and {r.retry_attempt for r in rows if r.utt == "m3"} == {1, 2}
    ok = {r.utt: r for r in rows if r.status == "ok"}
    assert ok["m1"].caption == "said m1" and ok["m1"].audio_duration == 2.0 and json.loads(ok["m1"].usage)["n"] > 0
    assert {r.error for r in rows if r.utt == "m3"} == {"busy m3"} and {r.error for r in rows if r.utt == "m5"} == {"no content in response"}
    assert all(r.error.startswith("[Errno 2]") for r in rows if r.utt == "gone")
    # nothing is pending at this limit; a higher one sends the failed items again, and they succeed
    runs.run_manifest(spark, f"{folder}/m.scp", log, "again", stub(calls), "m", max_retries=2)
    assert called(calls) == wanted
    runs.run_manifest(spark, f"{folder}/m.scp", log, "more", stub(calls), "m", max_retries=3)
    assert called(calls) == {n: 3 if n in ("m3", "m5") else 1 for n in names}
    assert {r.retry_attempt for r in read_results(spark, log).where("utt = 'm3' and status = 'ok'").collect()} == {3}
    stats = reports.merge_logs(spark, log, f"{folder}/merged", f"{folder}/tsv").first()
    assert (stats.unique_keys, stats.successful, stats.failed) == (42, 40, 2)
    tsv = [r.value for r in read_lines(spark, f"{folder}/tsv").orderBy("pos").collect()]
    assert tsv == [f"{n}\tsaid {n}" for n in sorted(names)]
    report = reports.progress_of(spark, log, manifest=f"{folder}/m.scp")
    assert report["summary"].first().progress_pct == pytest.approx(100 * 40 / 42)
    assert report["errors"].first().others >= 0 and report["retries"].count() == 3
    assert reports.forecast_of(spark, log)["datasets"].count() == 5


def test_interrupted_run_sends_only_the_rest(spark, media):
    folder, names = media
    log, calls = f"{folder}/log", f"{folder}/calls"

    def failing_after_write(todo):
        raise KeyboardInterrupt

    items = spark.createDataFrame([(n, f"{folder}/audio/{n}.flac") for n in names], "utt string, src string")
    half = items.where("length(utt) = 2")
    attempt = runs.manifest_attempt(stub(calls), "m")
    ann.annotate_retry(half, log, "a", attempt)
    with pytest.raises(KeyboardInterrupt):
        ann.annotate_retry(items, log, "b", failing_after_write)
    ann.annotate_retry(items, log, "c", attempt)
    assert called(calls) == {n: 1 for n in names}
    merged = merge.merge_results(read_results(spark, log))
    assert merged.where("status = 'ok'").count() == len(names)


def test_shard_run(spark, folder):
    rows, blobs = [], {}
    for i in range(30):
        data = flac(8000, 1, 8000 * (i + 1)) + f"|s{i}|".encode()
        shard = i % 3
        blob = blobs.setdefault(shard, bytearray())
        rows.append((shard, len(blob), len(data), 8000, 1))
        blob.extend(data)
    for shard, blob in blobs.items():
        put(f"{folder}/ark/arkive_{shard}.bin", bytes(blob))
    spark.createDataFrame(rows, "bin_index int, start_byte_offset int, file_size_bytes int, sample_rate int, channels int").write.parquet(f"{folder}/ark/metadata.parquet")
    os.makedirs(f"{folder}/calls")
    log = runs.run_shards(spark, f"{folder}/ark", f"{folder}/log", "r", stub(f"{folder}/calls"), "m", start=5, end=25, rtf_share=1.0)
    got = {r.idx: r for r in log.collect()}
    assert sorted(got) == list(range(5, 25))
    order = sorted(range(30), key=lambda i: (rows[i][0], rows[i][1]))
    assert all(got[i].caption == f"said s{order[i]}" for i in got)
    assert all(got[i].audio_duration == order[i] + 1 and got[i].mime_type == "audio/flac" for i in got)
    assert all(got[i].compressed_size == rows[order[i]][2] and got[i].sample_rate == 8000 for i in got)


def test_calls_overlap_within_a_task(spark):
    def factory():
        def call(request):
            time.sleep(0.2)
            return "{}"

        return call

    rows = spark.createDataFrame([(i, "{}", None) for i in range(40)], "i int, request string, request_error string").coalesce(1)
    began = time.time()
    out = ann.annotate(rows, factory, threads=20).collect()
    assert len(out) == 40 and time.time() - began < 6 and {r.i for r in out} == set(range(40))
    assert all(0.1 < r.processing_time < 2 for r in out)


LINES = ['{"utt": "u%d", "status": "%s", "caption": "c%d", "error": "e", "processing_time": 1.0, "retry_attempt": 1}' % (i % 37, ["fail", "fail", "ok"][(i * 7) % 3], i) for i in range(900)]


def test_records_carry_time_and_weight(spark, folder):
    """Throughput and real-time factor of a finished run come from its own log."""
    blobs = [flac(16000, 1, 32000) + f"|s{i}|".encode() for i in range(30)]
    put(f"{folder}/arkive_000.bin", b"".join(blobs))
    rows = [(0, sum(map(len, blobs[:i])), len(b)) for i, b in enumerate(blobs)]
    spark.createDataFrame(rows, "bin_index int, start_byte_offset bigint, file_size_bytes int").write.parquet(f"{folder}/metadata.parquet")
    os.makedirs(f"{folder}/calls")
    log = runs.run_shards(
        spark, folder, f"{folder}/log", "r", stub(f"{folder}/calls", fail=["s3"]), "m", rtf_share=0.5, stored_index=f"{folder}/numbered"
    )
    got = log.collect()
    assert all(abs(r.ts.timestamp() - time.time()) < 600 for r in got)
    drawn = [r for r in got if r.audio_duration is not None]
    assert 0 < len(drawn) < 30 and {r.sample_weight for r in drawn} == {2.0}
    assert {r.sample_weight for r in got if r.status == "ok" and r.audio_duration is None} == {1.0}
    stats = throughput.throughput_stats(log, weight="sample_weight").first()
    assert stats.processed == 29 and stats.elapsed_seconds == (max(r.ts for r in got) - min(r.ts for r in got)).total_seconds()
    assert abs(stats.audio_hours - 2.0 * 2.0 * len(drawn) / 3600) < 1e-9
    weighted = throughput.run_metrics(log, "sample_weight").first()
    assert weighted.rtf_latency_weighted == 2 * weighted.rtf_latency


def test_http_client_keeps_its_connection(monkeypatch):
    """One connection for a thread; a new one after an error or after the server closed it; no request twice."""
    made = []

    class Answer:
        status, reason, headers = 200, "OK", {}
        read = staticmethod(lambda: b'{"choices": []}')

    class Connection:
        def __init__(self, host, port, timeout):
            self.ours, self.theirs = socket.socketpair()
            self.sock, self.sent = self.ours, []
            assert (host, port, timeout) == ("model", 8901, 5)
            made.append(self)

        def request(self, method, path, body, headers):
            self.sent.append((method, path, body))
            if body == b"lost":
                raise ConnectionResetError("gone")

        def getresponse(self):
            answer = Answer()
            answer.status = 503 if self.sent[-1][2] == b"busy" else 200
            return answer

        def close(self):
            self.sock = None

    monkeypatch.setattr(ann.http.client, "HTTPConnection", Connection)
    monkeypatch.setattr(ann.urllib.request, "getproxies", dict)
    call = ann.http_client("http://model:8901/v1/", 5)()
    assert [call(x) for x in "ab"] == ['{"choices": []}'] * 2 and len(made) == 1
    with pytest.raises(Exception, match="503"):
        call("busy")
    call("c")
    assert len(made) == 1 and made[0].sent[0] == ("POST", "/v1/chat/completions", b"a")
    with pytest.raises(ConnectionResetError):
        call("lost")
    call("d")
    assert len(made) == 2
    made[1].theirs.close()
    call("e")
    assert len(made) == 3 and [[b for _, _, b in c.sent] for c in made] == [[b"a", b"b", b"busy", b"c", b"lost"], [b"d"], [b"e"]]


def write_batches(folder, lines, parts):
    size = len(lines) // parts
    for n in range(parts):
        put(f"{folder}/in/{n:03d}.jsonl", "\n".join([*lines[n * size : (n + 1) * size], "torn {"]) + "\n")
        os.utime(f"{folder}/in/{n:03d}.jsonl", (1000 + n, 1000 + n))


def streams(spark, folder, **options):
    """Drain the three streams of a log once."""
    for start, name in ((logs.stream_merge, "c1"), (logs.stream_progress, "c2"), (logs.stream_resume, "c3")):
        start(spark, f"{folder}/in", f"{folder}/{name}", interval=None, max_files=2, **options).awaitTermination()


def assert_streams_equal_batch(spark, folder):
    batch = read_results(spark, f"{folder}/in")
    columns = ["utt", "status", "caption", "raw", "retry_attempt"]
    for prefer in (True, False):
        view = logs.merged_view(spark, f"{folder}/c1", prefer_success=prefer)
        merged = merge.merge_results(batch, prefer_success=prefer)
        assert sorted(map(tuple, view.select(columns).collect()), key=str) == sorted(map(tuple, merged.select(columns).collect()), key=str)
    assert logs.progress_view(spark, f"{folder}/c2").first().asDict() == progress.progress_stats(batch).first().asDict()
    states = [sorted(map(tuple, s.collect()), key=str) for s in (logs.resume_view(spark, f"{folder}/c3"), resume.resume_state(batch))]
    assert states[0] == states[1]


def test_streams_equal_batch(spark, folder):
    write_batches(folder, LINES, 9)
    streams(spark, folder)
    assert_streams_equal_batch(spark, folder)
    # a second start continues where the first ended
    late = [line.replace('"fail"', '"ok"') for line in LINES[:50]]
    put(f"{folder}/in/100.jsonl", "\n".join(late))
    os.utime(f"{folder}/in/100.jsonl", (2000, 2000))
    streams(spark, folder)
    assert_streams_equal_batch(spark, folder)
    assert not any(name.startswith(("batch-", "base-")) for _, names, _ in os.walk(folder) for name in names)


def test_streams_without_a_batch(spark, folder):
    """Before the first batch, and over a log of bad lines only."""
    assert logs.merged_view(spark, f"{folder}/none").count() == 0 and logs.resume_view(spark, f"{folder}/none").count() == 0
    assert logs.progress_view(spark, f"{folder}/none").first().total_lines == 0
    put(f"{folder}/in/a.jsonl", "torn {\n\n")
    streams(spark, folder)
    assert_streams_equal_batch(spark, folder)


def test_streams_killed_between_batches(spark, folder):
    """The consumer of the third batch dies, twice; a later start gives what one read of the log gives."""
    write_batches(folder, LINES, 9)
    seen = []

    def deadly(rows, batch_id):
        seen.append(batch_id)
        if batch_id == 2 and seen.count(2) < 3:
            raise RuntimeError("killed")

    for _ in range(2):
        with pytest.raises(Exception, match="killed"):
            logs.stream_progress(spark, f"{folder}/in", f"{folder}/c2", interval=None, output=deadly, max_files=2).awaitTermination()
    so_far = logs.progress_view(spark, f"{folder}/c2").first().total_lines
    first_four = read_results(spark, [f"{folder}/in/{n:03d}.jsonl" for n in range(4)]).count()
    assert so_far == first_four  # the batch that died has changed nothing
    logs.stream_progress(spark, f"{folder}/in", f"{folder}/c2", interval=None, output=deadly, max_files=2).awaitTermination()
    assert seen.count(2) == 3 and seen.count(1) == 1
    with pytest.raises(Exception, match="killed"):
        seen.clear()
        logs.stream_merge(spark, f"{folder}/in", f"{folder}/c1", interval=None, output=deadly, max_files=2).awaitTermination()
    seen += [2, 2]
    logs.stream_merge(spark, f"{folder}/in", f"{folder}/c1", interval=None, output=deadly, max_files=2).awaitTermination()
    logs.stream_resume(spark, f"{folder}/in", f"{folder}/c3").awaitTermination()
    assert_streams_equal_batch(spark, folder)


def test_merge_output_is_an_upsert(spark, folder):
    """A batch hands on the rows of its own keys, as they are after it."""
    given = {}
    put(f"{folder}/in/1.jsonl", '{"utt": "a", "status": "fail"}\n{"utt": "b", "status": "ok", "caption": "b1"}\n')

    def output(rows, batch_id):
        given[batch_id] = {r.utt: (r.status, r.caption) for r in logs.chosen_records(rows).collect()}

    def drain():
        logs.stream_merge(spark, f"{folder}/in", f"{folder}/c", interval=None, output=output).awaitTermination()

    drain()
    put(f"{folder}/in/2.jsonl", '{"utt": "a", "status": "ok", "caption": "a2"}\n{"utt": "c", "status": "fail"}\n')
    drain()
    told = [x for x in given.values() if x]
    assert told == [{"a": ("fail", None), "b": ("ok", "b1")}, {"a": ("ok", "a2"), "c": ("fail", None)}]


def test_files_that_arrive_out_of_order(spark, folder):
    """The later file comes first, with an older time; order is by name as in one read."""
    for n, name in enumerate(("9.jsonl", "1.jsonl")):
        lines = [{"utt": u, "status": s, "caption": name} for u, s in (("a", "ok"), ("b", "fail" if n else "ok"), (None, "ok"))]
        put(f"{folder}/in/{name}", "\n".join(map(json.dumps, lines)))
        for start, at in ((logs.stream_merge, "c1"), (logs.stream_progress, "c2")):
            start(spark, f"{folder}/in", f"{folder}/{at}", interval=None).awaitTermination()
    batch = read_results(spark, f"{folder}/in")
    assert logs.progress_view(spark, f"{folder}/c2").first().asDict() == progress.progress_stats(batch).first().asDict()
    view = {r.utt: r.caption for r in logs.merged_view(spark, f"{folder}/c1").collect()}
    assert view == {r.utt: r.caption for r in merge.merge_results(batch).collect()} == {"a": "1.jsonl", "b": "9.jsonl"}


def test_places_in_a_file_of_many_splits(spark, folder):
    """Splits of one file, several in a task, give places in the order of the lines."""
    lines = [f"{n:05d} {'x' * (n % 40)}" for n in range(3000)]
    put(f"{folder}/in/a.txt", "\n".join(lines))
    put(f"{folder}/in/b.txt", "\n".join(lines[:100]))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    rows = state.in_file_order(session.read.text(f"{folder}/in").select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_start")
    ).coalesce(2))
    got = rows.select("value", "pos.source_file", "pos.place").collect()
    for name, want in (("a.txt", lines), ("b.txt", lines[:100])):
        of = sorted((r.place, r.value) for r in got if r.source_file.endswith(name))
        assert [v for _, v in of] == want and len({p for p, _ in of}) == len(want)


def test_resume_stream_folds_hot_keys(spark, folder, monkeypatch):
    """One key has most lines, with failures that carry no number; a task sends its folded rows in parts."""
    monkeypatch.setattr(logs, "_FOLDED", 2)
    for n in range(4):
        lines = [{"utt": "hot" if i % 3 else f"k{i % 7}", "status": "ok" if (i + n) % 50 == 3 else "fail" if i % 11 else "skipped"} for i in range(200)]
        for i, line in enumerate(lines):
            if (i + n) % 13 == 0:
                line["retry_attempt"] = i % 4
        put(f"{folder}/in/{n}.jsonl", "\n".join(map(json.dumps, lines)))
    logs.stream_resume(spark, f"{folder}/in", f"{folder}/c", max_files=3).awaitTermination()
    want = resume.resume_state(read_results(spark, f"{folder}/in"))
    assert sorted(map(tuple, logs.resume_view(spark, f"{folder}/c").collect())) == sorted(map(tuple, want.collect()))


def test_too_many_files_for_positions(spark, folder):
    with pytest.raises(ValueError, match="at most 1000"):
        batches.stream_lines(spark, folder, 1001)


def test_stream_annotate_continues(spark, media):
    folder, names = media
    calls, source = f"{folder}/calls", f"{folder}/arriving"
    attempt = runs.manifest_attempt(stub(calls), "m")

    def drain():
        intake.stream_annotate(spark, source, f"{folder}/log", f"{folder}/ck", "s", attempt, interval=None).awaitTermination()

    put(f"{source}/1.scp", "".join(f"{n} {folder}/audio/{n}.flac\n" for n in names[:25]))
    drain()
    put(f"{source}/2.scp", "".join(f"{n} {folder}/audio/{n}.flac\n" for n in names[20:]))
    drain()
    assert called(calls) == {n: 1 for n in names}
    assert read_results(spark, f"{folder}/log").where("status = 'ok'").count() == len(names)


def test_stream_annotate_reads_no_earlier_log(spark, media, monkeypatch):
    """A batch reads what its own passes wrote; the log before it is known from the kept state."""
    folder, names = media
    calls, source, log = f"{folder}/calls", f"{folder}/arriving", f"{folder}/log"
    # a foreign log file, with failures that carry no number
    put(f"{log}/run_id=0/old.txt", "".join(json.dumps({"utt": n, "status": "fail"}) + "\n" for n in [names[0]] * 3 + names[1:3] * 2))
    attempt = runs.manifest_attempt(stub(calls, fail=[names[3]]), "m")
    read = []
    monkeypatch.setattr(ann, "read_results", lambda spark, path, columns=None: read.append(path) or read_results(spark, path, columns))
    for part in (names[:10], names[3:20]):
        put(f"{source}/{len(part)}.scp", "".join(f"{n} {folder}/audio/{n}.flac\n" for n in part))
        intake.stream_annotate(spark, source, log, f"{folder}/ck", "s", attempt, interval=None).awaitTermination()
    state_reads = [path for path in read if "run_id=" in path]
    assert state_reads and {path for path in read if "run_id=" not in path} == {log}
    assert called(calls) == {n: 3 if n == names[3] else 1 for n in names[1:20]}  # the first had used up its attempts
    # reading `log` itself is only the value that a run returns, which a batch does not use
    assert len([p for p in read if p == log]) == 2


def timed(spark, folder, hours):
    """One file of ten lines for each hour, in that order."""
    os.makedirs(f"{folder}/in", exist_ok=True)
    for hour in hours:
        rows = [(i, f"2024-01-01 {hour:02d}:00:{i:02d}") for i in range(10)]
        df = spark.createDataFrame(rows, "i int, t string").select("i", F.col("t").cast("timestamp").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema("i int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_rate_view(spark, folder):
    rows = [(i, f"2024-01-01 00:00:{s:02d}") for i, s in enumerate([0, 1, 2, 4, 5, 6, 20])] + [(9, None)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", F.col("t").cast("timestamp").alias("ts"))
    df.write.parquet(f"{folder}/in")
    assert logs.rate_view(spark, f"{folder}/c").count() == 0
    lines = spark.readStream.schema("i int, ts timestamp").parquet(f"{folder}/in")
    logs.stream_recent_rate(spark, lines, f"{folder}/c", interval=None).awaitTermination()
    view = logs.rate_view(spark, f"{folder}/c").orderBy("window_start").collect()
    assert [(r.lines, r.recent_per_sec) for r in view] == [(4, 0.8), (2, 0.4), (1, 0.2)]


def test_rate_view_counts_late_lines(spark, folder):
    """Several batches whose times go back: no line is lost."""
    for lines in timed(spark, folder, (10, 0, 10, 0)):
        logs.stream_recent_rate(spark, lines, f"{folder}/c", interval=None).awaitTermination()
    view = logs.rate_view(spark, f"{folder}/c").collect()
    assert sum(r.lines for r in view) == 40 and {r.lines for r in view} == {10}


def test_closed_windows_and_late_lines(spark, folder):
    """A window is written once, when the watermark has passed it; what comes later is told apart."""
    counts = []
    for lines in timed(spark, folder, (0, 10, 0, 11)):
        logs.stream_closed_rate(spark, lines, f"{folder}/closed", f"{folder}/c1", window="1 hour", interval=None).awaitTermination()
        logs.stream_recent_rate(spark, lines, f"{folder}/c2", window="1 hour", interval=None).awaitTermination()
        closed = spark.read.parquet(f"{folder}/closed")
        counts.append(sorted((str(r.window_start)[11:13], r.lines) for r in closed.collect()))
    assert counts[-1] == [("00", 10)] or counts[-1] == [("00", 10), ("10", 10)]
    (late,) = logs.late_lines(spark, f"{folder}/closed", f"{folder}/c2").collect()
    assert (late.lines, late.on_time, late.late) == (20, 10, 10)
    total = logs.rate_view(spark, f"{folder}/c2").agg(F.sum("lines")).first()[0]
    assert total == 40


def test_annotate_keeps_whole_numbers(spark):
    big = (1 << 53) + 1
    rows = [(big, "a", None), (None, "b", 5), (big + 2, "c", -big)]
    df = spark.createDataFrame(rows, "n bigint, request string, m bigint").coalesce(1)
    got = ann.annotate(df, lambda: str.upper).collect()
    assert sorted(((r.n, r.response, r.m) for r in got), key=str) == sorted([(big, "A", None), (None, "B", 5), (big + 2, "C", -big)], key=str)
    assert ann.annotate(df.where("false"), lambda: str.upper).count() == 0


def test_lost_run_keeps_its_finished_slices(spark, folder):
    """A run that dies in a slice has the slices before it in the log; no item is called twice overall."""
    os.makedirs(f"{folder}/calls")
    items = spark.createDataFrame([(f"u{i}",) for i in range(60)], "utt string")

    def attempt_with(deadly):
        def factory():
            def call(request):
                if deadly and len(os.listdir(f"{folder}/calls")) >= 20:
                    raise SystemExit("lost")
                open(f"{folder}/calls/{request}-{uuid.uuid4().hex}", "w").close()
                return json.dumps({"choices": [{"message": {"content": request}}]})

            return call

        def attempt(todo):
            return ann.result_record(ann.annotate(todo.withColumn("request", F.col("utt")), factory, threads=1))

        return attempt

    with pytest.raises(Exception):
        ann.annotate_retry(items, f"{folder}/log", "r", attempt_with(True), slice_items=10)
    finished = {r.utt for r in read_results(spark, f"{folder}/log").collect()}
    assert 0 < len(finished) < 60
    before = called(f"{folder}/calls")
    log = ann.annotate_retry(items, f"{folder}/log", "r", attempt_with(False), slice_items=10)
    assert log.where("status = 'ok'").select("utt").distinct().count() == 60 and log.count() == 60
    after = called(f"{folder}/calls")
    assert all(after[u] == before[u] == 1 for u in finished)


def test_latest_own_run(spark, media):
    folder, names = media
    attempt = runs.manifest_attempt(stub(f"{folder}/calls"), "m")
    items = spark.createDataFrame([(n, f"{folder}/audio/{n}.flac") for n in names[:3]], "utt string, src string")
    ann.annotate_retry(items, f"{folder}/log", "first", attempt)
    ann.annotate_retry(spark.createDataFrame([(names[5], f"{folder}/audio/{names[5]}.flac")], "utt string, src string"), f"{folder}/log", "second", attempt)
    row = latest_own_run(spark, f"{folder}/log").first()
    assert row.run_id.endswith("-second") and row.path.endswith(row.run_id)
    assert latest_own_run(spark, f"{folder}/none").count() == 0
    assert log_span(spark, f"{folder}/log").first().seconds > 0


def test_resume_of_files_that_arrive_late(spark, folder, monkeypatch):
    """Many turns of a task, plain failures before and after a set counter, files out of order."""
    monkeypatch.setattr(logs, "_FOLDED", 2)
    draw = random.Random(3)
    kinds = ['"status": "ok"', '"status": "fail"', '"status": "fail"', '"status": "fail", "retry_attempt": 2', '"status": "skipped"']
    os.makedirs(f"{folder}/in")
    for name in ("b", "d", "a", "c"):
        with open(f"{folder}/in/{name}.jsonl", "w") as file:
            for _ in range(40):
                utt = draw.choice(['"utt": "hot", '] * 4 + ["", *(f'"utt": "u{i}", ' for i in range(12))])
                file.write(f"{{{utt}{draw.choice(kinds)}}}\n")
        logs.stream_resume(spark, f"{folder}/in", f"{folder}/c").awaitTermination()
    want = resume.resume_state(read_results(spark, f"{folder}/in"))
    got = [sorted(map(tuple, rows.collect()), key=str) for rows in (logs.resume_view(spark, f"{folder}/c"), want)]
    assert got[0] == got[1] and len(got[0]) > 10


def test_no_python_runs_for_each_key_of_the_resume_state(spark, folder):
    with open(f"{folder}/a.jsonl", "w") as file:
        file.write('{"utt": "a", "status": "ok"}\n')
    started = logs.stream_resume(spark, folder, tempfile.mkdtemp(prefix="harkline-test-"))
    started.awaitTermination()
    assert "InPandas" not in started._jsq.explainInternal(False)
