import os

from harkline.operators import telemetry
from harkline.operators.progress import recent_rate
from harkline.streaming import telemetry as arriving
from tests.test_sources import put

TEXT = """# HELP vllm:num_requests_running 5
vllm:num_requests_running{a="b c"} 3.9
vllm:num_requests_waiting 7
vllm:num_requests_waiting{e="1"}\t2500.0
 # vllm:num_requests_swapped 9
vllm:gpu_cache_usage_perc oops
vllm:avg_prompt_throughput_toks_per_s{x="1"} 1e3

other_metric 4
vllm:avg_generation_throughput_toks_per_s"""


def frame(spark, texts):
    rows = [(s, i, line) for s, text in texts.items() for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "snapshot_id int, pos int, line string")


def test_metrics(spark):
    lines = frame(spark, {1: TEXT, 2: "# nothing\n", 3: "vllm:num_requests_running 50"})
    last = {r.snapshot_id: r for r in telemetry.parse_metrics(lines).collect()}
    first = {r.snapshot_id: r for r in telemetry.parse_metrics(lines, pick="first").collect()}
    assert (last[1].running, last[1].waiting, first[1].waiting, last[1].swapped) == (3, 2500, 7, 9)
    assert (last[1].gpu_cache_pct, last[1].prompt_throughput, last[1].gen_throughput, last[1].bad_lines) == (None, 1000.0, None, 1)
    assert last[2].running is None and last[2].bad_lines == 0
    shares = {r.snapshot_id: r for r in telemetry.queue_shares(telemetry.parse_metrics(lines)).collect()}
    assert shares[1].total_requests == 2512 and shares[3].running_share == 1.0 and shares[2].running_share is None
    alerts = {(r.source, r.snapshot, r.alert, r.value) for r in telemetry.telemetry_alerts(telemetry.parse_metrics(lines)).collect()}
    assert alerts == {("queue", 1, "queue_high", 2503), ("queue", 3, "queue_low", 50)}


def test_gpus(spark):
    rows = ["85, 120000, 143771, 65", "49, 0, 0, 81", " 50 ,1,2,80,extra", "1, 2, 3", "x, 1, 4, 90", ""]
    df = spark.createDataFrame(list(enumerate(rows)), "pos int, line string")
    parsed = {r.pos: r for r in telemetry.parse_gpu(df).collect()}
    assert sorted(parsed) == [0, 1, 2, 4]
    assert parsed[1].mem_pct is None and parsed[4].util is None and parsed[4].mem_pct == 25.0
    alerts = {(r.snapshot, r.alert) for r in telemetry.telemetry_alerts(gpus=telemetry.parse_gpu(df)).collect()}
    assert alerts == {(1, "gpu_util_low"), (1, "gpu_temp_high"), (4, "gpu_temp_high")}


def test_recent_rate(spark):
    df = spark.createDataFrame([("a", 10.0, 5), ("a", 12.0, 9), ("a", 12.0, 9), ("b", 1.0, 1)], "f string, mtime double, total_lines int")
    rates = [r.recent_per_sec for r in recent_rate(df, "f").orderBy("f", "mtime").collect()]
    assert rates == [None, 2.0, None, None]


def test_stream_of_snapshots_equals_batch(spark, folder):
    """Files of a snapshot come in several batches; the newest one of a server is still open."""
    half = TEXT.index("vllm:num_requests_waiting{e")
    texts = {("a", 1): [TEXT[:half], TEXT[half:]], ("a", 2): ["# nothing\n"], ("b", 7): ["vllm:num_requests_running 50"], ("b", 12): [TEXT]}
    changed = []

    def drain():
        lines = arriving.snapshot_lines(spark, f"{folder}/in", max_files=1)
        output = lambda rows, batch: changed.extend((r.server, r.snapshot_id) for r in rows.collect())
        arriving.stream_metrics(lines, f"{folder}/state", None, output).awaitTermination()

    assert arriving.metrics_view(spark, f"{folder}/state").count() == 0
    for part in (0, 1):
        for (server, number), parts in texts.items():
            if part < len(parts):
                put(f"{folder}/in/{server}/metrics-{number:06d}.{part}.prom", parts[part])
        put(f"{folder}/in/b/readme.txt", "vllm:num_requests_running 1")
        drain()
    lines = frame(spark, {i: "".join(parts) for i, parts in enumerate(texts.values())})
    want = {tuple(texts)[r.snapshot_id]: tuple(r)[1:] for r in telemetry.parse_metrics(lines).collect()}
    assert {(r.server, r.snapshot_id): tuple(r)[2:] for r in arriving.metrics_view(spark, f"{folder}/state").collect()} == want
    assert {(r.server, r.snapshot_id) for r in arriving.metrics_view(spark, f"{folder}/state", closed=True).collect()} == {("a", 1), ("b", 7)}
    alerts = {(r.server, r.snapshot, r.alert, r.value) for r in arriving.alerts_view(spark, f"{folder}/state").collect()}
    assert alerts == {("a", 1, "queue_high", 2503), ("b", 7, "queue_low", 50)}
    assert sorted(changed) == sorted([*texts, ("a", 1)])


def test_stream_of_gpu_alerts(spark, folder):
    for name, rows in (("1", ["85, 120000, 143771, 65", "49, 0, 0, 81"]), ("2", ["10, 1, 2, 30", "x"])):
        put(f"{folder}/in/{name}.csv", "\n".join(rows))
        arriving.stream_gpu_alerts(spark, f"{folder}/in", f"{folder}/alerts", f"{folder}/state", None).awaitTermination()
    got = spark.read.parquet(f"{folder}/alerts").collect()
    assert sorted((os.path.basename(r.source_file), r.alert, r.value) for r in got) == [
        ("1.csv", "gpu_temp_high", 81), ("1.csv", "gpu_util_low", 49), ("2.csv", "gpu_util_low", 10)
    ]
