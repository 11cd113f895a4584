import json
import os
import subprocess
import sys

import pytest

from harkline import cli
from harkline.operators.annotate import annotate
from harkline.session import clear_scratch, local_path, scratch_path, scratch_root, ship_package
from harkline.sources.files import read_lines
from tests.test_sources import flac, put


@pytest.fixture
def shell(spark, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    monkeypatch.setattr(cli, "clear_scratch", lambda s: None)

    def run(*argv):
        cli.main([str(a) for a in argv])
        return capsys.readouterr().out

    return run


def test_manifest_commands(shell, folder):
    for i in range(5):
        put(f"{folder}/media/dev-clean/{i}.flac", flac(8000, 1, 8000))
    shell("list-media", f"{folder}/media", f"{folder}/lists")
    assert "dev-clean" in shell("probe", f"{folder}/media")
    out = shell("split", f"{folder}/lists", 2, f"{folder}/chunks")
    assert "|0       |3    |" in out and "|1       |2    |" in out


def test_log_commands(spark, shell, folder):
    rows = [{"utt": "a", "status": "ok", "caption": "x", "processing_time": 2.0, "audio_duration": 4.0, "retry_attempt": 1}, {"utt": "b", "status": "fail", "error": "e"}]
    put(f"{folder}/log/one.jsonl", "\n".join(json.dumps(r) for r in rows) + "\nbad\n")
    put(f"{folder}/m.scp", "a 1\nb 2\nc 3\n")
    out = shell("merge", f"{folder}/log", "--out", f"{folder}/o", "--tsv", f"{folder}/t")
    assert "unique_keys" in out and "|2          |1         |1     |" in out
    assert read_lines(spark, f"{folder}/t").first().value == "a\tx"
    report = shell("progress", f"{folder}/log", "--manifest", f"{folder}/m.scp")
    assert "expected" in report and "|Unknown" not in report
    assert "LibriSpeech-960h" in shell("estimate", f"{folder}/log")
    shell("bad-lines", f"{folder}/log", f"{folder}/bad")
    put(f"{folder}/runs/captions-arkive-r7.jsonl", "{}")
    assert "|r7" in shell("latest-run", f"{folder}/runs")


def test_telemetry_command(shell, folder):
    put(f"{folder}/m/1.txt", "vllm:num_requests_running 5\n")
    put(f"{folder}/g/1.txt", "10, 1, 2, 90\n")
    out = shell("telemetry", "--metrics", f"{folder}/m", "--gpus", f"{folder}/g")
    assert "queue_low" in out and "gpu_temp_high" in out


def test_clear_scratch_removes_own_folder_only(spark, folder):
    mine = scratch_path(spark, "x")
    put(f"{local_path(mine)}/part", b"1")
    other = os.path.join(local_path(scratch_root(spark)), "harkline", "other-app", "part")
    put(other, b"1")
    clear_scratch(spark)
    assert not os.path.exists(local_path(mine)) and os.path.exists(other)


def test_long_reports_are_saved_whole(spark, shell, folder):
    put(f"{folder}/m.scp", "".join(f"u{i} {i}.flac\n" for i in range(120)))
    out = shell("split", f"{folder}/m.scp", 60, f"{folder}/chunks", "--save", f"{folder}/reports")
    assert "first 50 of 60 rows of chunks" in out
    assert spark.read.json(f"{folder}/reports/chunks").count() == 60


def test_latest_run_of_an_own_log(shell, folder):
    put(f"{folder}/log/run_id=0000000000001-00-old/chunk_id=0/part-0.txt", "{}\n")
    assert "0000000000001-00-old" in shell("latest-run", f"{folder}/log")


class _Elsewhere:
    """Stands for a session on a cluster without a checkpoint folder."""

    class conf:  # noqa: N801
        get = staticmethod(lambda name, default=None: default)

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(_Elsewhere)


def test_the_package_is_sent_along_whole(folder):
    """What a session ships is enough to import the package from another folder, without this one."""

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: default), "set": staticmethod(lambda name, value: None)})
        sparkContext = type("Context", (), {"addPyFile": staticmethod(lambda path: sent.append(path))})  # noqa: N815

    sent = []
    ship_package(Session)
    code = (
        f"import sys; sys.path.insert(0, {sent[0]!r})\n"
        "import harkline.operators.annotate as found, harkline.streaming.logs, harkline.plans.runs\n"
        "print('GOT', found.__file__)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert f"GOT {sent[0]}" in done.stdout, done.stderr[-2000:]


def test_operators_run_in_a_local_session(spark):
    df = spark.createDataFrame([("a",)], "request string")
    assert annotate(df, lambda: str.upper).head().response == "A"


def test_progress_with_kept_state(shell, folder):
    """The second report reads the new file only: the first one may even be gone."""
    put(f"{folder}/log/1.jsonl", '{"utt": "a", "status": "ok", "processing_time": 1}\n{"utt": "b", "status": "fail"}\n')
    report = shell("progress", f"{folder}/log", "--state", f"{folder}/state", "--total", 4)
    assert "total_lines | 2 " in " ".join(report.split())
    os.remove(f"{folder}/log/1.jsonl")
    put(f"{folder}/log/2.jsonl", '{"utt": "b", "status": "ok", "processing_time": 3}\n')
    report = " ".join(shell("progress", f"{folder}/log", "--state", f"{folder}/state", "--total", 4).split())
    assert "total_lines | 3 " in report and "successful | 2 " in report


def test_annotate_arriving(shell, spark, folder):
    """Without a model every call fails, three times; the second start has nothing left to do."""
    put(f"{folder}/a.flac", flac(16000, 1, 32000))
    put(f"{folder}/in/1.scp", f"u1 {folder}/a.flac\nu2 {folder}/gone.flac\n")
    for _ in range(2):
        shell(
            "annotate-arriving", f"{folder}/in", "--state", f"{folder}/state", "--log", f"{folder}/log", "--once",
            "--base-url", "http://127.0.0.1:9/v1", "--model", "m", "--timeout", 2,
        )
    records = [json.loads(r.value) for r in read_lines(spark, f"{folder}/log").collect()]
    assert sorted((r["utt"], r["status"], r["retry_attempt"]) for r in records) == [(u, "fail", n) for u in ("u1", "u2") for n in (1, 2, 3)]
    assert all(r["ts"] for r in records)
