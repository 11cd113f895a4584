"""Files: manifests, logs, shards, media."""

import gzip
import json
import os
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harkline.operators import planning
from harkline.operators.ordering import line_index
from harkline.operators.planning import assign_chunks
from harkline.sources import manifest, payloads, results, shards
from harkline.sources.files import read_lines


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(data if isinstance(data, bytes) else data.encode())


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def test_line_positions_over_files_and_splits(spark, folder, tiny_splits):
    files = {
        "b dir/one.txt": [f"b{i} {'x' * (i % 17)}" for i in range(120)],
        "b dir/two+é.txt": [""] * 200 + ["last"],
        "a/only.txt": ["single"],
        "a/other.txt": [f"o{i}" for i in range(333)],
    }
    for name, lines in files.items():
        put(f"{folder}/{name}", "\n".join(lines) + "\n")
    with gzip.open(f"{folder}/a/packed.txt.gz", "wt") as file:
        file.write("\n".join(f"g{i}" for i in range(500)))
    files["a/packed.txt.gz"] = [f"g{i}" for i in range(500)]
    os.makedirs(f"{folder}/empty")
    lines = read_lines(spark, [f"{folder}/b dir", f"{folder}/a", f"{folder}/none*", f"{folder}/a"])
    assert lines.rdd.getNumPartitions() > 8
    rows = lines.orderBy("pos").collect()
    order = ["b dir/one.txt", "b dir/two+é.txt", "a/only.txt", "a/other.txt", "a/packed.txt.gz"]
    seen = [r.value for r in rows]
    wanted = [line for name in order for line in files[name]]
    assert len({r.pos for r in rows}) == len(rows)
    # the repeated argument is the same files once more in Spark's listing
    assert [v for i, v in enumerate(seen)][: len(files["b dir/one.txt"])] == files["b dir/one.txt"]
    assert sorted(set(seen)) == sorted(set(wanted))


def test_line_order_exact(spark, folder, tiny_splits):
    put(f"{folder}/2.txt", "".join(f"two {i}\n" for i in range(700)))
    put(f"{folder}/1.txt", "".join(f"one {i}\r\n" for i in range(300)) + "end without newline")
    put(f"{folder}/3.txt", "\n" * 300 + "x\n")
    rows = read_lines(spark, [f"{folder}/2.txt", f"{folder}/1.txt", f"{folder}/3.txt"]).orderBy("pos").collect()
    wanted = [f"two {i}" for i in range(700)] + [f"one {i}" for i in range(300)] + ["end without newline"] + [""] * 300 + ["x"]
    assert [r.value for r in rows] == wanted
    assert len({r.pos for r in rows}) == len(rows)


def test_manifest_chunks_round_trip(spark, folder):
    lines = ["# head", ""] + [f"u{i} /a b/{i}.flac" for i in range(10)]
    put(f"{folder}/m.scp", "\n".join(lines))
    entries = line_index(manifest.read_manifest(spark, f"{folder}/m.scp"))
    manifest.write_chunks(assign_chunks(entries, 6, "m"), f"{folder}/out", "m.scp", "now")
    manifest.write_chunks(assign_chunks(entries, 4, "m"), f"{folder}/out", "m.scp", "now")
    assert sorted(d for d in os.listdir(f"{folder}/out") if d.startswith("chunk")) == [f"chunk_id={i}" for i in range(4)]
    text = read_lines(spark, f"{folder}/out/chunk_id=1").orderBy("pos").collect()
    assert [r.value for r in text] == ["# m_chunk_0001 of m.scp", "# written at now", "# entries: 3", "", "u3 /a b/3.flac", "u4 /a b/4.flac", "u5 /a b/5.flac"]
    assert manifest.read_manifest(spark, f"{folder}/out").count() == 10
    assert manifest.read_manifest(spark, f"{folder}/missing").count() == 0


def test_result_lines(spark, folder):
    lines = [
        '{"utt": "a", "status": "ok", "processing_time": 1.5, "retry_attempt": 1, "usage": {"n": 1}, "caption": "é"}',
        "", "  ", '{"utt": "b", "status": "o', '{"a": 1} x', '{"a": 1}{"b": 2}', '{"a": 1},{"b": 2}', '["u"]', '"s"', "5", "null",
        "{'utt': 'q'}", '{"utt": 7, "processing_time": NaN, "retry_attempt": "x", "status": null}', '  {"utt": "pad"} ', '{"utt": "a", "utt": "z"}',
    ]
    put(f"{folder}/x/r.jsonl", "\n".join(lines))
    log = results.read_results(spark, folder).orderBy("pos").collect()
    assert [r.utt for r in log] == ["a", "7", "pad", "z"]
    assert (log[0].processing_time, log[0].retry_attempt, json.loads(log[0].usage), log[0].caption) == (1.5, 1, {"n": 1}, "é")
    assert log[1].processing_time != log[1].processing_time and log[1].retry_attempt is None
    assert log[2].raw == '{"utt": "pad"}'
    bad = results.bad_records(read_lines(spark, folder)).collect()
    assert len(bad) == 9
    narrow = results.read_results(spark, folder, ["utt"])
    assert narrow.columns == ["utt", "raw", "source_file", "pos"] and narrow.count() == 4


def test_latest_run(spark, folder):
    for name, at in (("captions-arkive-7.jsonl", 100), ("captions-arkive-a-b.jsonl", 300), ("captions-arkive-x.tsv", 900), ("other.jsonl", 900)):
        put(f"{folder}/{name}", "{}")
        os.utime(f"{folder}/{name}", (at, at))
    assert results.latest_run(spark, folder).first().run_id == "a-b"
    assert results.latest_run(spark, folder, fresh="new").first().run_id == "a-b"
    assert results.latest_run(spark, f"{folder}/none").count() == 0
    assert tuple(results.latest_run(spark, f"{folder}/none", fresh="new").first()) == ("new", None, None)


def test_records_round_trip(spark, folder):
    log = spark.createDataFrame([("ü", "ok", 'a "b"\n', '{"n":{"m":[1,2]}}')], "utt string, status string, caption string, usage string")
    results.write_results(log, f"{folder}/log", "r1")
    results.write_results(log, f"{folder}/log", "r2")
    text = read_lines(spark, f"{folder}/log").orderBy("pos").collect()
    assert [r.value for r in text] == ['{"utt":"ü","status":"ok","caption":"a \\"b\\"\\n","usage":{"n":{"m":[1,2]}}}'] * 2
    assert ["run_id=r1" in r.source_file for r in text] == [True, False]


def test_merged_files_and_tsv(spark, folder):
    log = spark.createDataFrame(
        [(2, "b", "ok", " x\ty\n", "{b}"), (1, "a", "ok", None, "{a}"), (3, "c", "fail", None, "{c}")],
        "pos bigint, utt string, status string, caption string, raw string",
    )
    results.write_merged(log, f"{folder}/m", f"{folder}/t")
    assert [r.value for r in read_lines(spark, f"{folder}/m").orderBy("pos").collect()] == ["{a}", "{b}", "{c}"]
    assert [r.value for r in read_lines(spark, f"{folder}/t").orderBy("pos").collect()] == ["a\t", "b\tx\ty"]


@pytest.fixture
def shard_folder(spark, folder):
    blobs = {i: os.urandom(1000 + i) for i in range(12)}
    for i, data in blobs.items():
        put(f"{folder}/arkive_{i:03d}.bin", data)
    put(f"{folder}/notes.bin", b"")
    rows = [(i % 12, (i // 12) * 90, 90, None if i % 2 else 16000) for i in range(120)]
    rows += [(0, 950, 200, 8000), (0, 5000, 10, 8000), (12, 0, 5, 8000), (-1, 0, 5, 8000), (3, -4, 5, 8000)]
    df = spark.createDataFrame(rows, "bin_index int, start_byte_offset bigint, file_size_bytes int, sample_rate int")
    df.repartition(3).write.parquet(f"{folder}/metadata.parquet")
    return folder, blobs, rows


def test_shards(spark, shard_folder):
    folder, blobs, rows = shard_folder
    index = shards.read_shard_index(spark, folder)
    files = shards.shard_files(spark, folder)
    assert [r.bin_index for r in files.orderBy("path").collect()] == list(range(12))
    order = sorted(rows, key=lambda r: (r[0], r[1]))
    got = index.orderBy("idx").collect()
    assert [tuple(r) for r in got] == [(i, b, s, n, -1 if sr is None else sr, -1) for i, (b, s, n, sr) in enumerate(order)]
    for row in shards.slice_shards(index, files, task_bytes=500).collect():
        if row.start < 0 or row.bin_index not in blobs:
            assert row.content is None and row.error and row.compressed_size is None
        else:
            assert bytes(row.content) == blobs[row.bin_index][row.start : row.start + row.size]
            assert row.compressed_size == len(row.content) and row.error is None
    ids = spark.createDataFrame([(3,), (3,), (50,), (10_000,)], "idx bigint")
    assert sorted(r.idx for r in shards.lookup_items(index, files, ids).collect()) == [3, 50]


def test_shard_errors(spark, folder):
    with pytest.raises(FileNotFoundError):
        shards.shard_files(spark, folder)
    with pytest.raises(ValueError, match="file_size_bytes"):
        shards.shard_index_rows(spark.createDataFrame([(1, 2)], "bin_index int, start_byte_offset int"))


def wav(rate, channels, bits, frames, claim=None):
    block = channels * bits // 8
    body = b"fmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * block, block, bits)
    body += b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"data" + struct.pack("<I", claim or frames * block) + b"\0" * (frames * block)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def flac(rate, channels, samples):
    word = (rate << 44) | ((channels - 1) << 41) | (15 << 36) | samples
    return b"fLaC" + b"\0\0\0\x22" + b"\0" * 10 + word.to_bytes(8, "big") + b"\0" * 16


def test_probe_and_payload(spark, folder):
    files = {
        "a.wav": wav(8000, 2, 16, 4000), "cut.wav": wav(8000, 1, 8, 4000, claim=1 << 30), "b.flac": flac(48000, 2, 96000),
        "bad.wav": b"RIFF....WAVEfmt ", "x.mp3": b"ID3", "empty.wav": b"",
    }
    for name, data in files.items():
        put(f"{folder}/{name}", data)
    items = spark.createDataFrame([(n, f"{folder}/{n}") for n in [*files, "none.wav"]] + [("cmd", "cat x |")], "utt string, src string")
    rows = {r.utt: r for r in payloads.audio_probe(items).collect()}
    assert (rows["a.wav"].audio_duration, rows["a.wav"].channels, rows["a.wav"].sample_rate) == (0.5, 2, 8000)
    assert rows["cut.wav"].audio_duration == 0.5 and rows["b.flac"].audio_duration == 2.0
    assert rows["a.wav"].audio_duration_error is None and rows["cmd"].audio_duration_error == "pipe_command"
    assert rows["none.wav"].audio_duration_error.startswith("error: FileNotFoundError: [Errno 2]")
    assert rows["x.mp3"].audio_duration is None and rows["bad.wav"].audio_duration_error.startswith("error: ")
    loaded = {r.utt: r for r in payloads.load_payload(items).collect()}
    assert all(bytes(loaded[n].content) == data for n, data in files.items())
    assert loaded["none.wav"].load_error.startswith("[Errno 2]") and loaded["cmd"].content is None
    total = {r.container: r for r in payloads.probe_summary(payloads.audio_probe(items)).collect()}
    assert (total["wav"].files, total["wav"].with_duration, total["wav"].audio_hours) == (3, 2, 1.0 / 3600)
    held = payloads.load_payload(items).select("utt", payloads.content_duration(F.col("content")).alias("d"))
    assert {r.utt: r.d for r in held.collect() if r.d} == {"a.wav": 0.5, "cut.wav": 0.5, "b.flac": 2.0}


def test_list_media(spark, folder):
    for name in ("dev-clean/1/2/a.b.flac", "dev-clean/1/x y/c.wav", "dev-clean/_h/.d.wav", "dev-clean/e.FLAC", "dev-clean/1/2/f.mp3", "dev-clean/1/2/3/4/5/g.flac", "other/h.wav", "test-clean/i.wav"):
        put(f"{folder}/{name}", b"12345")
    os.symlink(f"{folder}/other", f"{folder}/dev-clean/linked")
    listing = manifest.list_media(spark, folder)
    rows = sorted((r.subset, r.utt, r.src[len(folder) + 1 :], r.length) for r in listing.collect())
    wanted = ["dev-clean/1/2/3/4/5/g.flac", "dev-clean/1/2/a.b.flac", "dev-clean/1/x y/c.wav", "dev-clean/_h/.d.wav", "test-clean/i.wav"]
    assert sorted(r[2] for r in rows) == wanted
    assert {r[1] for r in rows} == {"a.b", "c", ".d", "g", "i"} and {r[3] for r in rows} == {5}
    manifest.write_manifest(listing, f"{folder}/out")
    back = manifest.read_manifest(spark, f"{folder}/out/subset=dev-clean").collect()
    assert sorted(r.src[len(folder) + 1 :] for r in back) == wanted[:4]
    assert manifest.list_media(spark, f"{folder}/none").count() == 0
    # a deep and narrow tree: each round opens what the one before found
    deep = "/".join(f"d{i}" for i in range(12))
    put(f"{folder}/deep/dev-other/{deep}/end.flac", b"1")
    put(f"{folder}/deep/dev-other/{deep[:11]}/side.wav", b"1")
    for opened in (1, 5, 100):
        assert sorted(r.utt for r in manifest.list_media(spark, f"{folder}/deep", opened=opened).collect()) == ["end", "side"]


def test_null_ranges_fail_their_own_row(spark, shard_folder):
    folder, blobs, _ = shard_folder
    files = shards.shard_files(spark, folder)
    rows = [(0, 0, 0, 50), (1, 0, None, 50), (2, 0, 100, None), (3, None, 0, 5), (4, 0, 200, 50), (5, 99, 0, 5), (6, 0, -1, 5), ((1 << 53) + 1, 0, 0, 7)]
    index = spark.createDataFrame(rows, "idx bigint, bin_index bigint, start bigint, size bigint")
    got = {r.idx: r for r in shards.slice_shards(index, files).collect()}
    assert set(got) == {r[0] for r in rows}
    assert {i for i, r in got.items() if r.error is None} == {0, 4, (1 << 53) + 1}
    assert bytes(got[4].content) == blobs[0][200:250] and got[1].error == "bad range None+50"


def test_stored_index(spark, shard_folder):
    folder, _, rows = shard_folder
    stored = f"{folder}/numbered"
    first = [tuple(r) for r in shards.read_shard_index(spark, folder, stored).orderBy("idx").collect()]
    made = sorted(os.listdir(stored))
    assert first == [tuple(r) for r in shards.read_shard_index(spark, folder).orderBy("idx").collect()]
    again = shards.read_shard_index(spark, folder, stored)
    assert again.count() == len(rows) and sorted(os.listdir(stored)) == made
    plan = planning.range_slice(again, 10, 20)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(idx,10)" in plan and "LessThan(idx,20)" in plan
    assert sorted(r.idx for r in planning.range_slice(again, 10, 20).collect()) == list(range(10, 20))


def test_index_is_built_again_when_the_shards_have_grown(spark, shard_folder):
    folder, _, rows = shard_folder
    stored = f"{folder}/numbered"
    assert shards.read_shard_index(spark, folder, stored).count() == len(rows)
    more = spark.createDataFrame([(11, 5000, 10, 8000)], "bin_index int, start_byte_offset bigint, file_size_bytes int, sample_rate int")
    more.write.mode("append").parquet(f"{folder}/metadata.parquet")
    grown = shards.read_shard_index(spark, folder, stored).orderBy("idx").collect()
    assert len(grown) == len(rows) + 1 and [r.idx for r in grown] == list(range(len(grown)))
    assert [tuple(r) for r in grown] == [tuple(r) for r in shards.read_shard_index(spark, folder).orderBy("idx").collect()]
    # a build that was broken off before its last step is made again
    os.remove(f"{stored}/_source/_SUCCESS")
    made = {name: os.stat(f"{stored}/{name}").st_mtime_ns for name in os.listdir(stored) if name.endswith(".parquet")}
    assert shards.read_shard_index(spark, folder, stored).count() == len(rows) + 1
    assert not set(made) & set(os.listdir(stored))


def files_read(df):
    return len(df.inputFiles())


def test_stored_parts_read_few_files(spark, folder):
    rows = [(i // 500, (i % 500) * 10, 10) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "bin_index int, start_byte_offset bigint, file_size_bytes int")
    frame.write.parquet(f"{folder}/metadata.parquet")
    stored = f"{folder}/numbered"
    session = spark.newSession()
    for name, value in (("spark.sql.shuffle.partitions", "16"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        session.conf.set(name, value)
    shards.store_shard_index(session, folder, stored)
    whole = spark.read.parquet(stored)
    assert files_read(whole) == 16
    ids = spark.createDataFrame([(3,), (3,), (4,), (19_999,), (20_000,), (-1,), (None,)], "idx bigint")
    some = shards.stored_items(spark, stored, ids)
    assert sorted(r.idx for r in some.collect()) == [3, 4, 19_999] and files_read(some) <= 3
    part = shards.stored_range(spark, stored, 5_000, 5_100)
    assert sorted(r.idx for r in part.collect()) == list(range(5_000, 5_100)) and files_read(part) <= 2
    assert shards.stored_range(spark, stored, 19_990).count() == 10 and shards.stored_range(spark, stored, 30_000).count() == 0
    assert shards.stored_range(spark, stored, 5, 5).count() == 0 and shards.stored_items(spark, stored, ids.where("idx < 0")).count() == 0


class _Counted:
    """A shard in memory that notes its reads and can't read across `broken`."""

    def __init__(self, data, reads, broken=None):
        self.data, self.reads, self.broken, self.at = data, reads, broken, 0

    def seek(self, at):
        self.at = at

    def read(self, size):
        if self.broken is not None and self.at <= self.broken < self.at + size:
            raise OSError("broken block")
        self.reads.append((self.at, size))
        return self.data[self.at:self.at + size]

    def close(self):
        pass


def slices_of(rows, data, broken=None):
    reads = []
    batch = pa.RecordBatch.from_pylist(
        [{"path": p, "bin_index": b, "start": s, "size": n} for p, b, s, n in rows],
        pa.schema([("path", pa.string()), ("bin_index", pa.int64()), ("start", pa.int64()), ("size", pa.int64())]),
    )
    out = [r for b in shards._slices(iter([batch]), lambda path: _Counted(data[path], reads, broken)) for r in b.to_pylist()]
    return [(r["content"], r["error"]) for r in out], reads


def test_neighbouring_ranges_in_one_read(monkeypatch):
    monkeypatch.setattr(shards, "READ_GAP", 50)
    monkeypatch.setattr(shards, "READ_BYTES", 2000)
    data = {"a": os.urandom(10_000), "b": os.urandom(500)}
    rows = [("a", 0, i * 100, 80) for i in range(100)] + [("b", 1, 0, 100), ("b", 1, 50, 100), ("b", 1, 480, 100), ("b", 1, 900, 5)]
    got, reads = slices_of(rows, data)
    assert got == [(data[p][s:s + n], None) for p, _, s, n in rows]
    assert len(reads) == 5 + 3 and all(size <= 2000 for _, size in reads)
    # gaps that are too wide, a range above the bound, order that goes back
    rows = [("a", 0, 0, 10), ("a", 0, 61, 10), ("a", 0, 100, 9000), ("a", 0, 50, 10)]
    got, reads = slices_of(rows, data)
    assert got == [(data[p][s:s + n], None) for p, _, s, n in rows] and len(reads) == 4


def test_a_bad_range_fails_its_own_row(monkeypatch):
    data = {"a": bytes(1000)}
    rows = [("a", 0, 0, 10), ("a", 0, None, 10), ("a", 0, 20, 10), ("a", 0, 30, 10), (None, 7, 0, 5), ("a", 0, 40, -1), ("a", 0, 50, 10)]
    got, _ = slices_of(rows, data, broken=35)
    assert [e for _, e in got] == [None, "bad range None+10", None, "broken block", "no shard 7", "bad range 40+-1", None]
    assert [c for c, _ in got][2] == bytes(10) and len(got) == len(rows)
