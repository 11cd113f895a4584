import base64
import json
from pathlib import PurePosixPath

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harkline.functions import payload, text
from harkline.sources.manifest import manifest_profile, parse_manifest

SPACES = text.WHITESPACE
ODD = st.text(st.sampled_from(SPACES + "ab#|/.é"), max_size=12)


def strings(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i")


def apply(spark, values, column):
    return [r[0] for r in strings(spark, values).select(column(F.col("v"))).collect()]


def test_whitespace_is_pythons():
    assert set(SPACES) == {chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()}


@settings(max_examples=3, deadline=None)
@given(values=st.lists(ODD, min_size=200, max_size=300))
def test_strip_split_and_last_field(spark, values):
    assert apply(spark, values, text.strip) == [v.strip() for v in values]
    expected = [v.split()[-1] if len(v.split()) >= 2 else "" for v in values]
    assert apply(spark, values, text.last_field) == expected
    got = parse_manifest(strings(spark, values).withColumnRenamed("v", "value")).orderBy("i")
    wanted = []
    for i, value in enumerate(values):
        parts = value.strip().split(maxsplit=1)
        if value.strip() and not value.strip().startswith("#") and len(parts) == 2:
            wanted.append((i, *parts, parts[1].endswith("|")))
    assert [(r.i, r.utt, r.src, r.is_command) for r in got.collect()] == wanted


def test_profile_counts_two_comment_rules(spark):
    lines = ["# a", "  # b", "", " \t", "u p", "u", "u cat x |", "　"]
    row = manifest_profile(strings(spark, lines).withColumnRenamed("v", "value")).first()
    assert row.asDict() == {
        "total": 8, "blank": 3, "comment": 2, "malformed": 1, "entries": 2, "progress_total": 3, "split_total": 5,
    }


def test_stem(spark):
    paths = ["/a/b.c.wav", "/a/.hidden", "/a/x", "x.flac", "/a.b/c", "/a/.b.wav", "/a/b..wav", "/a/dir/", "a b.wav", "/a/…é.mp3"]
    assert apply(spark, paths, text.utt_from_path) == [PurePosixPath(p).stem for p in paths]


def test_one_line(spark):
    captions = [" a\nb  ", "\n", "x\r\ty", "\x1cq\x85"]
    assert apply(spark, captions, text.one_line_caption) == [c.replace("\n", " ").strip() for c in captions]
    assert apply(spark, ["a\tb\rc"], lambda c: text.one_line_caption(c, clean=True)) == ["a b c"]


def test_labels(spark):
    errors = ["e" * 60, "e" * 61, "x" * 150]
    assert apply(spark, errors, lambda c: text.error_label(text.error_type(c))) == ["e" * 60, "e" * 60 + "...", "x" * 60 + "..."]
    df = spark.createDataFrame([(1800.0,), (7200.0,), (172800.0,)], "s double")
    assert [r[0] for r in df.select(text.eta_label(F.col("s"))).collect()] == ["30 minutes", "2.0 hours", "2.0 days"]


def test_mime_by_extension(spark):
    cases = {
        "/a/x.FLAC": "audio/flac", "a.wav": "audio/x-wav", "a.opus": "audio/ogg", "a.m4a": "audio/mp4", "a.mp4": "video/mp4",
        "a.txt": "text/plain", "a.unknown": "audio/wav", "a": "audio/wav", ".wav": "audio/wav", "cat a.mp3 |": "audio/wav",
        "a.wav.gz": "audio/x-wav", "/x.mp3/a": "audio/wav", "a.json": "application/json",
    }
    assert apply(spark, list(cases), payload.mime_by_extension) == list(cases.values())


def test_mime_by_magic(spark):
    cases = [
        (b"fLaC..", "audio/flac"), (b"ID3", "audio/mpeg"), (b"\xff\xfb", "audio/mpeg"), (b"\xff", "audio/wav"), (b"OggS", "audio/ogg"),
        (b"RIFF1234WAVE", "audio/wav"), (b"ftypx", "audio/mp4"), (b"\0\0\0\x1cftyp", "audio/wav"), (b"", "audio/wav"),
    ]
    df = spark.createDataFrame([(i, bytearray(b)) for i, (b, _) in enumerate(cases)], "i int, v binary").orderBy("i")
    assert [r[0] for r in df.select(payload.mime_by_magic(F.col("v"))).collect()] == [m for _, m in cases]
    loose = df.where("i = 7").select(payload.mime_by_magic(F.col("v"), strict=False)).first()[0]
    assert loose == "audio/mp4"


def test_data_url_and_request(spark):
    data = bytes(range(256)) * 3
    df = spark.createDataFrame([(bytearray(data),)], "v binary")
    for chunked in ("true", "false"):
        spark.conf.set("spark.sql.chunkBase64String.enabled", chunked)
        url = df.select(payload.data_url(F.col("v"), F.lit("audio/wav"))).first()[0]
        assert url == "data:audio/wav;base64," + base64.b64encode(data).decode()
    spark.conf.unset("spark.sql.chunkBase64String.enabled")
    request = json.loads(df.select(payload.build_request(F.lit('u"é'), "m", 0.5, 200)).first()[0])
    assert request == {
        "model": "m",
        "messages": [{"role": "user", "content": [{"type": "audio_url", "audio_url": {"url": 'u"é'}}]}],
        "temperature": 0.5,
        "max_tokens": 200,
    }


def test_response(spark):
    bodies = [
        '{"choices": [{"message": {"content": "a"}}], "usage": {"t": 1, "d": {"x": null}}}', '{"choices": [{"message": {"content": "a"}}]}',
        '{"choices": []}', '{"error": 1}', "not json", '{"choices": [{"message": {"content": null}}]}',
    ]
    got = [tuple(r[0]) for r in strings(spark, bodies).select(payload.parse_response(F.col("v"))).collect()]
    assert [g[0] for g in got] == ["a", "a", None, None, None, None]
    assert json.loads(got[0][1]) == {"t": 1, "d": {"x": None}} and got[1][1] == "{}"


def test_flac_header(spark):
    rate, channels, bits, samples = 44100, 2, 24, (1 << 36) - 5
    word = (rate << 44) | ((channels - 1) << 41) | ((bits - 1) << 36) | samples
    head = b"fLaC" + b"\0\0\0\x22" + b"\0" * 10 + word.to_bytes(8, "big") + b"\0" * 16
    df = spark.createDataFrame([(bytearray(head),), (bytearray(head[:20]),)], "v binary")
    rows = [tuple(r[0]) for r in df.select(payload.flac_stream_info(F.col("v"))).collect()]
    assert rows == [(rate, channels, samples), (None, None, None)]
