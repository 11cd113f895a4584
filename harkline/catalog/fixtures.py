"""Inputs of the registered queries, derived from the given tables.

Each SQL text runs unchanged in Spark and in DuckDB.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.session import local_path, scratch_path
from harkline.sources.manifest import SUBSETS

MANIFEST_LINES = r"""
SELECT page_id AS pos,
  CASE page_id % 10
    WHEN 0 THEN '# ' || url
    WHEN 1 THEN ''
    WHEN 2 THEN '   # ' || url
    WHEN 3 THEN 'u' || CAST(page_id AS STRING)
    WHEN 4 THEN '  u' || CAST(page_id AS STRING) || '   ' || url || '  '
    WHEN 5 THEN 'u' || CAST(page_id AS STRING) || chr(9) || 'cat ' || url || ' |'
    WHEN 6 THEN 'u' || CAST(page_id AS STRING) || ' /dir with space/' || CAST(page_id AS STRING) || '.flac'
    ELSE 'u' || CAST(page_id AS STRING) || ' ' || url END AS value
FROM pages
"""

RUN_LOG = r"""
SELECT event_id AS pos,
  CASE WHEN event_id % 97 = 0 THEN NULL
       ELSE CAST(user_id % 50 AS STRING) || '-' || regexp_extract(props, '([0-9]+)', 1) END AS utt,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'ok'
       WHEN event_id % 41 = 0 THEN 'skipped' ELSE 'fail' END AS status,
  CASE WHEN event_type IN ('click', 'purchase') THEN event_type || chr(10) || 'n ' || CAST(event_id AS STRING) || ' ' END AS caption,
  CASE WHEN event_type IN ('click', 'purchase') THEN NULL WHEN event_id % 23 = 0 THEN NULL
       ELSE event_type || ': code ' || CAST(event_id % 8 AS STRING) END AS error,
  value AS processing_time,
  CASE WHEN event_type = 'signup' THEN NULL ELSE 1 + event_id % 4 END AS retry_attempt,
  CASE WHEN event_type NOT IN ('click', 'purchase') OR event_id % 7 = 0 THEN NULL
       WHEN event_id % 11 = 0 THEN CAST(0 AS DOUBLE) ELSE value * 3 END AS audio_duration,
  CASE WHEN event_type IN ('click', 'purchase') AND event_id % 7 = 0 THEN 'error: RuntimeError: bad header ' || CAST(event_id % 3 AS STRING) END AS audio_duration_error,
  ts
FROM events
"""

SHARD_INDEX = r"""
SELECT doc_id, CAST(floor(doc_id / 256) AS BIGINT) AS bin_index,
  CAST(COALESCE(SUM(CAST(bit_length(text) / 8 AS BIGINT)) OVER (PARTITION BY CAST(floor(doc_id / 256) AS BIGINT) ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_byte_offset,
  CAST(bit_length(text) / 8 AS BIGINT) AS file_size_bytes,
  CASE WHEN doc_id % 9 = 0 THEN NULL ELSE 16000 * (1 + doc_id % 3) END AS sample_rate,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 1 + doc_id % 2 END AS channels
FROM documents
"""

PAYLOADS = r"""
SELECT doc_id,
  unhex(CASE doc_id % 8
    WHEN 0 THEN '664C6143' WHEN 1 THEN '494433' WHEN 2 THEN 'FFFB' WHEN 3 THEN '4F676753'
    WHEN 4 THEN '524946460000000057415645' WHEN 5 THEN '66747970' WHEN 6 THEN '0000001C66747970'
    ELSE '' END || hex(text)) AS content,
  '/d/' || CAST(doc_id AS STRING) || CASE doc_id % 7
    WHEN 0 THEN '.flac' WHEN 1 THEN '.WAV' WHEN 2 THEN '.mp3' WHEN 3 THEN '.ogg'
    WHEN 4 THEN '.b.wav' WHEN 5 THEN '' ELSE '.m4a' END AS path
FROM documents
"""

METRIC_LINES = r"""
SELECT CAST(floor(event_id / 8) AS BIGINT) AS snapshot_id, event_id AS pos,
  CASE event_id % 8
    WHEN 0 THEN '# HELP vllm:num_requests_running Number of requests'
    WHEN 1 THEN 'vllm:num_requests_running{engine="0"} ' WHEN 2 THEN 'vllm:num_requests_waiting{engine="0"} '
    WHEN 3 THEN 'vllm:num_requests_swapped{engine="0"} ' WHEN 4 THEN 'vllm:gpu_cache_usage_perc{engine="0"} '
    WHEN 5 THEN 'vllm:avg_generation_throughput_toks_per_s{engine="0"} '
    WHEN 6 THEN 'vllm:avg_prompt_throughput_toks_per_s{engine="0"} '
    ELSE 'vllm:num_requests_waiting{engine="1"} ' END
  || CASE WHEN event_id % 8 = 0 THEN '' ELSE CAST(CAST(floor(value * 20) AS BIGINT) AS STRING) || '.0' END AS line
FROM events
"""

GPU_LINES = r"""
SELECT event_id AS pos,
  CASE WHEN event_id % 13 = 0 THEN CAST(event_id % 100 AS STRING) || ', 1'
  ELSE CAST((event_id * 7) % 101 AS STRING) || ', ' || CAST((event_id * 911) % 143771 AS STRING) || ', 143771, ' || CAST(40 + event_id % 50 AS STRING) END AS line
FROM events
"""

RESULT_LINES = r"""
SELECT event_id AS pos,
  CASE event_id % 12
    WHEN 0 THEN '' WHEN 1 THEN '{"utt": "u' || CAST(event_id AS STRING) || '", "status": "o'
    WHEN 2 THEN '["u' || CAST(event_id AS STRING) || '"]' WHEN 3 THEN '{"utt": ' || CAST(user_id AS STRING) || ', "status": "ok"}'
    WHEN 4 THEN '{"status": "fail", "error": "x"}'
    WHEN 5 THEN '{"utt": "a", "utt": "u' || CAST(user_id AS STRING) || '", "status": "ok"}'
    WHEN 6 THEN '{"utt": "u' || CAST(user_id AS STRING) || '", "status": "fail", "error": "e", "retry_attempt": 2}'
    ELSE '{"utt": "u' || CAST(user_id AS STRING) || '", "status": "ok", "caption": "c' || CAST(event_id AS STRING) || '", "usage": {"total_tokens": ' || CAST(event_id % 400 AS STRING) || '}}' END AS value
FROM events
"""

RESPONSES = r"""
SELECT event_id AS pos,
  CASE event_id % 6
    WHEN 0 THEN '{"error": "busy"}' WHEN 1 THEN '{"choices": []}'
    WHEN 2 THEN '{"choices": [{"message": {"content": null}}]}'
    WHEN 3 THEN '{"choices": [{"message": {"content": "' || event_type || '"}}]}'
    ELSE '{"choices": [{"message": {"content": "' || event_type || '"}}], "usage": {"total_tokens": ' || CAST(event_id AS STRING) || '}}' END AS body
FROM events
"""

# Manifest rows of keys of which some are in the log, some repeat and some are new.
MANIFEST_ITEMS = r"""
SELECT event_id AS pos,
  CAST(user_id % 60 AS STRING) || '-' || regexp_extract(props, '([0-9]+)', 1) AS utt,
  '/a/' || CAST(event_id AS STRING) || '.flac' AS src
FROM events
"""

# The run log as JSON lines.
LOG_LINES = rf"""
SELECT pos,
  '{{' || CASE WHEN utt IS NULL THEN '' ELSE '"utt": "' || utt || '", ' END
  || CASE WHEN status = 'ok' THEN '"caption": "c' || CAST(pos AS STRING) || '", ' ELSE '' END
  || CASE WHEN retry_attempt IS NULL THEN '' ELSE '"retry_attempt": ' || CAST(retry_attempt AS STRING) || ', ' END
  || '"status": "' || status || '"}}' AS value
FROM ({RUN_LOG}) AS log
"""

# A media tree: subset/speaker/chapter/name, six kinds of suffix, names with two dots.
MEDIA_FILES = r"""
SELECT doc_id, subset,
  subset || '/' || CAST(doc_id % 40 AS STRING) || '/' || CASE WHEN doc_id % 11 = 3 THEN 'part ' ELSE '' END
    || CAST(doc_id % 11 AS STRING) || '/' || stem || ext AS name,
  stem, ext,
  CASE WHEN ext IN ('.flac', '.FLAC') THEN 'flac' WHEN ext = '.wav' THEN 'wav' ELSE 'other' END AS container,
  16000 * (1 + doc_id % 3) AS rate, 1 + doc_id % 2 AS ch, n_chars * 160 AS samples, text
FROM (SELECT doc_id, text, n_chars,
  CASE doc_id % 7 {subsets} END AS subset,
  CAST(doc_id AS STRING) || '-' || CAST(n_chars AS STRING) || CASE WHEN doc_id % 5 = 0 THEN '.b' ELSE '' END AS stem,
  CASE doc_id % 6 WHEN 1 THEN '.wav' WHEN 3 THEN '.mp3' WHEN 4 THEN '.FLAC' ELSE '.flac' END AS ext
  FROM documents) AS d
""".replace("{subsets}", " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUBSETS)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a fixture text over the tables of one folder."""
    for name in set(re.findall(r"FROM (events|documents|pages)\b", sql)):
        view = f"fx_{name}"
        table(spark, sf_dir, name).createOrReplaceTempView(view)
        sql = re.sub(rf"FROM {name}\b", f"FROM {view}", sql)
    return spark.sql(sql)


def write_lines(df: DataFrame, order: str, name: str) -> str:
    """Text files of `value` whose names and lines follow `order`."""
    path = scratch_path(df.sparkSession, name)
    df.orderBy(order).select("value").write.text(path)
    return path


def _put(path: str, contents: Iterable[pa.Buffer]) -> None:
    """A file appears whole; a repeated task writes the same bytes again."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{os.getpid()}.part"
    with open(part, "wb") as file:
        for content in contents:
            file.write(content)
    os.replace(part, path)


#: Rows of one batch of contents: a task holds so many, however large the table is.
_BATCH_ROWS = 100


def _each_content(df: DataFrame, put: Callable[[Iterator[pa.RecordBatch]], int]) -> None:
    """Run `put` over the rows of each task in small batches."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"n": [put(batches)]})

    conf.set(name, str(_BATCH_ROWS))
    try:
        df.mapInArrow(run, "n bigint").agg(F.sum("n")).collect()
    finally:
        conf.set(name, before)


def write_files(df: DataFrame, root: str) -> None:
    """One file per row of (name, content) below the shared folder `root`."""
    base = local_path(root)

    def put(batches: Iterator[pa.RecordBatch]) -> int:
        n = 0
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                _put(f"{base}/{name}", [content.as_buffer()])
                n += 1
        return n

    _each_content(df.select("name", "content"), put)


def write_joined(df: DataFrame, root: str) -> None:
    """One file per `name` below the shared folder `root`: its contents one after the other.

    Rows of a name are in one task and follow each other there. A null content takes no bytes.
    """
    base = local_path(root)

    def put(batches: Iterator[pa.RecordBatch]) -> int:
        rows = (row for batch in batches for row in zip(batch["name"], batch["content"]))
        n = 0
        for name, parts in groupby(rows, lambda row: row[0].as_py()):
            _put(f"{base}/{name}", (content.as_buffer() for _, content in parts if content.is_valid))
            n += 1
        return n

    _each_content(df.select("name", "content"), put)


def little_endian(value: Column, width: int) -> Column:
    """Hex digits of a number, lowest byte first."""
    parts = [F.lpad(F.hex(F.pmod(F.shiftright(value.cast("bigint"), 8 * i), F.lit(256))), 2, "0") for i in range(width)]
    return F.concat(*parts)


def media_content() -> Column:
    """FLAC and RIFF bytes around the text; the RIFF has an odd chunk before its data."""
    rate, ch, samples = F.col("rate"), F.col("ch"), F.col("samples")
    packed = F.concat(
        F.lpad(F.hex(rate.cast("bigint")), 5, "0"),
        F.hex(((ch - 1) * 2).cast("bigint")),
        F.lit("F"),
        F.lpad(F.hex(samples.cast("bigint")), 9, "0"),
    )
    flac = F.concat(F.lit("664C614300000022" + "00" * 10), packed, F.lit("00" * 16))
    size = F.octet_length("text")
    block = little_endian(F.lit(1), 2)
    riff = F.concat(
        F.lit("52494646"), little_endian(size + 48, 4), F.lit("57415645"),
        F.lit("666D7420"), little_endian(F.lit(16), 4), little_endian(F.lit(1), 2), little_endian(F.lit(1), 2),
        little_endian(rate, 4), little_endian(rate, 4), block, little_endian(F.lit(8), 2),
        F.lit("4C495354"), little_endian(F.lit(3), 4), F.lit("61626300"),
        F.lit("64617461"), little_endian(size, 4),
    )
    head = F.when(F.col("container") == "flac", flac).when(F.col("container") == "wav", riff).otherwise("")
    return F.unhex(F.concat(head, F.hex("text")))


_made: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """A folder made once per application and table folder."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _made:
        root = scratch_path(spark, name)
        make(root)
        _made[at] = root
    return _made[at]


def media_tree(spark: SparkSession, sf_dir: str) -> str:
    def make(root: str) -> None:
        write_files(fixture(spark, sf_dir, MEDIA_FILES).withColumn("content", media_content()), root)

    return _once(spark, sf_dir, "media", make)


#: Files of one folder of payloads at most: a folder takes one new name at a time.
_FOLDER_FILES = 512


def payload_name() -> Column:
    """Where the file of a row of PAYLOADS stands below `payload_files`."""
    return F.concat(F.expr(f"CAST(floor(doc_id / {_FOLDER_FILES}) AS STRING)"), F.lit("/"), F.expr("substring(path, 4)"))


def payload_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of PAYLOADS, except every 17th."""
    def make(root: str) -> None:
        rows = fixture(spark, sf_dir, PAYLOADS).where("doc_id % 17 != 0")
        write_files(rows.withColumn("name", payload_name()), root)

    return _once(spark, sf_dir, "payloads", make)


def shard_folder(spark: SparkSession, sf_dir: str) -> str:
    """Index file and shard blobs; a shard holds 256 documents at most."""
    def make(root: str) -> None:
        index = fixture(spark, sf_dir, SHARD_INDEX)
        index.withColumn("note", F.lit("not read")).write.parquet(f"{root}/metadata.parquet")
        # the texts move once, as they are: the order of the offsets is that of falling doc_id
        shard = F.floor(F.col("doc_id") / 256)
        texts = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select(
            shard.alias("bin_index"), "doc_id", F.col("text").cast("binary").alias("content")
        )
        placed = texts.repartition("bin_index").sortWithinPartitions("bin_index", F.desc("doc_id"))
        write_joined(placed.select(F.format_string("arkive_%06d.bin", "bin_index").alias("name"), "content"), root)

    return _once(spark, sf_dir, "shards", make)
