"""Result logs: reading, bad lines, latest run, writing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.functions.text import one_line_caption, strip
from harkline.operators.merge import ok_filter, sorted_keys
from harkline.sources.files import existing, read_lines

#: Typed columns of a result record, ok or failed, manifest or shard.
RECORD = {
    "utt": "string",
    "idx": "bigint",
    "status": "string",
    "caption": "string",
    "error": "string",
    "processing_time": "double",
    "retry_attempt": "bigint",
    "audio_duration": "double",
    "audio_duration_error": "string",
    "usage": "string",
    "sample_rate": "bigint",
    "mime_type": "string",
    "compressed_size": "bigint",
    "sample_weight": "double",
    "ts": "timestamp",
}


def _parsed(lines: DataFrame, value: str, columns: Iterable[str]) -> DataFrame:
    """Stripped, not blank lines with `_rec`; null unless the line is one JSON object.

    Parsing the line as the only element of an array also rejects text after the
    object. All fields are read as text, so a value of another type spoils nothing;
    of a repeated field the last value counts.
    """
    shape = "array<struct<" + ", ".join(f"{n}: string" for n in columns) + ">>"
    whole = F.startswith(F.col(value), F.lit("{")) & F.endswith(F.col(value), F.lit("}"))
    records = F.from_json(
        F.concat(F.lit("["), F.col("raw"), F.lit("]")), shape, {"allowSingleQuotes": "false"}
    )
    return (
        lines.withColumn("raw", F.when(whole, F.col(value)).otherwise(strip(F.col(value))))
        .where("raw != ''")
        # filters on the records must not copy the parse: they stop at a generator
        .select("*", F.explode(F.array(records)).alias("_recs"))
        .withColumn("_rec", F.when(F.size("_recs") == 1, F.get("_recs", F.lit(0))))
    )


def parse_results(
    lines: DataFrame, value: str = "value", columns: Iterable[str] | None = None
) -> DataFrame:
    """Typed record columns, `raw`, and every other column of `lines`.

    `columns` limits the fields taken from the JSON to those a report needs.
    """
    kept = [c for c in lines.columns if c not in (value, "raw")]
    wanted = {n: RECORD[n] for n in columns or RECORD}
    typed = [
        (F.col(f"_rec.{n}") if t == "string" else F.replace(F.col(f"_rec.{n}"), F.lit('"')).try_cast(t)).alias(n)
        for n, t in wanted.items()
    ]
    return _parsed(lines, value, wanted).where(F.col("_rec").isNotNull()).select(*typed, "raw", *kept)


def bad_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that are neither blank nor one JSON object."""
    kept = [c for c in lines.columns if c not in (value, "raw")]
    return _parsed(lines, value, ["status"]).where(F.col("_rec").isNull()).select("raw", *kept)


def read_results(
    spark: SparkSession, paths: str | Iterable[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """Records of JSON-lines logs (files, patterns or folders, searched to any depth)."""
    return parse_results(read_lines(spark, paths), columns=columns)


def latest_run(
    spark: SparkSession,
    path: str,
    prefix: str = "captions-arkive-",
    suffix: str = ".jsonl",
    fresh: str | None = None,
) -> DataFrame:
    """Newest log of a folder: (run_id, path, mtime).

    Where there is none: the id `fresh` without a path, or no row if none is given.
    """
    shape = "run_id string, path string, mtime timestamp"
    found = spark.createDataFrame([], shape)
    if existing(spark, path):
        run_id = F.regexp_extract("path", rf"/\Q{prefix}\E([^/]*)\Q{suffix}\E$", 1)
        listing = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*{suffix}").load(path)
        found = listing.select(run_id.alias("run_id"), "path", F.col("modificationTime").alias("mtime"))
    if fresh is not None:
        none = spark.range(1).select(F.lit(fresh).alias("run_id"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("timestamp").alias("mtime"))
        found = found.unionByName(none)
    return found.orderBy(F.desc_nulls_last("mtime"), "path").limit(1)


def latest_own_run(spark: SparkSession, path: str) -> DataFrame:
    """Newest run of a log that `write_results` wrote: (run_id, path, mtime); no row without one."""
    folders = f"{path.rstrip('/')}/run_id=*"
    if not existing(spark, folders):
        return spark.createDataFrame([], "run_id string, path string, mtime timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    return (
        files.select(
            F.url_decode(F.regexp_extract("path", r"/run_id=([^/]+)/", 1)).alias("run_id"),
            F.regexp_extract("path", r"^(.*/run_id=[^/]+)/", 1).alias("path"),
            F.col("modificationTime").alias("mtime"),
        )
        .groupBy("run_id", "path").agg(F.max("mtime").alias("mtime"))
        .orderBy(F.desc("mtime"), "path").limit(1)
    )


def log_span(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row `seconds`: from the start of the first pass to the last change of a log's files.

    Run ids of passes start with their time; a log without them starts with the first change.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(existing(spark, paths))
    at = F.unix_micros("modificationTime")
    started = F.try_to_number(F.regexp_extract("path", r"/run_id=(\d{13})-", 1), F.lit("9" * 13)).cast("bigint") * 1000
    return files.agg(((F.max(at) - F.min(F.coalesce(F.least(started, at), at))) / 1e6).alias("seconds"))


def record_json(df: DataFrame) -> Column:
    """One result record as JSON text; absent fields are left out, `usage` stays an object."""
    fields = []
    for name in RECORD:
        if name in df.columns:
            fields.append(F.try_parse_json("usage").alias("usage") if name == "usage" else F.col(name))
    return F.to_json(F.struct(*fields))


def write_results(records: DataFrame, path: str, run_id: str, chunk: str | None = None) -> None:
    """Append records under `run_id=/chunk_id=`; part files appear whole or not at all."""
    chunk_id = F.col(chunk) if chunk else F.lit(0)
    records.select(
        F.lit(run_id).alias("run_id"), chunk_id.alias("chunk_id"), record_json(records).alias("value")
    ).write.mode("append").partitionBy("run_id", "chunk_id").text(path)


def captions_tsv(log: DataFrame, key: str = "utt", clean: bool = False) -> DataFrame:
    caption = one_line_caption(F.coalesce("caption", F.lit("")), clean)
    keyed = ok_filter(log).where(F.col(key).isNotNull())
    return keyed.select(F.concat_ws("\t", F.col(key).cast("string"), caption).alias("value"))


def write_captions_tsv(log: DataFrame, path: str, key: str = "utt", clean: bool = False) -> None:
    """`key<TAB>caption` of the ok records, in the order of `log`."""
    captions_tsv(log, key, clean).write.text(path)


def write_merged(merged: DataFrame, path: str, tsv_path: str | None = None, key: str = "utt") -> None:
    """Merged records sorted by key: original lines, and the caption table if asked.

    Give a table that is cheap to read (`written`): sampling the sort bounds and each
    output read it again.
    """
    chosen = merged.select(key, "status", "caption", "raw")
    sorted_keys(chosen, key).select("raw").write.text(path)
    if tsv_path:
        write_captions_tsv(sorted_keys(ok_filter(chosen), key), tsv_path, key)
