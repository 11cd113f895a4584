"""Payload bytes of manifest rows and header inventory of media files."""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harkline.functions.payload import flac_stream_info
from harkline.functions.text import is_command
from harkline.sources.files import open_file

_YIELD_BYTES = 32 << 20


def _riff(file, size: int) -> tuple[int, int, int]:
    """(sample rate, channels, frames) of a RIFF file, chunk by chunk."""
    at, layout = 12, None
    while True:
        file.seek(at)
        head = file.read(8)
        if len(head) < 8:
            raise ValueError("no data chunk")
        name, length = struct.unpack("<4sI", head)
        if name == b"fmt ":
            _, channels, rate, _, block = struct.unpack("<HHIIH", file.read(14))
            layout = (rate, channels, block)
        elif name == b"data":
            if layout is None or layout[2] == 0:
                raise ValueError("no format before data")
            return layout[0], layout[1], min(length, max(size - at - 8, 0)) // layout[2]
        at += 8 + length + length % 2


@F.pandas_udf(T.DoubleType())
def _riff_seconds(content: pd.Series) -> pd.Series:
    def seconds(data: bytes | None) -> float | None:
        try:
            rate, _, frames = _riff(io.BytesIO(data), len(data))
            return frames / rate
        except (TypeError, ValueError, struct.error, ZeroDivisionError):
            return None

    return content.map(seconds).astype("float64")


def content_duration(content: Column) -> Column:
    """Seconds of FLAC or RIFF bytes held in a column; null where no header gives them."""
    info = flac_stream_info(content)
    flac = F.substring(content, 1, 4) == F.lit(b"fLaC")
    riff = F.substring(content, 1, 4) == F.lit(b"RIFF")
    from_flac = F.when(flac, info["samples"] / F.nullif(info["sample_rate"], F.lit(0)))
    return F.coalesce(from_flac, _riff_seconds(F.when(riff, content)))


_PROBE = {"_head": T.BinaryType(), "_rate": T.LongType(), "_channels": T.LongType(), "_frames": T.LongType(), "_problem": T.StringType()}


def _probe(file) -> tuple:
    """First bytes and, for RIFF, the fields found by walking its chunks."""
    head = file.read(64)
    fields, problem = (None, None, None), None
    if head[:4] == b"RIFF" and head[8:12] == b"WAVE":
        try:
            fields = _riff(file, file.seek(0, io.SEEK_END))
        except (ValueError, struct.error) as failure:
            problem = _named(failure)
    return (head, *fields, problem)


def _named(failure: Exception) -> str:
    return f"{type(failure).__name__}: {str(failure)[:50]}"


def _opened(src: str):
    if src.endswith("|"):
        raise ValueError("command sources are not run")
    return open_file(src)


_ARROW = {T.BinaryType(): pa.binary(), T.StringType(): pa.string(), T.LongType(): pa.int64()}


def _with_columns(batch: pa.RecordBatch, extra: dict[str, T.DataType], rows: list[tuple]) -> pa.RecordBatch:
    """The batch as it is, with new columns at its end."""
    more = [pa.array([r[i] for r in rows], _ARROW[kind]) for i, kind in enumerate(extra.values())]
    return pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *extra])


def _schema(items: DataFrame, extra: dict[str, T.DataType]) -> T.StructType:
    return T.StructType(items.schema.fields + [T.StructField(n, t) for n, t in extra.items()])


def _load(batches: Iterator[pa.RecordBatch], src_col: str, extra: dict[str, T.DataType], probe: bool) -> Iterator[pa.RecordBatch]:
    nothing = (None,) * len(_PROBE) if probe else ()
    for batch in batches:
        done, rows, held = 0, [], 0
        for at, src in enumerate(batch[src_col].to_pylist(), 1):
            try:
                with _opened(src) as file:
                    content = file.read()
                rows.append((content, None, *(_probe(io.BytesIO(content)) if probe else ())))
                held += len(content)
            except Exception as failure:
                rows.append((None, str(failure), *nothing))
            if held >= _YIELD_BYTES or at == batch.num_rows:
                yield _with_columns(batch.slice(done, at - done), extra, rows)
                done, rows, held = at, [], 0


def load_payload(items: DataFrame, src_col: str = "src", probe: bool = False) -> DataFrame:
    """Whole file bytes per row: + content, load_error. An unreadable file fails its row.

    `probe` adds audio_duration and audio_duration_error from the bytes at hand.
    """
    extra = {"content": T.BinaryType(), "load_error": T.StringType(), **(_PROBE if probe else {})}
    loaded = items.mapInArrow(lambda it: _load(it, src_col, extra, probe), _schema(items, extra))
    if not probe:
        return loaded
    found = _found()
    return loaded.select(
        *items.columns,
        "content",
        "load_error",
        found["audio_duration"].alias("audio_duration"),
        found["audio_duration_error"].alias("audio_duration_error"),
    )


def _found() -> dict[str, Column]:
    """Header columns over the fields of `_probe`; FLAC fields are column expressions."""
    head = F.col("_head")
    flac = F.substring(head, 1, 4) == F.lit(b"fLaC")
    riff = (F.substring(head, 1, 4) == F.lit(b"RIFF")) & (F.substring(head, 9, 4) == F.lit(b"WAVE"))
    info = flac_stream_info(head)

    def either(flac_field: str, riff_field: str) -> Column:
        return F.when(flac, info[flac_field]).when(riff, F.col(riff_field))

    rate = either("sample_rate", "_rate")
    seconds = either("samples", "_frames") / F.nullif(rate, F.lit(0))
    reason = F.concat(F.lit("error: "), F.coalesce("_problem", F.lit("ValueError: no duration in header")))
    return {
        "container": F.when(flac, "flac").when(riff, "wav").otherwise("other"),
        "sample_rate": rate,
        "channels": either("channels", "_channels").cast("bigint"),
        "audio_duration": seconds,
        "audio_duration_error": F.when(seconds.isNull(), reason),
    }


def _heads(batches: Iterator[pa.RecordBatch], src_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for src in batch[src_col].to_pylist():
            try:
                with _opened(src) as file:
                    rows.append(_probe(file))
            except Exception as failure:
                rows.append((b"", None, None, None, _named(failure)))
        yield _with_columns(batch, _PROBE, rows)


def audio_probe(items: DataFrame, src_col: str = "src") -> DataFrame:
    """Header inventory: + container, sample_rate, channels, audio_duration, audio_duration_error.

    Tasks read only headers. FLAC fields are column expressions over the first bytes;
    RIFF chunks are walked in the task. Other containers have no duration.
    """
    heads = items.mapInArrow(lambda it: _heads(it, src_col), _schema(items, _PROBE))
    found = _found()
    found["audio_duration_error"] = F.when(is_command(F.col(src_col)), "pipe_command").otherwise(
        found["audio_duration_error"]
    )
    return heads.select(*items.columns, *[c.alias(n) for n, c in found.items()])


def probe_summary(probed: DataFrame, *by: str) -> DataFrame:
    """Files, hours and failures per group of a probed collection."""
    return probed.groupBy(*(by or ("container",))).agg(
        F.count("*").alias("files"),
        F.count("audio_duration").alias("with_duration"),
        (F.coalesce(F.sum("audio_duration"), F.lit(0.0)) / 3600).alias("audio_hours"),
    )
