"""Helpers the operators share: bounded Arrow batches, vectorised words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of text a task handles at a time; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

#: Rows of an Arrow batch of texts at most; the session's own bound stays if it is lower.
BATCH_ROWS = 1000

#: The six white-space bytes that end a word.
SPACE = b" \t\n\v\f\r"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE)] = True

#: Odd multiplier of the rolling word hash, and its inverse modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A 64-bit number for each byte value, so that words differ in all bits.
_BYTE_CODE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(frame: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """`mapInArrow` over rows that hold texts: batches of few rows, so that a task holds little text."""
    conf, name = frame.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return frame.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one piece holds at most `limit` bytes of `column`, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def texts_of(column: pa.Array) -> list[str]:
    """Texts as Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of the texts, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and the bytes of each row (null: 0)."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    return np.frombuffer(b"".join(bytes_of(column)), dtype=np.uint8), lengths


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    up, down = np.ones(count + 1, dtype=np.uint64), np.ones(count + 1, dtype=np.uint64)
    up[1:], down[1:] = _BASE, _BASE_INVERSE
    return np.cumprod(up, out=up), np.cumprod(down, out=down)


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept for the life of a worker up to one piece; longer ones are made for the call."""
    if count > 2 * PIECE_BYTES:
        return powers(count)
    if not _POWERS or len(_POWERS[0][0]) <= count:
        _POWERS[:] = [powers(max(count, PIECE_BYTES + (PIECE_BYTES >> 2)))]
    return _POWERS[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.view(np.uint8) << 5)


def word_bounds(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in joined texts, and the number of words of each text.

    A word is a longest run of bytes that are no white space; it ends with its text.
    """
    inside = ~_IS_SPACE[data]
    ends_at = np.cumsum(lengths)
    starts_at = ends_at - lengths
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    filled = lengths > 0
    first, last = starts_at[filled], ends_at[filled] - 1
    opens[first] = inside[first]
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    counts = np.searchsorted(starts, ends_at) - np.searchsorted(starts, starts_at)
    return starts, ends, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; equal words have equal hashes anywhere."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    value ^= (ends - starts).astype(np.uint64)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(29)
    return value


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of bytes and of long numbers as one compressed text; the numbers byte by byte, so that zeros meet."""
    parts = [a.tobytes() if a.dtype == np.uint8 else a.view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]
    raw = np.array([len(x) for x in parts], dtype=np.int64).tobytes() + b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes, kinds: str) -> list[np.ndarray]:
    """The arrays again; `kinds` has a letter for each: b (bytes) or n (numbers)."""
    raw = pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    at, out = 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(raw, dtype=np.int64, count=len(kinds)), kinds):
        part = np.frombuffer(raw, dtype=np.uint8, count=size, offset=at)
        out.append(part if kind == "b" else np.ascontiguousarray(part.reshape(8, -1).T).view(np.int64).reshape(-1))
        at += size
    return out


def each_group(group: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Groups of an ascending array, and where they stand."""
    if len(group) == 0:
        return
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    for a, b in zip(cuts, cuts[1:]):
        yield int(group[a]), slice(a, b)
