"""Cutting an indexed collection into chunks and index ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_slice(df: DataFrame, start: int = 0, end: int | None = None, idx: str = "idx") -> DataFrame:
    """Rows with start <= idx < end; an empty range gives nothing."""
    out = df.where(F.col(idx) >= start)
    return out if end is None else out.where(F.col(idx) < end)


def _chunk_shape(total: Column, chunks: int) -> tuple[Column, Column]:
    """(number of jobs, rows per job) for a total: jobs never exceed rows."""
    jobs = F.greatest(F.least(F.lit(chunks), total), F.lit(1))
    return jobs, F.ceil(total / jobs)


def assign_chunks(df: DataFrame, chunks: int, base: str = "manifest", idx: str = "idx") -> DataFrame:
    """Contiguous chunks of equal size; the last may be short and some may not exist."""
    if chunks < 1:
        raise ValueError("the number of chunks must be positive")
    total = df.agg(F.count("*")).scalar()
    _, size = _chunk_shape(total, chunks)
    return df.withColumn("chunk_id", F.floor(F.col(idx) / size).cast("int")).withColumn(
        "chunk_name", chunk_name(base, F.col("chunk_id"))
    )


def chunk_name(base: str, chunk_id: Column) -> Column:
    return F.format_string(f"{base.replace('%', '%%')}_chunk_%04d", chunk_id)


def chunk_ranges(df: DataFrame, chunks: int) -> DataFrame:
    """The same arithmetic as `[start, end)` rows over the row count of `df`."""
    if chunks < 1:
        raise ValueError("the number of chunks must be positive")
    jobs, size = _chunk_shape(F.col("total"), chunks)
    chunk = F.col("chunk_id")
    return (
        df.agg(F.count("*").alias("total"))
        .where("total > 0")
        .select("total", size.alias("size"), F.explode(F.sequence(F.lit(0), (jobs - 1).cast("int"))).alias("chunk_id"))
        .select(
            "chunk_id",
            (chunk * F.col("size")).alias("start_idx"),
            F.least((chunk + 1) * F.col("size"), "total").alias("end_idx"),
            "total",
        )
        .where("start_idx < total")
        .select(
            "chunk_id",
            "start_idx",
            "end_idx",
            F.concat_ws("_", F.lit("ark_chunk"), "chunk_id", "start_idx", "end_idx").alias("run_id"),
        )
    )


def chunk_summary(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("chunk_id").agg(F.count("*").alias("lines"))
