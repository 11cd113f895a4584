"""One record per key out of many attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ok_filter(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == "ok")


def _rank(pos: str, prefer_success: bool) -> Column:
    """Largest for the record to keep: the first ok, else the last of all."""
    last = F.col(pos).cast("bigint")
    if not prefer_success:
        return last
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    return F.struct(ok, F.when(ok, -last).otherwise(last))


def merge_counted(
    log: DataFrame, key: str = "utt", pos: str = "pos", prefer_success: bool = True
) -> DataFrame:
    """The record to keep per key and `attempts`, the number of its records.

    A single `max_by` keeps one record in the aggregation buffer, and the map side
    already reduces a hot key to one row per task. Records without key share a row.
    """
    record = F.struct(*[c for c in log.columns if c != key])
    return (
        log.groupBy(key)
        .agg(F.max_by(record, _rank(pos, prefer_success)).alias("_r"), F.count("*").alias("attempts"))
        .select(key, "_r.*", "attempts")
        .select(*log.columns, "attempts")
    )


def merge_results(
    log: DataFrame, key: str = "utt", pos: str = "pos", prefer_success: bool = True
) -> DataFrame:
    """The first ok record of a key, else its last record; rows without key are dropped."""
    return merge_counted(log.where(F.col(key).isNotNull()), key, pos, prefer_success).drop("attempts")


def _total(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)


def counted_stats(counted: DataFrame, key: str = "utt") -> DataFrame:
    """One row of counters over `merge_counted`."""
    keyed = F.col(key).isNotNull()
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    return counted.agg(
        F.count_if(keyed).alias("unique_keys"),
        F.count_if(keyed & ok).alias("successful"),
        F.count_if(keyed & ~ok).alias("failed"),
        _total(F.when(keyed, F.col("attempts") - 1), "duplicates_resolved"),
        _total(F.when(~keyed, F.col("attempts")), "missing_key"),
    )


def merge_stats(
    log: DataFrame, key: str = "utt", pos: str = "pos", prefer_success: bool = True
) -> DataFrame:
    """One row of counters over the merge, without carrying its records."""
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    chosen_ok = F.max(ok) if prefer_success else F.max_by(ok, F.col(pos))
    per_key = log.groupBy(key).agg(F.count("*").alias("attempts"), chosen_ok.alias("_ok"))
    return counted_stats(per_key.withColumn("status", F.when(F.col("_ok"), "ok")), key)


def distinct_keys(log: DataFrame, key: str = "utt") -> DataFrame:
    return log.select(key).where(F.col(key).isNotNull()).distinct()


def sorted_keys(merged: DataFrame, key: str = "utt") -> DataFrame:
    """Range sort; UTF-8 byte order is code point order, integers sort as numbers."""
    return merged.orderBy(key)


def union_logs(*logs: DataFrame, pos: str = "pos") -> DataFrame:
    """Logs in argument order; positions of a later log follow those of the earlier."""
    out, base = None, F.lit(0).cast("bigint")
    for log in logs:
        moved = log.withColumn(pos, F.col(pos) + base)
        out = moved if out is None else out.unionByName(moved, allowMissingColumns=True)
        base = base + log.agg(F.coalesce(F.max(pos) + 1, F.lit(0))).scalar()
    return out
