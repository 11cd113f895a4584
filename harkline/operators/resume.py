"""Resume: what earlier runs finished, what is left, what has run out of retries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harkline.operators.ordering import position_block

MAX_RETRIES = 3

#: Log positions per first-level group of a key. Larger than the blocks of running
#: totals: the second level holds one row per key and block.
FOLD_BLOCK = 1 << 22


def resume_state(
    log: DataFrame, key: str = "utt", pos: str = "pos", block: int = FOLD_BLOCK
) -> DataFrame:
    """Per key: `done` (ever ok) and `retry` (attempts used since the last ok).

    Rows fold in log order: ok sets the counter to 0, a failure with `retry_attempt`
    sets it to that number, a failure without adds 1. So the counter is the value of
    the last setting row plus the plain failures after it. Folding goes through
    (key, position block) first: one key may hold most of the log, and the blocks
    bound both the first groups and the number of partial rows per key.
    """
    attempt = F.col("retry_attempt").cast("bigint")
    ok = F.col("status") == "ok"
    rows = log.where(F.col("status").isin("ok", "fail")).select(
        F.col(key),
        F.col(pos).alias("_pos"),
        position_block(pos, block).alias("_block"),
        ok.alias("_ok"),
        F.when(ok, F.lit(0)).otherwise(attempt).cast("bigint").alias("_set"),
    )
    last_set = F.max(F.when(F.col("_set").isNotNull(), F.col("_pos")))
    plain_after = F.col("_set").isNull() & (F.col("_pos") > F.coalesce(F.col("_last"), F.lit(-1)))
    partial = (
        rows.withColumn("_last", last_set.over(Window.partitionBy(key, "_block")))
        .groupBy(key, "_block")
        .agg(
            F.max("_ok").alias("_ok"),
            F.max("_last").alias("_last"),
            F.max_by("_set", F.when(F.col("_set").isNotNull(), F.col("_pos"))).alias("_set"),
            F.count_if(plain_after).alias("_plain"),
            F.min("_pos").alias("_first"),
        )
    )
    counts = (F.col("_last") == F.col("_final")) | (
        F.col("_last").isNull() & (F.col("_first") > F.coalesce(F.col("_final"), F.lit(-1)))
    )
    return (
        partial.withColumn("_final", F.max("_last").over(Window.partitionBy(key)))
        .groupBy(key)
        .agg(
            F.max("_ok").alias("done"),
            (
                F.coalesce(F.max_by("_set", "_last"), F.lit(0))
                + F.coalesce(F.sum(F.when(counts, F.col("_plain"))), F.lit(0))
            )
            .cast("bigint")
            .alias("retry"),
        )
    )


def _with_state(items: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Items with the state of their key. Adaptive execution splits a hot key's items."""
    joined = items.join(state.where(F.col(key).isNotNull()), key, "left")
    return joined.withColumn("done", F.coalesce("done", F.lit(False))).withColumn(
        "retry", F.coalesce("retry", F.lit(0))
    )


def pending(
    items: DataFrame,
    state: DataFrame,
    key: str = "utt",
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Items neither done nor out of retries, with the number of the next attempt."""
    return (
        _with_state(items, state, key)
        .where(~F.col("done") & (F.col("retry") < max_retries))
        .select(*items.columns, (F.col("retry") + 1).alias("retry_attempt"))
    )


def exhausted_items(
    items: DataFrame, state: DataFrame, key: str = "utt", max_retries: int = MAX_RETRIES
) -> DataFrame:
    """Items at the retry limit, whether or not they were ever done."""
    at_limit = state.where((F.col("retry") >= max_retries) & F.col(key).isNotNull()).select(key)
    return items.join(at_limit, key, "left_semi").select(*items.columns)


def resume_report(
    items: DataFrame, state: DataFrame, key: str = "utt", max_retries: int = MAX_RETRIES
) -> DataFrame:
    """One row: items, done keys, exhausted items, items to process."""
    exhausted = F.col("retry") >= max_retries
    done_keys = state.agg(F.count_if("done")).scalar()
    return (
        _with_state(items, state, key)
        .agg(
            F.count("*").alias("total"),
            F.count_if(exhausted).alias("exhausted"),
            F.count_if(~F.col("done") & ~exhausted).alias("to_process"),
        )
        .select("total", done_keys.alias("already_done"), "exhausted", "to_process")
    )
