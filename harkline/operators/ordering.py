"""Total orders at data size: dense index, bounded position blocks, running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harkline.session import written

#: Positions per block: a bounded group of rows.
BLOCK = 1 << 20
#: Blocks per superblock: a bounded group of block totals. 10^12 row numbers make 58
#: superblocks, byte positions of 100 TB 6,000 and at most one more per file.
SUPERBLOCK = 1 << 14

_ROW_BITS = 33


def global_index(
    df: DataFrame,
    order: list[str | Column],
    name: str = "idx",
    partitions: int | None = None,
) -> DataFrame:
    """Dense 0-based position under a total order, without a one-partition sort.

    `order` must be total (end it with a unique column). The rows are range
    partitioned and sorted, numbered inside their partition and written once:
    range bounds come from a sample, so they must not be drawn again. One count
    per partition then gives the offsets.
    """
    # without a number, adaptive execution joins small neighbours; the order stays
    ranges = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = (
        ranges.sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = written(placed, "index")
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place") - F.shiftleft(part, _ROW_BITS)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .count()
        .select(
            "_part",
            F.coalesce(
                F.sum("count").over(
                    Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_offset"),
        )
    )
    # one row per range partition
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row)
        .drop("_part", "_place", "_offset")
    )


def position_block(pos: str | Column, block: int = BLOCK) -> Column:
    """Block number of a position; keeps the order."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.call_function("div", pos, F.lit(block).cast("bigint"))


def _offsets(blocks: DataFrame, names: list[str]) -> DataFrame:
    """Exclusive prefix sums of the columns `_name` over the rows of a block table."""
    keyed = blocks.withColumn("_super", position_block("_block", SUPERBLOCK))
    before = (Window.unboundedPreceding, -1)

    def prefix(window):
        return [F.coalesce(F.sum(f"_{n}").over(window.rowsBetween(*before)), F.lit(0)).alias(f"_{n}") for n in names]

    # a few numbers per superblock: the one-task window runs over these rows only
    supers = (
        keyed.groupBy("_super")
        .agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in names])
        .select("_super", *[c.alias(f"_s_{n}") for n, c in zip(names, prefix(Window.orderBy("_super")))])
    )
    inside = keyed.select("_block", "_super", *prefix(Window.partitionBy("_super").orderBy("_block")))
    return inside.join(supers, "_super").select(
        "_block", *[(F.col(f"_{n}") + F.col(f"_s_{n}")).alias(f"_{n}") for n in names]
    )


def running_totals(
    df: DataFrame, pos: str, totals: dict[str, Column], block: int = BLOCK
) -> DataFrame:
    """Add inclusive prefix sums over `pos` as new columns.

    Prefix sums inside bounded blocks, plus block offsets from the table of block
    totals. Both sides of the join are placed by block, so the rows move once.
    """
    keyed = df.withColumn("_block", position_block(pos, block))
    blocks = keyed.groupBy("_block").agg(*[F.sum(expr).alias(f"_{name}") for name, expr in totals.items()])
    inside = (
        Window.partitionBy("_block")
        .orderBy(pos)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = keyed.select(
        "*", *[F.coalesce(F.sum(expr).over(inside), F.lit(0)).alias(name) for name, expr in totals.items()]
    )
    joined = local.join(_offsets(blocks, list(totals)), "_block")
    return joined.select(
        *df.columns, *[(F.col(name) + F.col(f"_{name}")).alias(name) for name in totals]
    )


def line_index(df: DataFrame, pos: str = "pos", name: str = "idx", block: int = BLOCK) -> DataFrame:
    """Dense 0-based number in position order, for rows that carry a unique position."""
    return running_totals(df, pos, {name: F.lit(1)}, block).withColumn(name, F.col(name) - 1)
