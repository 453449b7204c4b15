"""Running numbers inside large groups, without one task per group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows with the same ``position >> BLOCK_BITS`` are numbered together. Positions are (nearly)
# unique inside a group, so a block holds about a million rows at most.
BLOCK_BITS = 20
# Blocks are summed up in blocks of blocks of this many bits, so no task sees more of them.
LEVEL_BITS = 16
POSITION_BITS = 64


def _before(
    blocks: DataFrame, group: Sequence[str], total: Callable[[str], Column], joined: Callable[..., Column], bits: int
) -> DataFrame:
    """For each ``_block`` the total of ``_value`` over all earlier blocks of its group, as ``_before``.

    With positions far apart every row is a block of its own. Their totals are therefore taken
    in levels: inside runs of ``2 ** LEVEL_BITS`` block numbers, and over those runs by the same rule.
    """
    def inside(*keys: str) -> Column:
        return total("_value").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))

    if bits <= LEVEL_BITS:
        return blocks.select(*group, "_block", joined(inside(*group), F.lit(None)).alias("_before"))
    run = F.shiftright("_block", LEVEL_BITS)
    runs = blocks.groupBy(*group, run.alias("_block")).agg(total("_value").alias("_value"))
    starts = _before(runs, group, total, joined, bits - LEVEL_BITS).select(
        *group, F.col("_block").alias("_run"), F.col("_before").alias("_above")
    )
    return (
        blocks.withColumn("_run", run)
        .join(starts, [*group, "_run"])
        .select(*group, "_block", joined(inside(*group, "_run"), F.col("_above")).alias("_before"))
    )


def _sum_of(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b.cast("long"), F.lit(0))


def number_in_order(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    position: str,
    into: str,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``into``: 1, 2, 3, ... inside each group, in the given order.

    ``row_number()`` over the group would sort a whole group in one task, and a broker
    partition may hold a third of all rows. Instead rows are cut into blocks by ``position``
    (a BIGINT that sorts like ``order``), counted per block, and numbered inside their block
    on top of the running count of the blocks before it. The blocks are summed up in levels, so
    neither dense nor sparse positions land in one task; the rows are shuffled once, by group and block.
    """
    blocked = df.withColumn("_block", F.shiftright(F.col(position), block_bits))
    keys = [*group, "_block"]
    counts = blocked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_value"))
    starts = _before(counts, group, F.sum, _sum_of, POSITION_BITS - block_bits)
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        blocked.join(starts, keys)
        .withColumn(into, F.col("_before") + F.row_number().over(inside))
        .select(*df.columns, into)
    )


def running_max(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    value: Column,
    into: str,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``into``: the greatest ``value`` so far inside each group, in ``position`` order.

    Rows of one position are peers and get the same. The maxima are found over distinct positions, cut into
    blocks like in :func:`number_in_order`, and joined back: a position that a million rows
    share is one row until then, and its rows may be split among tasks.
    """
    keys = [*group, "_block"]
    distinct = (
        df.groupBy(*group, F.col(position).alias("_position"))
        .agg(F.max(value).alias("_value"))
        .withColumn("_block", F.shiftright("_position", block_bits))
    )
    tops = distinct.groupBy(*keys).agg(F.max("_value").alias("_value"))
    starts = _before(tops, group, F.max, F.greatest, POSITION_BITS - block_bits)
    so_far = Window.partitionBy(*keys).orderBy("_position").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    maxima = distinct.join(starts, keys).select(
        *group, "_position", F.greatest("_before", F.max("_value").over(so_far)).alias(into)
    )
    return (
        df.withColumn("_position", F.col(position))
        .join(maxima, [*group, "_position"])
        .select(*df.columns, into)
    )
