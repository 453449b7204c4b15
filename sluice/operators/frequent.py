"""Hottest keys of an unbounded history, in bounded summaries that can be merged.

A summary lists at most ``capacity`` keys with a count each key has at least, and in one more row
(``listed`` is false, no key) how much any count may be too low, which is also the most an unlisted
key can have. It is a Misra-Gries summary: where more keys would be listed, the count of the first
one too many is taken off all, and what is left at zero goes. Taking off ``c`` removes ``c`` from more than
``capacity`` keys, so after any number of merges the error is at most events / (capacity + 1).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

CAPACITY = 1_000


def summary_columns(keys: Sequence[str]) -> list[str]:
    return [*keys, "listed", "at_least", "error"]


def key_summary(events: DataFrame, keys: Sequence[str], capacity: int = CAPACITY) -> DataFrame:
    """The summary of a bounded set of events; a hot key is counted before the shuffle."""
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("at_least"))
    counts = counts.withColumns({"listed": F.lit(True), "error": F.lit(0).cast("long")})
    return _reduced(counts, keys, capacity)


def merged_summaries(summaries: Sequence[DataFrame], keys: Sequence[str], capacity: int = CAPACITY) -> DataFrame:
    """One summary of what several cover, none of them twice."""
    together = reduce(DataFrame.unionByName, [s.select(*summary_columns(keys)) for s in summaries])
    added = together.groupBy(*keys, "listed").agg(F.sum("at_least").alias("at_least"), F.sum("error").alias("error"))
    return _reduced(added, keys, capacity)


def _reduced(counts: DataFrame, keys: Sequence[str], capacity: int) -> DataFrame:
    """The ``capacity`` greatest counts, less the next one.

    That one is found among the different counts there are, with the keys of each: as counts add up to the
    events, these are at most the root of twice the events. The keys themselves are neither sorted nor moved.
    """
    sizes = counts.filter("listed").groupBy("at_least").agg(F.count(F.lit(1)).alias("_keys"))
    so_far = F.sum("_keys").over(Window.partitionBy(F.lit(1)).orderBy(F.col("at_least").desc()))
    too_many = sizes.withColumn("_so_far", so_far).filter(F.col("_so_far") > capacity).agg(F.max("at_least").alias("cut"))
    cut = F.coalesce(too_many.scalar(), F.lit(0))
    listed = counts.filter("listed").filter(F.col("at_least") > cut).select(
        *keys, "listed", (F.col("at_least") - cut).alias("at_least"), F.lit(0).cast("long").alias("error")
    )
    rest = counts.filter(~F.col("listed")).agg(F.max("error").alias("_error")).select(
        *[F.lit(None).cast(counts.schema[k].dataType).alias(k) for k in keys],
        F.lit(False).alias("listed"), F.lit(0).cast("long").alias("at_least"),
        (F.coalesce("_error", F.lit(0)) + cut).alias("error"),
    )
    return listed.unionByName(rest)


def frequent_keys(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Listed keys with the least and the most events each can have."""
    error = F.max("error").over(Window.partitionBy(F.lit(1)))
    return (
        summary.withColumn("at_most", F.col("at_least") + error)
        .filter("listed")
        .select(*keys, "at_least", "at_most")
    )
