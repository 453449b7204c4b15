"""Mixing sources to target weights along a time-varying curriculum.

Every source has an average weight and a schedule, its weight over training time 0 to 1 as a
polyline. Its target is a share of all words; a source is repeated three times at most, and what
it cannot deliver is shared anew by weight. The integral of the schedule says which part of its
target a source has spent at any time; inverted, it gives the time at which a document is due
whose words lie at a given place of the source's stream. Sorting by that time is the mix.

Documents stand in a source's stream in the order of a digest of their id. Running sums over that
order go through two levels of 256 digest ranges, so no task needs all documents of a hot source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sluice.llm.common import WORD, Stage, whole_text

#: Average weights, dealt to sources in code point order, null last, over and over.
WEIGHTS = (5, 2, 1)
#: Weight over time relative to the average, at times 0, 1/2 and 1, dealt likewise: the first
#: kind of source fades out, the second stays level, the third comes in late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
MOST_REPEATS = 3


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole_text(F.col(text)), F.lit(WORD)).cast("long")


def due_time(spent: Column, knots: Sequence[float]) -> Column:
    """The time at which the share ``spent`` of a source's demand has been met.

    ``knots`` are the schedule's weights at equal distances. Its integral is a parabola on each
    piece, which is inverted there.
    """
    step = 1.0 / (len(knots) - 1)
    areas = [(a + b) / 2 * step for a, b in zip(knots, knots[1:])]
    need = spent * F.lit(sum(areas))
    time = F.lit(0.0)
    for i, (a, b) in enumerate(zip(knots, knots[1:])):
        left = need - F.lit(sum(areas[:i]))
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * (b - a) / step) * left, F.lit(0.0)))
        inside = F.lit(i * step) + 2 * left / F.greatest(F.lit(a) + root, F.lit(1e-12))
        time = F.when(left >= 0, F.least(inside, F.lit((i + 1) * step))).otherwise(time)
    return time


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets from one row per source: no_source, source, words.

    Filling all sources by weight up to their caps: with sources in order of cap / weight, those
    before some place are full and the others share the rest at one level. One row per source
    goes through these windows, not one per document.
    """
    everything = W.orderBy("no_source", "source")
    by_ratio = W.orderBy("ratio", "rank")
    earlier = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    all_rows = by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    kind = (F.col("rank") - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (kind + 1).cast("int"))
    level = (F.sum("words").over(all_rows) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    )
    return (
        sizes.withColumn("rank", F.row_number().over(everything))
        .withColumn("kind", kind)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("words") * MOST_REPEATS)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), True).over(all_rows))
        .withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double")))
        .select("no_source", "source", "kind", F.col("words").alias("source_size"), "target")
    )


def plan_mix(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", carry: Sequence[str] = ("*",)
) -> DataFrame:
    """What the mix takes of each row: doc (struct of ``carry``), size, source_size, target, place, due.

    ``due`` has the time of each repetition, in order; its length says how often the document is
    taken. A repetition is taken if the middle of its words lies before the source's target, so a
    source misses its target by half a document at most. ``place`` is where the document begins
    in its source's stream, 0 to 1.

    A null source is a source of its own, the last one. Rows of size 0 count for no words and may
    be taken. Rows that repeat an id follow each other by size; equal rows are interchangeable.
    No rows give no rows.
    """
    stage = Stage(docs.sparkSession, "curriculum")
    leaf = ["no_source", "source", "coarse", "fine"]
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*carry).alias("doc"),
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        size.alias("size"),
        digest.alias("digest"),
        F.substring(digest, 1, 2).alias("coarse"),
        F.substring(digest, 3, 2).alias("fine"),
    )
    leaves = stage.write(rows.groupBy(*leaf).agg(F.sum("size").alias("words")))
    targets = source_targets(leaves.groupBy("no_source", "source").agg(F.sum("words").alias("words")))
    def running(df: DataFrame, within: list[str], by: str, name: str) -> DataFrame:
        w = W.partitionBy(*within).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum("words").over(w), F.lit(0)))

    ranges = running(leaves.groupBy(*leaf[:3]).agg(F.sum("words").alias("words")), leaf[:2], "coarse", "coarse_start")
    starts = (
        running(leaves, leaf[:3], "fine", "fine_start").drop("words")
        .join(ranges.drop("words"), leaf[:3])
        .join(targets, leaf[:2])
        .withColumn("start", F.col("coarse_start") + F.col("fine_start"))
        .drop("coarse_start", "fine_start")
    )
    inside = W.partitionBy(*leaf).orderBy("digest", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.join(stage.write(starts).hint("merge"), leaf).withColumn(
        "start", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )

    def repetition(k: int) -> Column:
        begin = F.col("start") + k * F.col("source_size")
        middle = (2 * begin + F.col("size")) / F.lit(2.0)
        spent = F.try_divide(middle, F.col("target"))
        due = F.lit(None).cast("double")
        for i, knots in enumerate(SCHEDULES):
            due = F.when(F.col("kind") == i, due_time(spent, knots)).otherwise(due)
        return F.when((middle <= F.col("target")) & (F.col("target") > 0), due)

    return placed.select(
        "doc", "size", "source_size", "target",
        F.coalesce(F.try_divide(F.col("start"), F.col("source_size")), F.lit(0.0)).alias("place"),
        F.array_compact(F.array(*map(repetition, range(MOST_REPEATS)))).alias("due"),
    )


def in_training_order(plan: DataFrame) -> DataFrame:
    """One row per repetition, range-sorted by the time it is due."""
    return plan.select("doc", "size", F.explode("due").alias("due")).orderBy("due")
