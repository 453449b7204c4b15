"""Exact duplicates by distributed MSD radix partitioning.

Documents start in one group. A round splits every open group by the next bytes of its texts:
rows with the same group and the same next bytes form a group of the next round. A group is
finished when it holds one row or when its texts have ended, so equal bytes alone decide and no
digest is compared. The first digit is 64 bytes, each later one eight times as long: texts that
share a prefix of n bytes take about log8(n / 64) rounds, and each byte is compared once.

The first round reads the documents in two jobs, which may number the rows differently where the
scan is split anew. All groups of several rows therefore go on to the second round, ended texts
too: it and later ones read the numbers the first one wrote, and choose the kept row by those.

Hot groups: sizes come from an aggregate, combined on the map side, so a group of any size
sends one row per task. Rows meet their group's size in a join of two shuffled tables at every
size of the input, which adaptive execution splits where one group holds much of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sluice.llm.common import Stage, whole_text

FIRST_DIGIT = 64
GROWTH = 8


def duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ("*",)
) -> DataFrame:
    """For each row: doc (struct of the columns ``carry``), keep_id, group_size and kept.

    Of rows with equal texts the one with the largest id is kept; nulls count as the smallest
    id, and of rows repeating the id as well the last one read is kept. A null text counts as
    empty; empty texts are equal to each other. Other columns, whatever their names, stay in
    ``doc``. An empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession, "radix")
    text = whole_text(F.col(text_col)).cast("binary")
    rows = docs.select(
        F.struct(*carry).alias("doc"),
        F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row")).alias("rank"),
        F.lit(0).cast("long").alias("group"),
        text.alias("rest"),
    )
    parts, width = [], FIRST_DIGIT
    while True:
        keyed = rows.withColumn("digit", F.substring("rest", 1, width))
        sizes = stage.write(
            keyed.groupBy("group", "digit")
            .agg(F.count("*").alias("n"), F.max("rank").alias("keep"))
            .filter("n > 1")
            .withColumn("next", F.monotonically_increasing_id())
        )
        going_on = F.length("digit") == width if parts else F.lit(True)
        is_open = (F.col("n") > 1) & going_on
        open_groups = not sizes.filter(going_on).isEmpty()
        split = (
            keyed.join(sizes.hint("merge"), ["group", "digit"], "left")
            .withColumn("open", F.coalesce(is_open, F.lit(False)))
            .select(
                "doc", "rank", "open", F.col("next").alias("group"),
                F.when(F.col("open"), F.expr(f"substring(rest, {width + 1}, {2**31 - 1})")).alias("rest"),
                F.coalesce("keep", "rank").alias("keep"),
                F.coalesce("n", F.lit(1)).cast("long").alias("n"),
            )
        )
        split = stage.write(split)
        parts.append(split)
        stage.clear(*parts)
        if not open_groups:
            break
        rows = split.filter("open").select("doc", "rank", "group", "rest")
        width *= GROWTH
    return reduce(DataFrame.unionAll, [p.filter("NOT open") for p in parts]).select(
        "doc",
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("keep.row") == F.col("rank.row")).alias("kept"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    return duplicate_classes(docs, id_col, text_col).filter("kept").select("doc.*")
