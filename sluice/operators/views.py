"""Read-back views over state and feed: logs, counts, backlog, top rows, skew and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice import schemas as S
from sluice.functions import variant as R
from sluice.functions.barrier import computed_once
from sluice.operators import apply as A, decode as X

DUPLICATE, FROM_STATE = "DUP", "—"


# State ---------------------------------------------------------------------------------

def ledger_view(ledger: DataFrame) -> DataFrame:
    """Ledger in processing order: batch by batch, inside a batch as events arrived."""
    return ledger.orderBy("processed_at", "arrival", *S.EVENT_ID)


def latest_offset(offsets: DataFrame) -> DataFrame:
    """The offset row updated last: of the latest batch, the one whose event arrived last."""
    order = ["updated_at", "last_arrival", "partition_id"]
    return offsets.orderBy(*[F.col(c).desc() for c in order]).limit(1)


def offsets_by_partition(offsets: DataFrame) -> DataFrame:
    return offsets.select(
        "partition_id", "last_sequence_number", "last_commit_lsn", "last_arrival", "updated_at"
    )


def count_rows(target: DataFrame) -> DataFrame:
    return target.agg(F.count(F.lit(1)).alias("rows"))


def _money(value: Column) -> Column:
    """Two decimals, no grouping."""
    return F.coalesce(value, F.lit(0)).cast("decimal(38,2)").cast("string")


def top_orders(orders: DataFrame, n: int = 50) -> DataFrame:
    """The orders with the highest keys, as text; a top-k per task, then one merge."""
    line = F.concat(
        F.lit("OrderID="), F.col("OrderID"),
        F.lit(" · "), F.coalesce("Product", F.lit("?")),
        F.lit(" · Qty "), F.coalesce("Quantity", F.lit(0)),
        F.lit(" · "), _money(F.col("Price")),
    )
    return orders.orderBy(F.col("OrderID").desc()).limit(n).select("OrderID", line.alias("line"))


def with_line_total(lines: DataFrame) -> DataFrame:
    """The computed column; it is never stored nor taken from an event."""
    return lines.withColumn("LineTotal", F.col("Quantity") * F.col("UnitPrice"))


def top_order_lines(lines: DataFrame, n: int = 50) -> DataFrame:
    line = F.concat(
        F.lit("OrderLineID="), F.col("OrderLineID"),
        F.lit(" · OrderID="), F.col("OrderID"),
        F.lit(" · ProductID="), F.col("ProductID"),
        F.lit(" · "), F.col("Quantity"),
        F.lit(" × "), _money(F.col("UnitPrice")),
        F.lit(" = "), _money(F.col("LineTotal")),
    )
    top = lines.orderBy(F.col("OrderLineID").desc()).limit(n)
    return with_line_total(top).select("OrderLineID", line.alias("line"))


# Processing log ------------------------------------------------------------------------

def apply_counts(classified: DataFrame) -> DataFrame:
    """Applied and duplicate totals, and the event applied last."""
    last = F.max_by(
        F.struct("sequence_number", "commit_lsn"), F.when(F.col("applied"), F.col("arrival"))
    )
    return classified.agg(
        F.count_if("applied").alias("applied"),
        F.count_if(~F.col("applied")).alias("duplicates"),
        last.alias("_last"),
    ).select(
        "applied", "duplicates",
        F.col("_last.sequence_number").alias("last_sequence_number"),
        F.col("_last.commit_lsn").alias("last_commit_lsn"),
    )


def key_text(specs: Sequence[S.TableSpec], table: Column, key: Column) -> Column:
    """``OrderID=7``, by the key column of the event's table."""
    name = F.lit(None).cast("string")
    for spec in specs:
        name = F.when(table == spec.name, F.lit(spec.key)).otherwise(name)
    return F.concat(name, F.lit("="), key)


def recent_log(classified: DataFrame, specs: Sequence[S.TableSpec], n: int = 200) -> DataFrame:
    """The n events processed last, newest first, marked as applied or duplicate."""
    newest = [F.col(c).desc() for c in ("arrival", "partition_id", "sequence_number")]
    return (
        classified.orderBy(*newest)
        .limit(n)
        .select(
            "arrival", "operation", key_text(specs, F.col("table"), F.col("key")).alias("key_text"),
            "sequence_number", "applied",
        )
    )


def partition_log(classified: DataFrame) -> DataFrame:
    """Per partition: sequence, operation (or a mark for a duplicate) and LSN."""
    return classified.select(
        "partition_id", "arrival", "sequence_number",
        F.when(F.col("applied"), F.col("operation")).otherwise(DUPLICATE).alias("op"),
        "commit_lsn",
    )


def loaded_partition_log(ledger: DataFrame) -> DataFrame:
    """Rows of the log that come from stored state: the ledger keeps no operation."""
    return ledger.select(
        "partition_id", "sequence_number", F.lit(FROM_STATE).alias("op"), "commit_lsn"
    )


def backlog(events: DataFrame, ledger: DataFrame, specs: Sequence[S.TableSpec]) -> DataFrame:
    """Per partition: usable events waiting, the next one, and how many more follow it.

    With one table the next event is shown by its key, with several by its table.
    """
    if len(specs) == 1:
        what = F.concat(F.lit(" "), key_text(specs, F.col("table"), F.col("key")))
    else:
        what = F.concat(F.lit(" on "), F.col("schema_name"), F.lit("."), F.col("table"))
    first = F.min_by(F.struct("sequence_number", "operation", what.alias("what")), F.col("arrival"))
    waiting = A.new_events(A.dedup_in_batch(X.accepted(events)), ledger)
    following = F.col("waiting") - 1
    return (
        waiting.groupBy("partition_id")
        .agg(F.count(F.lit(1)).alias("waiting"), first.alias("next"))
        .select(
            "partition_id", "waiting",
            F.concat(
                F.lit("seq "), F.col("next.sequence_number"), F.lit(" "),
                F.col("next.operation"), F.col("next.what"),
            ).alias("next_event"),
            F.when(following > 0, F.concat(F.lit("+"), following, F.lit(" more")))
            .otherwise("")
            .alias("more"),
        )
    )


# Quarantine ----------------------------------------------------------------------------

def quarantine(events: DataFrame) -> DataFrame:
    """Dead letters of a feed, each event once, so that a bad one never blocks a partition."""
    rejected = events.filter(F.col("reject_reason").isNotNull())
    return X.rejects(A.dedup_in_batch(rejected)).withColumn("rejected_at", F.current_timestamp())


def latest_errors(errors: DataFrame, time: str, unique: Sequence[str], n: int = 10) -> DataFrame:
    """The n newest rows of an error table; of equal times, those with the highest ``unique``."""
    return errors.orderBy(*[F.col(c).desc() for c in (time, *unique)]).limit(n)


# Skew and metrics ----------------------------------------------------------------------

def key_skew(events: DataFrame, key: str) -> DataFrame:
    """Keys, events, the hottest key's share, and keys seen in more than one partition.

    Takes accepted events: a reject has no key and would count as one.
    """
    per_key = (
        events.groupBy(key, "partition_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(key)
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("partitions"))
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("n").alias("events"),
        F.max("n").alias("hottest_key_events"),
        (F.max("n") / F.sum("n")).alias("hottest_key_share"),
        F.count_if(F.col("partitions") > 1).alias("keys_in_many_partitions"),
        F.count_if(F.col(key) == 0).alias("absent_keys"),
    )


def events_per_key(events: DataFrame, key: str) -> DataFrame:
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("events"))


def partition_skew(events: DataFrame) -> DataFrame:
    """Events per partition and their share; the window runs over one row per partition."""
    counts = events.groupBy("partition_id").agg(F.count(F.lit(1)).alias("events"))
    everything = Window.partitionBy(F.lit(1))
    return counts.withColumn("share", F.col("events") / F.sum("events").over(everything))


def events_per_second(messages: DataFrame, time: str) -> DataFrame:
    """Events per partition and second."""
    return (
        messages.groupBy("partition_id", F.window(time, "1 second").alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select("partition_id", F.col("w.start").alias("second"), "events")
    )


def replay_counts(events: DataFrame) -> DataFrame:
    """Per partition: events delivered, distinct ones, and repeats of them."""
    per_event = events.groupBy(*S.EVENT_ID).agg(F.count(F.lit(1)).alias("n"))
    return per_event.groupBy("partition_id").agg(
        F.sum("n").alias("delivered"),
        F.count(F.lit(1)).alias("distinct_events"),
        F.sum(F.col("n") - 1).alias("repeats"),
    )


def ledger_growth(ledger: DataFrame) -> DataFrame:
    """Ledger rows and sequence span per partition."""
    return ledger.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("ledger_rows"),
        F.min("sequence_number").alias("first_sequence"),
        F.max("sequence_number").alias("last_sequence"),
    )


# Feed ----------------------------------------------------------------------------------

def feed_count(feed: DataFrame) -> DataFrame:
    return feed.agg(F.count(F.lit(1)).alias("events"))


def feed_newest_first(feed: DataFrame, n: int | None = None) -> DataFrame:
    """The feed with its newest line on top; all of it unless ``n`` is given."""
    ordered = feed.orderBy(F.col("arrival").desc())
    return ordered if n is None else ordered.limit(n)


# Small operations on targets -----------------------------------------------------------

def ship_date(day: Column, days: int = 75) -> Column:
    return F.date_add(day, days)


def next_key(target: DataFrame, key: str) -> DataFrame:
    return target.agg((F.coalesce(F.max(key), F.lit(0)) + 1).alias("next_key"))


def update_latest(target: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Change columns of the row with the greatest key."""
    latest = target.agg(F.max(key)).scalar()
    mine = F.col(key) == latest
    types = dict(zip(target.columns, [f.dataType for f in target.schema.fields]))
    return target.withColumns({
        name: F.when(mine, value.cast(types[name])).otherwise(F.col(name))
        for name, value in values.items()
    })


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (unknown keeps the row)."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def change_mask(decoded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Names of the columns that differ between a change's before and after images.

    Values are equal if they are of one JSON kind and have the same text; a missing member
    equals null.
    """
    images = computed_once(decoded.filter(F.col("reject_reason").isNull()), {
        "_before": R.fields("before", columns), "_after": R.fields("row", columns),
    })

    def cell(image: str, column: str) -> Column:
        value = f"{image}.`{column}`"
        return F.expr(f"struct({R.json_kind(value)} AS kind, try_variant_get({value}, '$', 'string') AS text)")

    differs = [F.when(cell("_before", c) != cell("_after", c), F.lit(c)) for c in columns]
    return images.select(
        *S.EVENT_ID, "arrival", "operation", "key_id",
        F.array_compact(F.array(*differs)).alias("changed"),
    )
