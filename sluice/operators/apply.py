"""The apply rules: filters, deduplication, net changes, merging, ledger and offsets.

Pure DataFrame functions. Events are ordered by ``arrival`` (any orderable type, unique);
sequence numbers identify events and are never compared to decide which change wins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sluice import schemas as S
from sluice.operators import decode as X
from sluice.operators.numbering import number_in_order
from sluice.session import staged
from sluice.sources.changes import arrival_position


# Filters and routing -----------------------------------------------------------------

def only_table(events: DataFrame, name: str) -> DataFrame:
    """Events of one table, by exact name; others leave no trace in ledger or offsets."""
    return events.filter(F.col("table") == name)


def subscribe(events: DataFrame, names: Sequence[str]) -> DataFrame:
    return events.filter(F.col("table").isin(list(names)))


def route(
    events: DataFrame, specs: Sequence[S.TableSpec], by_schema: bool = False
) -> dict[str, DataFrame]:
    """One DataFrame per target, by table name or by (schema, table)."""
    routed = {}
    for spec in specs:
        mine = F.col("table") == spec.name
        if by_schema:
            mine = mine & (F.col("schema_name") == spec.schema_name)
        routed[spec.name] = events.filter(mine)
    return routed


def specs_from_config(config: DataFrame) -> list[S.TableSpec]:
    """Target tables out of a config table: table_name, key_column, column_list.

    A list entry is a column's name, read as text, or name and type: ``Quantity int``,
    ``Price decimal(10,2)``, ``Note varchar(50)``, ``SalesDate date``. The config has one row per
    target table; they become specs, so configured tables are typed, checked and merged like others.
    """
    rows = config.select("table_name", "key_column", "column_list").collect()
    return [
        S.TableSpec(r["table_name"], r["key_column"], tuple(map(S.parse_column, r["column_list"])))
        for r in rows
    ]


def route_by_config(decoded: DataFrame, config: DataFrame, keep: bool = False) -> dict[str, DataFrame]:
    """Typed, accepted events of each configured table, by its name.

    With ``keep`` the events of all tables are typed in one pass and written to the shared folder
    first, for when several tables are read: else each of them decodes all messages again.
    """
    specs = specs_from_config(config)
    if not keep:
        return {s.name: X.to_table(decoded, s) for s in specs}
    typed = staged(X.accepted(X.typed_events(decoded, specs)).drop("schema_name", "reject_reason", "value"), "routed")
    return {s.name: X.flat_events(typed, s) for s in specs}


# Deduplication -----------------------------------------------------------------------

def _first_per_event(events: DataFrame, *order: Column) -> DataFrame:
    """One row per event. The ``= 1`` filter lets Spark drop further copies before the
    shuffle, so an event delivered a million times does not pile up in one task."""
    w = Window.partitionBy(*S.EVENT_ID).orderBy(*order)
    return events.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def dedup_in_batch(events: DataFrame) -> DataFrame:
    """Keep the first arrival of every (partition, sequence)."""
    return _first_per_event(events, F.col("arrival"))


def new_events(events: DataFrame, ledger: DataFrame) -> DataFrame:
    """Events not yet in the ledger. After :func:`dedup_in_batch` both sides are already
    clustered by event, and the batch is not shuffled again."""
    return events.join(ledger.select(*S.EVENT_ID), S.EVENT_ID, "left_anti")


def unique_events(events: DataFrame) -> DataFrame:
    """:func:`dedup_in_batch` with rejects kept: the first usable copy of every event counts,
    or the first copy if none is usable."""
    return _first_per_event(events, F.col("reject_reason").isNotNull(), F.col("arrival"))


def classify(events: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Flag each event as ``applied`` or duplicate.

    The first arrival of an unseen (partition, sequence) is applied, all else is a duplicate.
    First arrivals are found by a narrow aggregate and joined back on the event *and* its
    arrival, which spreads the copies of one event over all tasks.
    """
    first = events.groupBy(*S.EVENT_ID).agg(F.min("arrival").alias("arrival"))
    if ledger is not None:
        first = new_events(first, ledger)
    first = first.withColumn("applied", F.lit(True))
    return events.join(first, [*S.EVENT_ID, "arrival"], "left").withColumn(
        "applied", F.coalesce("applied", F.lit(False))
    )


# Net changes and merging --------------------------------------------------------------

def changes_rows(events: DataFrame) -> DataFrame:
    """Events that touch a row; an unknown operation is processed but changes nothing."""
    return events.filter(F.col("operation").isin(S.INSERT, S.UPDATE, S.DELETE))


def last_change_per_key(events: DataFrame, key: str) -> DataFrame:
    """Net effect of a batch: per key only its last change matters, because inserts and
    updates replace the whole row. Earlier changes are dropped before the shuffle too."""
    w = Window.partitionBy(key).orderBy(F.col("arrival").desc())
    return (
        changes_rows(events)
        .withColumn("_n", F.row_number().over(w))
        .filter("_n = 1")
        .drop("_n")
    )


def merge_changes(target: DataFrame, net: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Upsert and delete by key. ``net`` holds one change per key.

    An update of a missing row inserts it, an insert of an existing row replaces it, a delete
    of a missing row does nothing, and NULLs of the new image replace stored values.
    """
    columns = [spec.key, *spec.column_names]
    upserts = net.filter(F.col("operation") != S.DELETE).select(*columns)
    untouched = target.select(*columns).join(net.select(spec.key), spec.key, "left_anti")
    return untouched.select(*columns).unionByName(upserts)


def merge_orders(target: DataFrame, net: DataFrame) -> DataFrame:
    return merge_changes(target, net, S.ORDERS)


def merge_order_lines(target: DataFrame, net: DataFrame) -> DataFrame:
    return merge_changes(target, net, S.ORDER_LINES)


def rows_from(net: DataFrame, spec: S.TableSpec) -> DataFrame:
    """:func:`merge_changes` into an empty target."""
    return net.filter(F.col("operation") != S.DELETE).select(spec.key, *spec.column_names)


# Ledger and offsets -------------------------------------------------------------------

def ledger_rows(applied: DataFrame) -> DataFrame:
    return applied.select(
        *S.EVENT_ID, "commit_lsn", arrival_position(applied).alias("arrival"),
        F.current_timestamp().alias("processed_at"),
    )


def append_ledger(ledger: DataFrame, applied: DataFrame) -> DataFrame:
    """The ledger with one more row per applied event."""
    return ledger.unionByName(ledger_rows(applied))


def last_applied(applied: DataFrame) -> DataFrame:
    """Per partition the event applied last *by arrival*, which may not be the highest."""
    position = arrival_position(applied).alias("position")
    last = F.max_by(F.struct("sequence_number", "commit_lsn", position), F.col("arrival"))
    return (
        applied.groupBy("partition_id")
        .agg(last.alias("_last"))
        .select(
            "partition_id",
            F.col("_last.sequence_number").alias("last_sequence_number"),
            F.col("_last.commit_lsn").alias("last_commit_lsn"),
            F.col("_last.position").alias("last_arrival"),
            F.current_timestamp().alias("updated_at"),
        )
    )


def upsert_offsets(offsets: DataFrame, applied: DataFrame) -> DataFrame:
    """Overwrite the offset of every partition that had an applied event."""
    moved = last_applied(applied)
    return offsets.join(moved.select("partition_id"), "partition_id", "left_anti").unionByName(moved)


# Batches ------------------------------------------------------------------------------

def assign_batches(events: DataFrame, n: int, position: str | None = None) -> DataFrame:
    """Number the batches of ``n`` events per partition, in order; the last may be smaller.

    ``position`` is a BIGINT that sorts like arrival. By default it is the arrival if that is a
    number; the default arrival of a broker's rows keeps each partition's sequence order.
    """
    numeric = isinstance(events.schema["arrival"].dataType, T.LongType)
    position = position or ("arrival" if numeric else "sequence_number")
    numbered = number_in_order(events, ["partition_id"], ["arrival"], position, "_event")
    return numbered.withColumn("batch", F.ceil(F.col("_event") / n).cast("long")).drop("_event")


def union_all(frames: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames.values())
