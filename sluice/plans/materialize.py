"""Whole-log plans: targets, ledger and offsets computed from a complete feed in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sluice import schemas as S
from sluice.operators import apply as A, decode as X
from sluice.session import staged
from sluice.sources.changes import drop_empty


@dataclass(frozen=True)
class Outcome:
    """Result tables of applying a feed, all lazy; each reads the feed again unless it was kept."""

    applied: DataFrame
    rejects: DataFrame
    ledger: DataFrame
    offsets: DataFrame
    targets: dict[str, DataFrame]

    def tables(self) -> list[DataFrame]:
        return [self.rejects, self.ledger, self.offsets, *self.targets.values()]


def decode(
    messages: DataFrame,
    specs: Sequence[S.TableSpec] = (S.ORDERS,),
    decoder: Callable[[DataFrame], DataFrame] = X.decode_live,
) -> DataFrame:
    """Messages to typed events of the subscribed tables, rejects included."""
    return X.typed_events(decoder(drop_empty(messages)), specs)


def table_events(events: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Events of one table with its columns laid flat."""
    return A.only_table(events, spec.name).select(
        *S.EVENT_ID, "arrival", "operation", "commit_lsn",
        F.col("key").cast(spec.key_kind).alias(spec.key), f"{spec.name}.*",
    )


def net_changes(applied: DataFrame, spec: S.TableSpec) -> DataFrame:
    return A.last_change_per_key(table_events(applied, spec), spec.key)


def materialize(
    messages: DataFrame,
    specs: Sequence[S.TableSpec] = (S.ORDERS,),
    decoder: Callable[[DataFrame], DataFrame] = X.decode_live,
    keep: bool = False,
) -> Outcome:
    """Apply a whole feed to empty targets.

    Two shuffles per target: by event for the deduplication, by key for the net change. One
    ledger and one offset table serve all targets. With ``keep`` the decoded, deduplicated events
    are written to the shared folder first, for when more than one result is read: the feed is
    then read and decoded a single time. The first usable copy of an event counts.
    """
    events = decode(messages, specs, decoder)
    if keep:
        events = staged(A.unique_events(events), "applied")
        applied = X.accepted(events)
    else:
        applied = A.dedup_in_batch(X.accepted(events))
    return Outcome(
        applied=applied,
        rejects=X.rejects(events),
        ledger=A.ledger_rows(applied),
        offsets=A.last_applied(applied),
        targets={s.name: A.rows_from(net_changes(applied, s), s) for s in specs},
    )


def apply_to(
    messages: DataFrame,
    ledger: DataFrame,
    offsets: DataFrame,
    targets: dict[str, DataFrame],
    specs: Sequence[S.TableSpec] = (S.ORDERS,),
    decoder: Callable[[DataFrame], DataFrame] = X.decode_live,
    keep: bool = False,
) -> Outcome:
    """Apply a batch on top of given state; the pure form of a committed batch.

    With ``keep`` the decoded, deduplicated events are written first, as :func:`materialize` does.
    """
    events = decode(messages, specs, decoder)
    if keep:
        events = staged(A.unique_events(events), "applied")
        applied = A.new_events(X.accepted(events), ledger)
    else:
        applied = A.new_events(A.dedup_in_batch(X.accepted(events)), ledger)
    return Outcome(
        applied=applied,
        rejects=X.rejects(events),
        ledger=A.append_ledger(ledger, applied),
        offsets=A.upsert_offsets(offsets, applied),
        targets={
            s.name: A.merge_changes(targets[s.name], net_changes(applied, s), s) for s in specs
        },
    )
