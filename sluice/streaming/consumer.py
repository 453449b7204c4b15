"""Continuous apply: micro-batches into a committed state, any number of consumers."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from sluice import schemas as S
from sluice.operators import apply as A, decode as X
from sluice.plans.materialize import decode
from sluice.session import COMPRESSION, new_folder, remove_folder
from sluice.sources.changes import Source, read_changes, start_at, start_option, with_arrival
from sluice.streaming.state import Ranges, State, known_runs, may_hold


@dataclass(frozen=True)
class BatchResult:
    """What a committed batch did: applied events per table, and new rejects."""

    version: int
    applied: Mapping[str, int]
    rejected: int


def message_ranges(messages: DataFrame) -> dict[int, tuple[int, int]]:
    """Lowest and highest sequence per broker partition; reads those two columns only."""
    sequence = F.col("sequence_number")
    rows = messages.groupBy("partition_id").agg(F.min(sequence).alias("lo"), F.max(sequence).alias("hi")).collect()
    return {r["partition_id"]: (r["lo"], r["hi"]) for r in rows}


def narrow_ledger(ledger: DataFrame, ranges: Ranges) -> DataFrame:
    """Ledger rows within the batch's lowest and highest sequence, for the file statistics."""
    lowest, highest = min(lo for lo, _ in ranges.values()), max(hi for _, hi in ranges.values())
    return ledger.filter(F.col("sequence_number").between(lowest, highest))


def unseen(state: State, manifest: dict, messages: DataFrame, ranges: Ranges) -> DataFrame:
    """Messages whose event is not in the ledger, by runs that are known whole and by rows for the rest."""
    return _lookup(state, manifest, ranges)(messages)


def _lookup(state: State, manifest: dict, ranges: Ranges) -> Callable[[DataFrame], DataFrame]:
    """:func:`unseen` for rows of one batch, its folders chosen once."""
    runs, folders = known_runs(manifest["ledger"], ranges)
    ledger = narrow_ledger(state.ledger_in(folders), ranges) if folders else None

    def without_known(rows: DataFrame) -> DataFrame:
        if runs:
            inside = [(F.col("partition_id") == p) & F.col("sequence_number").between(lo, hi) for p, lo, hi in runs]
            rows = rows.filter(~reduce(Column.__or__, inside))
        return rows if ledger is None else A.new_events(rows, ledger)

    return without_known


def apply_batch(
    state: State,
    messages: DataFrame,
    decoder: Callable[[DataFrame], DataFrame] = X.decode_live,
    before_commit: Callable[[], None] | None = None,
    append_time: bool = False,
    read_once: bool = False,
) -> BatchResult:
    """Apply one batch and commit targets, ledger, offsets and quarantine together.

    A failure before the commit leaves the state as it was (``before_commit`` is called last
    before it). A repeated batch finds its events in the ledger and changes nothing.

    Messages that can be read again are looked up in the ledger first, by two columns, so that known ones
    are never decoded. With ``read_once`` they are decoded and written first (see :func:`_written_once`).
    """
    manifest = state.manifest()
    arrived, ranges = with_arrival(messages, append_time), None
    if read_once:
        folder, summary = _written_once(state, manifest, decode(arrived, state.specs, decoder))
        return _commit(state, manifest, folder, summary, before_commit)
    if manifest["ledger"] or manifest["quarantine"]:
        ranges = message_ranges(messages)
        arrived = unseen(state, manifest, arrived, ranges)
    events = A.unique_events(decode(arrived, state.specs, decoder))
    if ranges:
        events = not_quarantined(state, manifest, events, ranges)
    folder, written = state.write_events(events, manifest)
    return _commit(state, manifest, folder, _summary(written), before_commit)


def _written_once(state: State, manifest: dict, events: DataFrame) -> tuple[dict, list[Row]]:
    """Write decoded events as they come; the folder that counts, and its summary.

    Only their ids are shuffled, to see whether one has several copies or is known. Where none is, what was
    written stays; else it is written a second time, each event once and without the known ones.
    """
    folder, written = state.write_events(events, manifest)
    summary = _summary(written)
    ranges = {p: (lo, hi) for p, (lo, hi, _) in _ranges(summary).items()}
    ids = written.groupBy(*S.EVENT_ID).agg(F.count(F.lit(1)).alias("copies"))
    quarantined = bool(may_hold(manifest["quarantine"], ranges))
    without_known = _lookup(state, manifest, ranges) if may_hold(manifest["ledger"], ranges) else lambda rows: rows
    new = without_known(ids).agg(F.sum("copies").alias("rows"), F.max("copies").alias("most")).head()
    if not new["rows"]:
        state.discard(folder)
        return folder, []
    rows = sum(r["rows"] for r in summary)
    if new["rows"] == rows and new["most"] == 1 and not quarantined:
        return folder, summary
    fresh = without_known(written) if new["rows"] < rows else written
    if new["most"] > 1:
        fresh = A.unique_events(fresh)
    first = folder
    folder, written = state.write_events(not_quarantined(state, manifest, fresh, ranges), manifest)
    state.discard(first)
    return folder, _summary(written)


def apply_decoded(state: State, events: DataFrame) -> BatchResult:
    """:func:`apply_batch` for events that were decoded and written before, maybe for more tables than the state's."""
    manifest, ranges = state.manifest(), None
    unknown = F.col("reject_reason").isNotNull() & (F.col("table") == "")
    events = events.filter(F.col("table").isin([s.name for s in state.specs]) | unknown)
    if manifest["ledger"] or manifest["quarantine"]:
        ranges = message_ranges(events)
        events = unseen(state, manifest, events, ranges)
    events = A.unique_events(events)
    if ranges:
        events = not_quarantined(state, manifest, events, ranges)
    folder, written = state.write_events(events, manifest)
    return _commit(state, manifest, folder, _summary(written))


def _commit(
    state: State, manifest: dict, folder: dict, summary: Sequence[Row], before_commit: Callable[[], None] | None = None
) -> BatchResult:
    changed, counts, rejected = _with_events(manifest, folder, summary, state.specs)
    if before_commit is not None:
        before_commit()
    if counts or rejected:
        changed = state.publish(changed)
    return BatchResult(changed["version"], counts, rejected)


def not_quarantined(state: State, manifest: dict, events: DataFrame, ranges: Ranges) -> DataFrame:
    """Without rejects that are in the quarantine already; both sides are clustered by event."""
    if not may_hold(manifest["quarantine"], ranges):
        return events
    known = state.quarantine(manifest, ranges).select(*S.EVENT_ID, F.lit(True).alias("_known")).distinct()
    return events.join(known, S.EVENT_ID, "left").filter("reject_reason IS NULL OR _known IS NULL").drop("_known")


def _summary(written: DataFrame) -> list[Row]:
    """Per broker partition and table (NULL for rejects): sequence range, rows, first arrival, and the last event by arrival.

    As many rows as broker partitions times subscribed tables.
    """
    table = F.when(F.col("reject_reason").isNull(), F.col("table")).alias("t")
    sequence = F.col("sequence_number")
    place = F.struct("arrival", "sequence_number", "commit_lsn", F.unix_micros("processed_at").alias("at"))
    return (
        written.groupBy("partition_id", table)
        .agg(
            F.min(sequence).alias("lo"), F.max(sequence).alias("hi"), F.count(sequence).alias("n"),
            F.min("arrival").alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("rows"),
        )
        .collect()
    )


def _ranges(summary: Sequence[Row]) -> dict[int, tuple[int, int, int]]:
    """Lowest and highest sequence, and rows, per broker partition."""
    out: dict[int, tuple[int, int, int]] = {}
    for r in summary:
        lo, hi, n = out.get(r["partition_id"], (r["lo"], r["hi"], 0))
        out[r["partition_id"]] = (min(lo, r["lo"]), max(hi, r["hi"]), n + r["n"])
    return out


def _with_events(
    manifest: dict, folder: dict, summary: Sequence[Row], specs: Sequence[S.TableSpec]
) -> tuple[dict, dict[str, int], int]:
    """The manifest with one more folder of events; applied events per table, and rejects."""
    counts: Counter = Counter()
    last: dict[str, Row] = {}
    for r in summary:
        counts[r["t"]] += r["n"]
        p = str(r["partition_id"])
        if r["t"] is not None and (p not in last or r["last"] > last[p]):
            last[p] = r["last"]
    rows, rejected = sum(counts.values()), counts.pop(None, 0)
    folder = {**folder, "share": {t: n / rows for t, n in counts.items()}}
    changed = dict(manifest)

    def noted(part: Sequence[Row]) -> dict:
        arrivals = [min(r["first"] for r in part), max(r["last"]["arrival"] for r in part)]
        return {**folder, "ranges": {str(p): list(r) for p, r in _ranges(part).items()}, "arrivals": arrivals}

    if rejected:
        changed["quarantine"] = [*manifest["quarantine"], noted([r for r in summary if r["t"] is None])]
    if counts:
        changed["ledger"] = [*manifest["ledger"], noted([r for r in summary if r["t"] is not None])]
        moved = {p: [r["sequence_number"], r["commit_lsn"], r["arrival"], r["at"]] for p, r in last.items()}
        changed["offsets"] = manifest["offsets"] | moved
    targets = dict(manifest["targets"])
    for spec in specs:
        if spec.name in counts:
            known = targets.get(spec.name, {"base": [], "changes": []})
            targets[spec.name] = {**known, "changes": [*known["changes"], folder]}
    return {**changed, "targets": targets}, dict(counts), rejected


def apply_in_batches(state: State, batches: Sequence[DataFrame]) -> list[BatchResult]:
    """Apply bounded batches one after the other, each with its own commit."""
    return [apply_batch(state, batch) for batch in batches]


def replay(state: State, messages: DataFrame) -> BatchResult:
    """Read a whole feed again; the ledger leaves every table as it was."""
    return apply_batch(state, messages)


@dataclass(frozen=True)
class Consumer:
    """An independent reader: its own start, state and checkpoint on a shared source."""

    name: str
    state_path: str
    checkpoint: str
    specs: Sequence[S.TableSpec] = (S.ORDERS,)
    positions: Mapping[int, int] = field(default_factory=dict)
    decoder: Callable[[DataFrame], DataFrame] = X.decode_live

    def state(self, spark: SparkSession) -> State:
        return State(spark, self.state_path, self.specs)


def start_consumer(
    spark: SparkSession,
    source: Source,
    consumer: Consumer,
    available_now: bool = False,
    on_batch: Callable[[BatchResult], None] | None = None,
    maintain_every: int = 16,
) -> StreamingQuery:
    """Start applying a source to a consumer's state; every so many batches its state is tidied up.

    A new checkpoint reads everything again (the ledger sorts out what is known), a kept one
    resumes. The ledger, not a watermark, removes duplicates: an event of any age is applied
    if it was not before.
    """
    state = consumer.state(spark)
    messages = read_changes(spark, source, stream=True, start=start_option(source, consumer.positions))
    messages = start_at(messages, consumer.positions)
    count = 0

    def apply(batch: DataFrame, _: int) -> None:
        nonlocal count
        result = apply_batch(state, batch, consumer.decoder, append_time=source.append_time, read_once=True)
        count += 1
        if count % maintain_every == 0:
            state.maintain()
        if on_batch is not None:
            on_batch(result)

    writer = (
        messages.writeStream.queryName(consumer.name)
        .option("checkpointLocation", consumer.checkpoint)
        .foreachBatch(apply)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def fan_out(
    spark: SparkSession, source: Source, consumers: Sequence[Consumer], available_now: bool = False
) -> list[StreamingQuery]:
    """Start several consumers on one source; they share nothing but the source."""
    return [start_consumer(spark, source, c, available_now) for c in consumers]


def start_together(
    spark: SparkSession,
    source: Source,
    consumers: Sequence[Consumer],
    checkpoint: str,
    available_now: bool = False,
    on_batch: Callable[[str, BatchResult], None] | None = None,
    maintain_every: int = 16,
) -> StreamingQuery:
    """Start several consumers as one query that reads and decodes each message once for all.

    A batch is decoded for the tables of all consumers and written once; then each consumer takes its tables from
    its own start on, looks them up in its own ledger and commits its own state. Their results are those of
    :func:`fan_out`, but they share one checkpoint and stop together: if one fails, the batch is
    repeated for all, and the ledgers of those that had committed sort it out. A consumer that is added
    to a kept checkpoint sees only what follows; let it catch up by :func:`start_consumer` first.
    """
    if len({c.decoder for c in consumers}) != 1:
        raise ValueError("consumers of one decoding need the same decoder")
    specs: dict[str, S.TableSpec] = {}
    for spec in (s for c in consumers for s in c.specs):
        if specs.setdefault(spec.name, spec) != spec:
            raise ValueError(f"consumers of one decoding need the same columns of {spec.name}")
    common = set.intersection(*(set(c.positions) for c in consumers))
    start = {p: min(c.positions[p] for c in consumers) for p in common}
    messages = read_changes(spark, source, stream=True, start=start_option(source, start))
    states = {c.name: c.state(spark) for c in consumers}
    count = 0

    def apply(batch: DataFrame, _: int) -> None:
        nonlocal count
        arrived = with_arrival(batch, source.append_time)
        folder = new_folder(spark, "decoded")
        events = decode(arrived, list(specs.values()), consumers[0].decoder).drop("schema_name")  # no state keeps it
        events.write.option("compression", COMPRESSION).parquet(folder)
        written = spark.read.schema(events.schema).parquet(folder)
        count += 1
        for consumer in consumers:
            result = apply_decoded(states[consumer.name], start_at(written, consumer.positions))
            if count % maintain_every == 0:
                states[consumer.name].maintain()
            if on_batch is not None:
                on_batch(consumer.name, result)
        remove_folder(spark, folder)

    writer = start_at(messages, start).writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def waiting(progress: StreamingQueryProgress) -> dict[tuple[str, int], int] | None:
    """Messages a broker holds that a query has not read yet, per topic and partition.

    By the offsets of a query's ``lastProgress``, without reading a message; a partition that has not been
    read at all counts from offset 0. None if a source does not report its latest offset (files do not).
    """
    left: dict[tuple[str, int], int] = {}
    for source in json.loads(progress.json)["sources"]:
        latest, end = source["latestOffset"], source["endOffset"] or {}
        if not isinstance(latest, dict) or not all(isinstance(p, dict) for p in latest.values()):
            return None
        for topic, partitions in latest.items():
            for partition, offset in partitions.items():
                left[topic, int(partition)] = max(offset - end.get(topic, {}).get(partition, 0), 0)
    return left


def batch_metrics(query: StreamingQuery) -> list[dict]:
    """Per micro-batch: rows read, rows per second, commit latency and time per step, from Spark's progress."""
    return [
        {
            "batch": p["batchId"],
            "rows": p["numInputRows"],
            "rows_per_second": p["processedRowsPerSecond"],
            "commit_ms": p["durationMs"].get("addBatch"),
            "step_ms": dict(p["durationMs"]),
        }
        for p in query.recentProgress
    ]
