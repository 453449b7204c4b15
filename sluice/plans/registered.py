"""Registered queries: every operator at work on whole tables, by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice import schemas as S
from sluice.operators import apply as A, decode as X, frequent as K, views as V
from sluice.plans.materialize import Outcome, apply_to, decode, materialize
from sluice.session import COMPRESSION, new_folder, prepare, staged
from sluice.sources import changes as C, derived as D
from sluice.streaming.consumer import BatchResult, Consumer, apply_batch, fan_out, start_consumer, start_together
from sluice.streaming.rates import start_rates, stream_rates
from sluice.streaming.state import State
from sluice.streaming.top import recent_events, top_rows

ORDERS, ORDER_LINES = D.ORDERS, D.ORDER_LINES
BOTH = (ORDERS, ORDER_LINES)
EVENT = [*S.EVENT_ID, "arrival"]
MASKED = ["Company", "SalesDate", "Product", "Quantity", "Price"]


# Pieces ----------------------------------------------------------------------------------

def _before(spark: SparkSession, sf_dir: str) -> Outcome:
    """What applying the first half of the Orders feed leaves behind."""
    return materialize(D.orders_feed(spark, sf_dir).filter(D.first_half(spark, sf_dir)), [ORDERS])


def _feed(spark: SparkSession, sf_dir: str, specs: Sequence[S.TableSpec]) -> DataFrame:
    return (D.two_table_feed if len(specs) > 1 else D.orders_feed)(spark, sf_dir)


def _events(spark: SparkSession, sf_dir: str, specs: Sequence[S.TableSpec] = (ORDERS,)) -> DataFrame:
    return decode(_feed(spark, sf_dir, specs), specs)


def _headers(spark: SparkSession, sf_dir: str, specs: Sequence[S.TableSpec] = (ORDERS,)) -> DataFrame:
    """Events without their cells."""
    return X.header_events(X.decode_live(_feed(spark, sf_dir, specs)), specs)


def _staged_headers(spark: SparkSession, sf_dir: str, specs: Sequence[S.TableSpec] = (ORDERS,)) -> DataFrame:
    """For plans that use the events twice: they are decoded once."""
    return staged(_headers(spark, sf_dir, specs), "events")


def _irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(D.irregular_feed(spark, sf_dir), [ORDERS])


def _all_applied(spark: SparkSession, sf_dir: str) -> Outcome:
    return materialize(D.orders_feed(spark, sf_dir), [ORDERS])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_applied(spark, sf_dir).targets["Orders"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(D.lines_feed(spark, sf_dir), [ORDER_LINES]).targets["OrderLines"]


def _state(spark: SparkSession, specs: Sequence[S.TableSpec] = (ORDERS,)) -> State:
    return State(spark, new_folder(spark, "state"), specs)


def _committed(spark: SparkSession, sf_dir: str) -> State:
    """State after two committed batches of the Orders feed and a replay of both."""
    state = _state(spark)
    _apply_waves(state, D.waves(spark, sf_dir))
    return state


def _apply_waves(state: State, waves: Sequence[DataFrame]) -> None:
    """Apply waves of messages. Once something is known a wave is read twice, so its messages are written first."""
    for wave in waves:
        apply_batch(state, staged(wave, "wave") if state.manifest()["ledger"] else wave)


def _merged_then_changed(spark: SparkSession, sf_dir: str, specs: Sequence[S.TableSpec], lines: bool = False) -> State:
    """State whose base holds the feed's first half; the rest and the replays are unmerged changes."""
    state = State(spark, new_folder(spark, "state"), specs, merge_share=0.0)
    first, *others = D.waves(spark, sf_dir, lines)
    if lines:
        first, others = first.unionByName(others[1]), [others[0], *others[2:]]
    apply_batch(state, first)
    state.maintain()
    _apply_waves(state, others)
    return state


def _stream(
    spark: SparkSession, waves: Sequence[DataFrame], specs: Sequence[S.TableSpec] = (ORDERS,)
) -> tuple[State, C.Source, list[int]]:
    """Publish waves of messages as files and consume each as it appears.

    The checkpoint is kept, so every run resumes after the files of the run before.
    """
    source = C.Source("parquet", new_folder(spark, "feed"))
    consumer = Consumer("sluice", new_folder(spark, "state"), new_folder(spark, "checkpoint"), specs)
    applied = []
    for wave in waves:
        wave.write.mode("append").option("compression", COMPRESSION).parquet(source.path)
        results: list[BatchResult] = []
        query = start_consumer(spark, source, consumer, available_now=True, on_batch=results.append)
        query.awaitTermination()
        applied.append(sum(sum(r.applied.values()) for r in results))
    return consumer.state(spark), source, applied


# Sources ---------------------------------------------------------------------------------

def s1_read_changes(spark, sf_dir):
    path = new_folder(spark, "feed")
    D.orders_feed(spark, sf_dir).write.json(path)
    messages = C.read_changes(spark, C.Source("json", path))
    return messages.select(*EVENT, F.get_json_object("value", "$.operation").alias("operation"))


def s1_broker_arrival(spark, sf_dir):
    messages = C.with_arrival(C.message_columns(D.broker_rows(spark, sf_dir)))
    return messages.select(*S.EVENT_ID, F.col("arrival.t").alias("t"))


def s2_resume(spark, sf_dir):
    _, _, applied = _stream(spark, D.waves(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(applied, 1)), "run int, applied bigint")


def s3_start_at(spark, sf_dir):
    return C.start_at(D.orders_feed(spark, sf_dir), {0: 600, 1: 3000}).select(*EVENT)


def s4_resume_after(spark, sf_dir):
    offsets = _before(spark, sf_dir).offsets.filter("partition_id <> 3")
    return C.resume_after(D.orders_feed(spark, sf_dir), offsets).select(*EVENT)


def s5_drop_empty(spark, sf_dir):
    return C.drop_empty(D.feed_with_empty(spark, sf_dir)).select(*EVENT)


def s6_fan_out(spark, sf_dir):
    source = C.Source("parquet", new_folder(spark, "feed"))
    D.orders_feed(spark, sf_dir).write.parquet(source.path)
    late = {p: 600 for p in range(D.PARTITIONS)}
    consumers = [
        Consumer(name, new_folder(spark, "state"), new_folder(spark, "checkpoint"), (ORDERS,), positions=start)
        for name, start in (("A", {}), ("B", late))
    ]
    for query in fan_out(spark, source, consumers, available_now=True):
        query.awaitTermination()
    rows = F.count(F.lit(1))
    counts = [
        c.state(spark).ledger().agg(rows.alias("ledger_rows")).select(
            F.lit(c.name).alias("consumer"), "ledger_rows",
            c.state(spark).target(ORDERS).agg(rows).scalar().alias("target_rows"),
        )
        for c in consumers
    ]
    return counts[0].unionByName(counts[1])


def s6_one_decode(spark, sf_dir):
    """Each consumer's rows: one takes both tables, one Orders from sequence 600 on."""
    source = C.Source("parquet", new_folder(spark, "feed"))
    D.two_table_feed(spark, sf_dir).write.option("compression", COMPRESSION).parquet(source.path)
    late = {p: 600 for p in range(D.PARTITIONS)}
    consumers = [
        Consumer("A", new_folder(spark, "state"), "", BOTH),
        Consumer("B", new_folder(spark, "state"), "", (ORDERS,), positions=late),
    ]
    start_together(spark, source, consumers, new_folder(spark, "checkpoint"), available_now=True).awaitTermination()
    rows = [
        c.state(spark).target(s).select(F.lit(c.name).alias("consumer"), F.lit(s.name).alias("target"),
                                        F.col(s.key).alias("key"), "Quantity")
        for c in consumers for s in c.specs
    ]
    return A.union_all(dict(enumerate(rows)))


def s7_load_state(spark, sf_dir):
    state = _state(spark)
    apply_batch(state, D.orders_feed(spark, sf_dir))
    again = State(spark, state.path)
    return again.ledger().select(*S.EVENT_ID, "commit_lsn")


def s8_reset_state(spark, sf_dir):
    state = _state(spark)
    apply_batch(state, D.orders_feed(spark, sf_dir))
    state.reset()
    apply_batch(state, D.orders_feed(spark, sf_dir))
    return state.target(ORDERS)


def s9_commit_state(spark, sf_dir):
    state = _state(spark, BOTH)
    apply_batch(state, D.two_table_feed(spark, sf_dir))
    parts = {"ledger": state.ledger(), "offsets": state.offsets()}
    parts |= {s.name: state.target(s) for s in BOTH}
    return A.union_all({
        name: V.count_rows(df).select(F.lit(name).alias("part"), F.col("rows").alias("n"))
        for name, df in parts.items()
    })


def s10_assign_partition(spark, sf_dir):
    orders = D.read_table(spark, sf_dir, "orders").select("o_custkey")
    pairs = C.assign_partition(orders, "o_custkey").distinct()
    per_key = pairs.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("partition_id").alias("lo"), F.max("partition_id").alias("hi")
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("n").alias("key_partition_pairs"),
        F.every((F.col("lo") >= 0) & (F.col("hi") < 4)).alias("in_range"),
    )


def s11_select_published_columns(spark, sf_dir):
    orders = D.read_table(spark, sf_dir, "orders")
    return C.select_published_columns(orders, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


# Decode ----------------------------------------------------------------------------------

def d1_decode_live(spark, sf_dir):
    return X.decode_live(D.two_table_feed(spark, sf_dir)).drop("value", "row")


def d1_decode_irregular(spark, sf_dir):
    return X.accepted(X.decode_live(D.irregular_feed(spark, sf_dir))).select(
        *EVENT, "operation", "table", "key_id", "commit_lsn"
    )


def d2_unwrap_json(spark, sf_dir):
    return _events(spark, sf_dir).select(*EVENT, "key", "Orders.Product", "Orders.Company")


def d3_row_image(spark, sf_dir):
    decoded = X.decode_live(D.orders_feed(spark, sf_dir))
    return decoded.select(*EVENT, "has_row", F.col("row").isNotNull().alias("has_image"))


def d4_primary_key(spark, sf_dir):
    return X.to_table(X.decode_live(D.irregular_feed(spark, sf_dir)), ORDERS).select(*EVENT, "OrderID")


def d5_commit_lsn(spark, sf_dir):
    return X.accepted(X.decode_live(D.irregular_feed(spark, sf_dir))).select(*EVENT, "commit_lsn")


def d6_to_orders(spark, sf_dir):
    return X.to_table(X.decode_live(D.orders_feed(spark, sf_dir)), ORDERS)


def d6_irregular_values(spark, sf_dir):
    return X.to_table(X.decode_live(D.irregular_feed(spark, sf_dir)), ORDERS).select(
        *EVENT, "OrderID", "Company", "SalesDate", "EstimatedShipDate", "Quantity", "Price"
    )


def d7_to_order_lines(spark, sf_dir):
    return X.to_table(X.decode_live(D.lines_feed(spark, sf_dir)), ORDER_LINES)


def d8_decode_documented(spark, sf_dir):
    return X.to_table(X.decode_documented(D.documented_feed(spark, sf_dir)), ORDERS)


def d9_rejects(spark, sf_dir):
    return X.rejects(X.decode_live(D.irregular_feed(spark, sf_dir))).drop("value")


def d10_bad_key_rejects(spark, sf_dir):
    reasons = ["row image is no object", "bad key column"]
    found = X.rejects(_irregular(spark, sf_dir)).drop("value")
    return found.filter(F.col("reject_reason").isin(reasons))


def d11_feed_view(spark, sf_dir):
    return X.feed_view(D.two_table_feed(spark, sf_dir)).drop("received_at")


# Apply -----------------------------------------------------------------------------------

def a1_only_table(spark, sf_dir):
    return A.only_table(_headers(spark, sf_dir, BOTH), "OrderLines").select(*EVENT, "key")


def a2_subscribe(spark, sf_dir):
    events = _headers(spark, sf_dir, BOTH)
    return A.subscribe(events, ["Orders", "OrderLines"]).select(*EVENT, "table", "key")


def a3_route(spark, sf_dir):
    events = _events(spark, sf_dir, BOTH).select(*EVENT, "table", "key")
    routed = A.route(staged(events, "events"), BOTH)
    return A.union_all({
        name: df.select(F.lit(name).alias("target"), *EVENT, "key") for name, df in routed.items()
    })


def a3_route_by_schema(spark, sf_dir):
    elsewhere = replace(ORDER_LINES, schema_name="archive")
    routed = A.route(_staged_headers(spark, sf_dir, BOTH), [ORDERS, elsewhere], by_schema=True)
    return A.union_all({
        name: df.select(F.lit(name).alias("target"), "schema_name", *EVENT, "key") for name, df in routed.items()
    })


def a4_route_by_config(spark, sf_dir):
    config = spark.createDataFrame(
        [("Orders", "OrderID", ["Product varchar(100)", "Quantity int"]), ("OrderLines", "OrderLineID", ["ProductID bigint"])],
        "table_name string, key_column string, column_list array<string>",
    )
    routed = A.route_by_config(X.decode_live(D.two_table_feed(spark, sf_dir)), config, keep=True)
    first = {"Orders": ("OrderID", "Product"), "OrderLines": ("OrderLineID", "ProductID")}
    return A.union_all({
        name: df.select(
            F.lit(name).alias("target"), *EVENT, F.col(first[name][0]).cast("long").alias("key"),
            F.col(first[name][1]).cast("string").alias("first_cell"),
        )
        for name, df in routed.items()
    })


def a5_dedup_in_batch(spark, sf_dir):
    return A.dedup_in_batch(X.accepted(_events(spark, sf_dir))).select(*EVENT, "operation")


def a6_new_events(spark, sf_dir):
    ledger = _before(spark, sf_dir).ledger
    return A.new_events(X.accepted(_events(spark, sf_dir)), ledger).select(*EVENT, "operation")


def a7_classify(spark, sf_dir):
    ledger = _before(spark, sf_dir).ledger
    events = _staged_headers(spark, sf_dir).select(*EVENT, "operation")
    return A.classify(events, ledger)


def a8_last_change_per_key(spark, sf_dir):
    events = A.dedup_in_batch(X.to_table(X.decode_live(D.orders_feed(spark, sf_dir)), ORDERS))
    return A.last_change_per_key(events, "OrderID").select("OrderID", "operation", "sequence_number")


def _in_halves(feed: DataFrame, half: Column, specs: Sequence[S.TableSpec]) -> Outcome:
    """A feed applied in two batches, each decoded once: results read an applied batch several times."""
    first = materialize(feed.filter(half), specs, keep=True)
    return apply_to(feed.filter(~half), first.ledger, first.offsets, first.targets, specs, keep=True)


def _second_half(spark, sf_dir):
    return _in_halves(D.orders_feed(spark, sf_dir), D.first_half(spark, sf_dir), [ORDERS])


def a9_merge_orders(spark, sf_dir):
    return _second_half(spark, sf_dir).targets["Orders"]


def a10_merge_order_lines(spark, sf_dir):
    half = D.first_half(spark, sf_dir, per_key=8)
    return _in_halves(D.lines_feed(spark, sf_dir), half, [ORDER_LINES]).targets["OrderLines"]


def a11_unknown_operation(spark, sf_dir):
    out = materialize(D.feed_with_unknown_operations(spark, sf_dir), [ORDERS], keep=True)
    return A.union_all({
        name: V.count_rows(df).select(F.lit(name).alias("what"), F.col("rows").alias("n"))
        for name, df in (("ledger rows", out.ledger), ("target rows", out.targets["Orders"]))
    })


def a12_append_ledger(spark, sf_dir):
    return _second_half(spark, sf_dir).ledger.drop("processed_at")


def a13_upsert_offsets(spark, sf_dir):
    return _second_half(spark, sf_dir).offsets.drop("updated_at")


def a15_apply_batch(spark, sf_dir):
    state, _, _ = _stream(spark, D.waves(spark, sf_dir))
    return state.target(ORDERS)


def a16_apply_multi_table(spark, sf_dir):
    state, _, _ = _stream(spark, D.waves(spark, sf_dir, lines=True), BOTH)
    return state.offsets().drop("updated_at")


def a16_multi_table_lines(spark, sf_dir):
    state = _state(spark, BOTH)
    _apply_waves(state, D.waves(spark, sf_dir, lines=True))
    return state.target(ORDER_LINES)


def a17_apply_partitions(spark, sf_dir):
    state = _state(spark)
    apply_batch(state, D.orders_feed(spark, sf_dir))
    applied = state.ledger().groupBy("partition_id").agg(F.count(F.lit(1)).alias("applied"))
    return applied.join(state.offsets(), "partition_id").select(
        "partition_id", "applied", "last_sequence_number"
    )


def a18_assign_batches(spark, sf_dir):
    return A.assign_batches(_staged_headers(spark, sf_dir).select(*EVENT), 100)


def a18_assign_broker_batches(spark, sf_dir):
    rows = C.with_arrival(C.message_columns(D.broker_rows(spark, sf_dir)))
    return A.assign_batches(rows.select(*EVENT), 100).select(*S.EVENT_ID, "batch")


def a19_replay(spark, sf_dir):
    state, source, _ = _stream(spark, [D.orders_feed(spark, sf_dir)])
    again = Consumer("again", state.path, new_folder(spark, "checkpoint"), (ORDERS,))
    start_consumer(spark, source, again, available_now=True).awaitTermination()
    return state.target(ORDERS)


def a20_abort_batch(spark, sf_dir):
    state = _state(spark)
    first, rest, _ = D.waves(spark, sf_dir)
    apply_batch(state, first)

    def crash() -> None:
        raise InterruptedError("stopped before the commit")

    try:
        apply_batch(state, rest, before_commit=crash)
    except InterruptedError:
        pass
    return state.target(ORDERS).select("OrderID", "Quantity")


def a21_materialize(spark, sf_dir):
    return _orders(spark, sf_dir)


# Views -----------------------------------------------------------------------------------

def v1_ledger_view(spark, sf_dir):
    return V.ledger_view(_committed(spark, sf_dir).ledger()).drop("processed_at")


def v2_latest_offset(spark, sf_dir):
    return V.latest_offset(_committed(spark, sf_dir).offsets()).drop("updated_at")


def v3_offsets_by_partition(spark, sf_dir):
    return V.offsets_by_partition(_all_applied(spark, sf_dir).offsets).drop("updated_at")


def v4_count_rows(spark, sf_dir):
    return V.count_rows(_orders(spark, sf_dir))


def v5_top_orders(spark, sf_dir):
    return V.top_orders(_orders(spark, sf_dir))


def v6_top_order_lines(spark, sf_dir):
    return V.top_order_lines(_lines(spark, sf_dir))


def v5_top_committed_orders(spark, sf_dir):
    """Out of a committed state: only files that can hold one of the highest keys are opened."""
    return V.top_orders(top_rows(_merged_then_changed(spark, sf_dir, [ORDERS]), ORDERS, 50))


def v6_top_committed_lines(spark, sf_dir):
    return V.top_order_lines(top_rows(_merged_then_changed(spark, sf_dir, BOTH, lines=True), ORDER_LINES, 50))


def v6_line_totals(spark, sf_dir):
    return V.with_line_total(_lines(spark, sf_dir)).select("OrderLineID", "LineTotal")


def v7_apply_counts(spark, sf_dir):
    return V.apply_counts(A.classify(_staged_headers(spark, sf_dir)))


def v8_recent_log(spark, sf_dir):
    return V.recent_log(A.classify(_staged_headers(spark, sf_dir)), BOTH)


def v8_recent_applied(spark, sf_dir):
    """Out of a committed state: only folders that can hold one of the last events are opened."""
    return recent_events(_committed(spark, sf_dir), 200)


def v9_partition_log(spark, sf_dir):
    return V.partition_log(A.classify(_staged_headers(spark, sf_dir)))


def v9_loaded_partition_log(spark, sf_dir):
    return V.loaded_partition_log(_all_applied(spark, sf_dir).ledger)


def v10_backlog(spark, sf_dir):
    return V.backlog(_headers(spark, sf_dir).withColumn("reject_reason", F.lit(None)), _before(spark, sf_dir).ledger, [ORDERS])


def v10_backlog_irregular(spark, sf_dir):
    first = decode(D.irregular_feed(spark, sf_dir).filter("sequence_number % 2 = 0"), [ORDERS])
    applied = A.dedup_in_batch(X.accepted(first))
    return V.backlog(_irregular(spark, sf_dir), A.ledger_rows(applied), BOTH)


def v11_quarantine(spark, sf_dir):
    return V.quarantine(_irregular(spark, sf_dir)).drop("value", "rejected_at")


def v12_key_skew(spark, sf_dir):
    return V.key_skew(_headers(spark, sf_dir), "key")


def v12_key_skew_irregular(spark, sf_dir):
    return V.key_skew(X.accepted(_irregular(spark, sf_dir)), "key")


def v12_events_per_user(spark, sf_dir):
    return V.events_per_key(D.read_table(spark, sf_dir, "events"), "user_id")


def v12_frequent_users(spark, sf_dir):
    """The 100 hottest users by summaries of three parts of the events, merged."""
    events, keys = D.read_table(spark, sf_dir, "events"), ["user_id"]
    parts = [K.key_summary(events.filter(F.pmod("event_id", F.lit(3)) == p), keys, 100) for p in range(3)]
    return K.frequent_keys(K.merged_summaries(parts, keys, 100), keys)


def v12_frequent_keys(spark, sf_dir):
    """The hottest keys of a committed history, most of whose events were folded."""
    state = _state(spark, BOTH)
    state.fold_count, state.hot_keys = 1, 1_000_000
    for wave in D.waves(spark, sf_dir, lines=True):
        apply_batch(state, wave, read_once=True)
        state.maintain()
    return state.frequent_keys()


def v12_partition_skew(spark, sf_dir):
    return V.partition_skew(_headers(spark, sf_dir))


def v13_events_per_second(spark, sf_dir):
    return V.events_per_second(C.message_columns(D.broker_rows(spark, sf_dir)), "broker_time")


def v13_stream_rates(spark, sf_dir):
    """The same on a stream that is stopped half-way and goes on from its checkpoint."""
    rows = D.broker_rows(spark, sf_dir).drop("key")
    source = C.Source("parquet", new_folder(spark, "feed"), schema=rows.schema)
    path, checkpoint = new_folder(spark, "rates"), new_folder(spark, "checkpoint")
    for part in range(2):
        rows.filter(F.shiftright("offset", 3) % 2 == part).write.mode("append").parquet(source.path)
        start_rates(spark, source, path, checkpoint, available_now=True).awaitTermination()
    return stream_rates(spark, path)


def v13_replay_counts(spark, sf_dir):
    return V.replay_counts(D.orders_feed(spark, sf_dir))


def v13_ledger_growth(spark, sf_dir):
    return V.ledger_growth(_all_applied(spark, sf_dir).ledger)


def v15_feed_count(spark, sf_dir):
    return V.feed_count(X.feed_view(D.two_table_feed(spark, sf_dir)))


def v15_feed_newest_first(spark, sf_dir):
    feed = V.feed_newest_first(X.feed_view(D.orders_feed(spark, sf_dir)))
    return feed.select(*EVENT, "operation", "primary_key")


def v16_latest_errors(spark, sf_dir):
    errors = D.read_table(spark, sf_dir, "events").filter("event_type = 'error'")
    return V.latest_errors(errors, "ts", ["event_id"]).select("event_id", "event_type", "value", "ts")


def v16_latest_quarantine(spark, sf_dir):
    letters = V.quarantine(_irregular(spark, sf_dir))
    return V.latest_errors(letters, "sequence_number", ["partition_id"]).drop("value", "rejected_at")


def v17_ship_date(spark, sf_dir):
    orders = D.read_table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", V.ship_date(F.col("o_orderdate")).alias("ship_date"))


def v18_next_key(spark, sf_dir):
    return V.next_key(_orders(spark, sf_dir), "OrderID")


def v19_update_latest(spark, sf_dir):
    changed = V.update_latest(
        staged(_orders(spark, sf_dir), "orders"), "OrderID", {"Quantity": F.lit(7), "Price": F.lit("22.00")}
    )
    return changed.select("OrderID", "Quantity", "Price")


def v19_delete_where(spark, sf_dir):
    return V.delete_where(_orders(spark, sf_dir), F.col("Company") == "F")


def v20_change_mask(spark, sf_dir):
    decoded = X.decode_documented(D.documented_feed(spark, sf_dir))
    mask = V.change_mask(decoded, MASKED)
    return mask.select(*EVENT, "operation", F.array_join("changed", ",").alias("changed"))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    s1_read_changes, s1_broker_arrival, s2_resume, s3_start_at, s4_resume_after, s5_drop_empty,
    s6_fan_out, s6_one_decode, s7_load_state, s8_reset_state, s9_commit_state, s10_assign_partition,
    s11_select_published_columns,
    d1_decode_live, d1_decode_irregular, d2_unwrap_json, d3_row_image, d4_primary_key,
    d5_commit_lsn, d6_to_orders, d6_irregular_values, d7_to_order_lines, d8_decode_documented,
    d9_rejects, d10_bad_key_rejects, d11_feed_view,
    a1_only_table, a2_subscribe, a3_route, a3_route_by_schema, a4_route_by_config, a5_dedup_in_batch, a6_new_events,
    a7_classify, a8_last_change_per_key, a9_merge_orders, a10_merge_order_lines,
    a11_unknown_operation, a12_append_ledger, a13_upsert_offsets,
    a15_apply_batch, a16_apply_multi_table, a16_multi_table_lines, a17_apply_partitions,
    a18_assign_batches, a18_assign_broker_batches, a19_replay, a20_abort_batch, a21_materialize,
    v1_ledger_view, v2_latest_offset, v3_offsets_by_partition, v4_count_rows, v5_top_orders, v5_top_committed_orders,
    v6_top_order_lines, v6_top_committed_lines, v6_line_totals, v7_apply_counts, v8_recent_log, v8_recent_applied, v9_partition_log,
    v9_loaded_partition_log, v10_backlog, v10_backlog_irregular, v11_quarantine, v12_key_skew, v12_key_skew_irregular, v12_events_per_user,
    v12_frequent_users, v12_frequent_keys, v12_partition_skew, v13_events_per_second, v13_stream_rates, v13_replay_counts, v13_ledger_growth,
    v15_feed_count, v15_feed_newest_first, v16_latest_errors, v16_latest_quarantine,
    v17_ship_date, v18_next_key, v19_update_latest, v19_delete_where, v20_change_mask,
]


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _prepared(q) for q in QUERIES}
