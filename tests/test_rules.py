"""Rules that whole feeds rarely touch: arrival against sequence, rejects in views, kinds, dates, settings."""

import json
from dataclasses import replace

import pytest
from helpers import feed, message, rows
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators import apply as A, decode as X, views
from sluice.plans import oracles, registered
from sluice.plans.materialize import decode, materialize
from sluice.session import SETTINGS, new_folder
from sluice.sources import changes as C, derived as D
from sluice.streaming.consumer import apply_batch
from sluice.streaming.state import State


def order(op, key, table="Orders", **cells):
    return message(op, key, None if op == "DEL" else {"OrderID": key, **cells}, table=table, lsn=f"L{key}")


OUT_OF_ORDER = [(3, 5, order("INS", 1)), (2, 9, order("INS", 2)), (0, 7, order("INS", 3)), (1, 2, order("INS", 4)), (1, 1, order("INS", 5))]


def test_views_follow_arrival(spark):
    state = State(spark, new_folder(spark, "state"))
    apply_batch(state, feed(spark, OUT_OF_ORDER))
    shown = views.ledger_view(state.ledger()).select("partition_id", "sequence_number").collect()
    assert [tuple(r) for r in shown] == [(3, 5), (2, 9), (0, 7), (1, 2), (1, 1)]
    last = views.latest_offset(state.offsets()).first()
    assert (last["partition_id"], last["last_sequence_number"], last["last_arrival"]) == (1, 1, 4)


def test_backlog_and_skew_leave_rejects_out(spark):
    stream = feed(spark, [
        (0, 1, order("INS", 1)), (0, 2, "{broken"), (0, 2, order("UPD", 1)), (0, 3, "{broken"), (0, 4, order("INS", 2)),
    ])
    events = decode(stream)
    ledger = materialize(feed(spark, [(0, 1, order("INS", 1))])).ledger
    assert rows(views.backlog(events, ledger, [S.ORDERS])) == [(0, 2, "seq 2 UPD OrderID=1", "+1 more")]
    both = views.backlog(events, ledger, [S.ORDERS, S.ORDER_LINES])
    assert rows(both, "next_event") == [("seq 2 UPD on dbo.Orders",)]
    skew = views.key_skew(X.accepted(events), "key").first()
    assert (skew["keys"], skew["events"], skew["hottest_key_events"]) == (2, 3, 2)


def test_log_names_the_key_of_each_table(spark):
    line = message("INS", 8, {"OrderLineID": 8, "OrderID": 1, "ProductID": 2, "Quantity": 1, "UnitPrice": 3}, table="OrderLines")
    specs = [S.ORDERS, S.ORDER_LINES]
    events = A.classify(decode(feed(spark, [(0, 1, order("INS", 1)), (0, 2, line)]), specs))
    log = views.recent_log(events, specs).collect()
    assert [r["key_text"] for r in log] == ["OrderLineID=8", "OrderID=1"]


def test_rejects_of_other_tables_are_not_kept(spark):
    other = json.loads(order("INS", 1, table="Customers"))
    other["data"]["eventsource"]["transaction"] = None
    mine = json.loads(order("INS", 2))
    mine["data"]["eventsource"]["transaction"] = None
    state = State(spark, new_folder(spark, "state"))
    stream = feed(spark, [(0, 1, json.dumps(other)), (0, 2, json.dumps(mine)), (0, 3, "?")])
    assert apply_batch(state, stream).rejected == 2
    assert rows(state.quarantine(), "sequence_number", "reject_reason") == [(2, "bad transaction"), (3, "bad message")]


@pytest.mark.parametrize("text", [
    "04/20/2026", "4/20/2026 10:00:00", "04/20/2026 10:00 AM", "2026/04/20", "2026/4/20 23:59:59", "April 20, 2026",
    "Apr 20, 2026", "20 April 2026", "20 Apr 2026 10:00", "Mon, 20 Apr 2026 10:00:00 GMT", "2026-04-20", "2026-04-20T23:30:00",
    "2026-04-21T01:30:00+03:00",
])
def test_dates(spark, text):
    typed = X.to_orders(X.decode_live(feed(spark, [(0, 1, order("INS", 1, SalesDate=text))]))).first()
    assert str(typed["SalesDate"]) == "2026-04-20"


@pytest.mark.parametrize("text", ["20/04/2026", "April 2026", "2026-04-20 tomorrow", "Apr 31, 2026", "04/20/26"])
def test_no_dates(spark, text):
    typed = X.to_orders(X.decode_live(feed(spark, [(0, 1, order("INS", 1, SalesDate=text))]))).first()
    assert typed["SalesDate"] is None


def test_text_sizes_count_utf16_units(spark):
    stream = feed(spark, [
        (0, 1, order("INS", 1, CustomerFirstName="\U0001F642" * 25)), (0, 2, order("INS", 2, CustomerFirstName="\U0001F642" * 26)),
        (0, 3, order("INS", 3, CustomerFirstName="é" * 50)), (0, 4, order("INS", 4, CustomerFirstName="é" * 51)),
    ])
    found = decode(stream).select("sequence_number", "reject_reason").collect()
    assert {r[0]: r[1] is None for r in found} == {1: True, 2: False, 3: True, 4: False}


def test_change_of_kind_is_a_change(spark):
    def change(before, after):
        return json.dumps({"data": {
            "operation": "UPDATE", "schema": "dbo", "table": "Orders", "primaryKey": {"OrderID": 1},
            "before": before, "after": after, "commitLsn": "L",
        }})

    stream = feed(spark, [
        (0, 1, change({"Quantity": 1}, {"Quantity": "1"})), (0, 2, change({"Quantity": 1}, {"Quantity": 1})),
        (0, 3, change({"Quantity": None}, {})), (0, 4, change({"Quantity": True}, {"Quantity": "true"})),
        (0, 5, change({"Quantity": None}, {"Quantity": "null"})),
    ])
    mask = views.change_mask(X.decode_documented(stream), ["Quantity"])
    assert {r["sequence_number"]: r["changed"] for r in mask.collect()} == {
        1: ["Quantity"], 2: [], 3: [], 4: ["Quantity"], 5: ["Quantity"],
    }


def test_config_gives_specs(spark):
    config = spark.createDataFrame(
        [("Orders", "OrderID", ["Product varchar(3)", "Quantity int", "Note"])],
        "table_name string, key_column string, column_list array<string>",
    )
    bad_key = json.loads(order("INS", 1))
    bad_key["data"]["eventsource"]["pkkey"] = []
    bad_key["data"]["eventrow"]["current"] = {"OrderID": 1.5}
    stream = feed(spark, [
        (0, 1, order("INS", 1, Product="abc", Quantity=2, Note="x")), (0, 2, json.dumps(bad_key)), (0, 3, order("INS", 3, Product="abcd")),
    ])
    decoded = X.decode_live(stream)
    assert rows(A.route_by_config(decoded, config)["Orders"], "OrderID", "Product", "Quantity", "Note") == [(1, "abc", 2, "x")]
    [spec] = A.specs_from_config(config)
    assert rows(X.rejects(X.typed_events(decoded, [spec])), "sequence_number", "reject_reason") == [
        (2, "bad key column"), (3, "value does not fit the table"),
    ]


def test_route_by_schema(spark):
    events = decode(feed(spark, [(0, 1, order("INS", 1))]))
    routed = A.route(events, [S.ORDERS], by_schema=True)
    assert routed["Orders"].count() == 1
    assert A.route(events, [replace(S.ORDERS, schema_name="x")], by_schema=True)["Orders"].count() == 0


def test_large_keys(spark):
    stream = feed(spark, [(0, 1, order("INS", 3_000_000_000)), (0, 2, order("INS", 7))])
    assert rows(materialize(stream, [D.ORDERS]).targets["Orders"], "OrderID") == [(3_000_000_000,), (7,)]
    small = decode(stream).select("sequence_number", "key").collect()
    assert {r[0]: r[1] for r in small} == {1: 0, 2: 7}  # out of an INT key's range: as if absent


def test_unknown_offset_keeps_its_partition(spark):
    messages = feed(spark, [(p, s, "x") for p in (0, 1) for s in (1, 2)])
    offsets = spark.createDataFrame([(0, None), (1, 1)], "partition_id int, last_sequence_number long")
    assert rows(C.resume_after(messages, offsets), "partition_id", "sequence_number") == [(0, 1), (0, 2), (1, 2)]


def test_settings_are_required(spark):
    name = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(name, "false")
    try:
        with pytest.raises(ValueError, match="prepare"):
            X.decode_live(feed(spark, OUT_OF_ORDER))
        with pytest.raises(ValueError, match="prepare"):
            State(spark, new_folder(spark, "state"))
    finally:
        spark.conf.set(name, SETTINGS[name])


def test_broker_start():
    broker = C.Source("kafka", options={"subscribe": "t", "partitions": "2"})
    assert C.start_option(broker, {1: 7}) == '{"t": {"0": -2, "1": 7}}'
    assert C.start_option(broker, {}) == "earliest"
    assert C.start_option(C.Source("parquet", "/x"), {1: 7}) == "earliest"


def test_append_times_need_no_shuffle(spark):
    raw = spark.range(10).selectExpr(
        "CAST(id % 2 AS INT) AS partition", "id AS offset", "timestamp_seconds(id) AS timestamp", "CAST(CAST(id AS STRING) AS BINARY) AS value",
    )
    events = X.decode_live(C.with_arrival(C.message_columns(raw), monotone=True))
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Range (") == 1


def test_broker_rows_are_numbered(spark):
    raw = spark.range(25).selectExpr(
        "0 AS partition", "id AS offset", "timestamp_seconds(100 - id) AS timestamp", "CAST(CAST(id AS STRING) AS BINARY) AS value",
    )
    batches = A.assign_batches(C.with_arrival(C.message_columns(raw)), 10).collect()
    assert {r["sequence_number"]: r["batch"] for r in batches} == {n: n // 10 + 1 for n in range(25)}


def test_offsets_by_sequence_would_fail(spark, tmp_path):
    """The derived feed tells the event that arrived last from the one with the highest sequence."""
    spark.range(1, 400).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "DATE '2020-01-01' AS o_orderdate",
        "'1-URGENT' AS o_orderpriority", "CAST(id AS DOUBLE) AS o_totalprice",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    events = D.order_changes(spark, str(tmp_path)).filter(~D.is_replay())
    per_partition = events.groupBy("partition_id").agg(
        F.max_by("sequence_number", "arrival").alias("last"), F.max("sequence_number").alias("highest")
    )
    assert all(r["last"] != r["highest"] for r in per_partition.collect())
    assert "arg_max(sequence_number, arrival)" in oracles.oracle_sql()["a13_upsert_offsets"]
    assert {"a13_upsert_offsets", "a16_apply_multi_table", "v3_offsets_by_partition"} <= set(registered.queries())
