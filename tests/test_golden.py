"""Fixed scenarios: duplicates, late starters, partitions, two tables, batches, replay, crash."""

import pytest
from helpers import feed, message, rows
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators import apply as A, views
from sluice.plans.materialize import apply_to, decode, materialize
from sluice.session import new_folder
from sluice.sources.changes import start_at
from sluice.streaming.consumer import apply_batch, apply_in_batches, replay
from sluice.streaming.state import State


def order(op, key, product=None, lsn=None, **cells):
    row = None if op == "DEL" else {"OrderID": key, "Product": product, **cells}
    return message(op, key, row, lsn=lsn, data_text=key % 2 == 0, row_text=key % 2 == 0)


def line(op, key, order_id=1, product=9, quantity=2, price=11.0, lsn=None):
    row = {"OrderLineID": key, "OrderID": order_id, "ProductID": product, "Quantity": quantity, "UnitPrice": price}
    return message(op, key, None if op == "DEL" else row, table="OrderLines", lsn=lsn)


def new_state(spark, *specs):
    return State(spark, new_folder(spark, "state"), specs or (S.ORDERS,))


DUPLICATE_REPLAY = [
    (0, 100, order("INS", 1, "Pending", "LSN_500")),
    (0, 101, order("UPD", 1, "Shipped", "LSN_501")),
    (0, 101, order("UPD", 1, "Shipped", "LSN_501")),
]


def test_duplicate_replay(spark):
    messages = feed(spark, DUPLICATE_REPLAY)
    out = materialize(messages)
    assert rows(out.ledger, "partition_id", "sequence_number", "commit_lsn") == [
        (0, 100, "LSN_500"), (0, 101, "LSN_501"),
    ]
    assert rows(out.offsets.drop("updated_at", "last_arrival")) == [(0, 101, "LSN_501")]
    assert rows(out.targets["Orders"], "OrderID", "Product") == [(1, "Shipped")]
    flags = A.classify(decode(messages)).orderBy("arrival").select("applied").collect()
    assert [r[0] for r in flags] == [True, True, False]


def test_two_consumers(spark):
    stream = feed(spark, [
        (0, 100, order("INS", 1, "a", "LSN_500")),
        (0, 101, order("UPD", 1, "b", "LSN_501")),
        (0, 102, order("UPD", 1, "c", "LSN_502")),
        (0, 103, order("DEL", 1, lsn="LSN_503")),
        (0, 104, order("INS", 2, "d", "LSN_504")),
    ])
    for first in (100, 102):
        out = materialize(start_at(stream, {0: first}))
        assert rows(out.ledger, "sequence_number") == [(n,) for n in range(first, 105)]
        assert rows(out.offsets.drop("updated_at", "last_arrival")) == [(0, 104, "LSN_504")]
        assert rows(out.targets["Orders"], "OrderID") == [(2,)]


def test_four_partitions(spark):
    stream = feed(spark, [
        (p, 100 + i, order(op, 10 * p + 1, "x", f"LSN_{p}_{100 + i}"))
        for i, op in enumerate(["INS", "UPD", "DEL"]) for p in range(4)
    ])
    out = materialize(stream)
    assert out.ledger.count() == 12
    assert rows(out.offsets.drop("updated_at", "last_arrival")) == [(p, 102, f"LSN_{p}_102") for p in range(4)]
    assert out.targets["Orders"].count() == 0
    turns = A.assign_batches(decode(stream), 1).groupBy("batch").count()
    assert rows(turns) == [(1, 4), (2, 4), (3, 4)]


def test_two_tables_share_one_ledger(spark):
    stream = feed(spark, [
        (0, 200, order("INS", 1, "Pending", "LSN_700")),
        (0, 201, line("INS", 1, 1, 9, 2, lsn="LSN_701")),
        (0, 202, order("UPD", 1, "Shipped", "LSN_702")),
        (0, 203, line("INS", 2, 1, 4, 1, lsn="LSN_703")),
        (0, 204, line("DEL", 1, lsn="LSN_704")),
    ])
    state = new_state(spark, S.ORDERS, S.ORDER_LINES)
    result = apply_batch(state, stream)
    assert dict(result.applied) == {"Orders": 2, "OrderLines": 3}
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == [(1, "Shipped")]
    assert rows(state.target(S.ORDER_LINES), "OrderLineID", "ProductID") == [(2, 4)]
    assert state.ledger().count() == 5
    assert rows(state.offsets().drop("updated_at", "last_arrival")) == [(0, 204, "LSN_704")]


def batching_messages():
    return [
        (0, 300 + i, order(["INS", "UPD", "DEL"][i % 3], i + 1, "x", f"LSN_{300 + i}"))
        for i in range(12)
    ]


def test_batches_of_five_and_a_crash(spark):
    messages = batching_messages()
    numbered = A.assign_batches(decode(feed(spark, messages)), 5)
    assert rows(numbered.groupBy("batch").count()) == [(1, 5), (2, 5), (3, 2)]

    state = new_state(spark)
    parts = [feed(spark, messages[a:a + 5]) for a in (0, 5, 10)]
    apply_batch(state, parts[0])

    def crash():
        raise RuntimeError("crash before commit")

    with pytest.raises(RuntimeError, match="crash"):
        apply_batch(state, parts[1], before_commit=crash)
    assert state.ledger().count() == 5
    assert rows(state.offsets(), "last_sequence_number") == [(304,)]
    assert rows(state.target(S.ORDERS), "OrderID") == [(1,), (2,), (4,), (5,)]

    seen = []
    for part in parts[1:]:
        apply_batch(state, part)
        seen.append((state.ledger().count(), state.offsets().first()["last_sequence_number"]))
    assert seen == [(10, 309), (12, 311)]
    assert [r["OrderID"] for r in state.target(S.ORDERS).orderBy("OrderID").collect()] == [1, 2, 4, 5, 7, 8, 10, 11]


def test_demo_script(spark):
    first = dict(CustomerFirstName="Ann", CustomerLastName="Lee", Company="Acme",
                 SalesDate="2026-04-20", EstimatedShipDate="2026-07-04", ShippingID=1,
                 ShippingLocation="Harbour")
    lines = [line("INS", 1, 1, 9, 2), line("UPD", 1, 1, 9, 3), line("DEL", 1)]
    stream = feed(spark, [
        (0, 1, order("INS", 1, "Kettle", Quantity=1, Price=11.0, **first)),
        (0, 2, order("UPD", 1, "Kettle", Quantity=2, Price=22.0, **first)),
        (0, 3, order("INS", 2, "Widget", Quantity=1, Price=1.0)),
        (0, 4, order("DEL", 2)),
        *[(0, 5 + i, v) for i, v in enumerate(lines)],
    ])
    out = materialize(stream, [S.ORDERS, S.ORDER_LINES])
    assert out.ledger.count() == 7
    found = out.targets["Orders"].select(
        "OrderID", "Quantity", F.col("Price").cast("string"), F.col("SalesDate").cast("string"),
        F.col("EstimatedShipDate").cast("string"), "CustomerFirstName", "ShippingLocation",
    )
    assert rows(found) == [(1, 2, "22.00", "2026-04-20", "2026-07-04", "Ann", "Harbour")]
    assert out.targets["OrderLines"].count() == 0


def snapshot(state):
    return (
        rows(state.ledger()), rows(state.offsets()), state.manifest()["version"],
        [rows(state.target(s)) for s in state.specs],
    )


def test_replay_changes_nothing(spark):
    state = new_state(spark)
    messages = feed(spark, batching_messages())
    apply_batch(state, messages)
    before = snapshot(state)
    again = replay(state, messages)
    assert (dict(again.applied), again.rejected) == ({}, 0)
    assert snapshot(state) == before


def test_reset_then_replay_applies_again(spark):
    state = new_state(spark)
    messages = feed(spark, DUPLICATE_REPLAY)
    apply_batch(state, messages)
    state.reset()
    assert state.ledger().count() == state.offsets().count() == state.target(S.ORDERS).count() == 0
    assert replay(state, messages).applied == {"Orders": 2}
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == [(1, "Shipped")]


def test_event_at_a_time_equals_one_batch(spark):
    messages = batching_messages() + DUPLICATE_REPLAY
    one_by_one, at_once = new_state(spark), new_state(spark)
    apply_in_batches(one_by_one, [feed(spark, [m]) for m in messages])
    apply_batch(at_once, feed(spark, messages))
    for table in ("ledger", "offsets"):
        left, right = (
            rows(getattr(s, table)().drop("processed_at", "updated_at", "arrival", "last_arrival"))
            for s in (one_by_one, at_once)
        )
        assert left == right
    assert rows(one_by_one.target(S.ORDERS)) == rows(at_once.target(S.ORDERS))


def test_unknown_operation_and_missing_rows(spark):
    stream = feed(spark, [
        (0, 1, order("UPD", 5, "from update")),
        (0, 2, order("DEL", 6)),
        (0, 3, message("TRUNCATE", 5)),
        (0, 4, message("UPD", 7)),
        (0, 5, order("INS", 8, "x")),
        (0, 6, order("INS", 8, None)),
        (1, 9, order("INS", 9, "late")),
        (1, 2, order("UPD", 9, "last by arrival")),
    ])
    out = materialize(stream)
    assert rows(out.targets["Orders"], "OrderID", "Product") == [
        (5, "from update"), (7, None), (8, None), (9, "last by arrival"),
    ]
    assert out.ledger.count() == 8
    assert rows(out.offsets, "partition_id", "last_sequence_number") == [(0, 6), (1, 2)]


def test_pure_apply_on_given_state(spark):
    first = materialize(feed(spark, DUPLICATE_REPLAY[:1]))
    out = apply_to(feed(spark, DUPLICATE_REPLAY), first.ledger, first.offsets, first.targets)
    assert out.applied.count() == 1 and out.ledger.count() == 2
    assert rows(out.offsets, "last_sequence_number") == [(101,)]
    assert rows(out.targets["Orders"], "Product") == [("Shipped",)]


def test_rejects_go_to_quarantine_once(spark):
    bad = line("INS", 3)
    bad = bad.replace('"Quantity": 2', '"Quantity": null')
    stream = feed(spark, [(0, 1, "not json"), (0, 2, bad), (0, 3, line("INS", 4)), (0, 1, "not json")])
    state = new_state(spark, S.ORDERS, S.ORDER_LINES)
    result = apply_batch(state, stream)
    assert (dict(result.applied), result.rejected) == ({"OrderLines": 1}, 2)
    again = replay(state, stream)
    assert (dict(again.applied), again.rejected) == ({}, 0)
    found = rows(state.quarantine(), "sequence_number", "reject_reason", "value")
    assert found == [(1, "bad message", "not json"), (2, "value does not fit the table", bad)]
    assert rows(state.ledger(), "sequence_number") == [(3,)]


def test_state_maintenance_keeps_every_row(spark):
    state = new_state(spark)
    state.fold_count = 2
    state.merge_share = 1e9
    messages = batching_messages()
    for a in range(0, 12, 2):
        apply_batch(state, feed(spark, messages[a:a + 2]))
    before = rows(state.target(S.ORDERS)), rows(state.ledger()), rows(state.offsets())
    state.maintain()
    folded = state.manifest()
    assert len(folded["ledger"]) == 1 and len(folded["targets"]["Orders"]["changes"]) == 1
    assert (rows(state.target(S.ORDERS)), rows(state.ledger()), rows(state.offsets())) == before
    state.merge_share = 0.0
    state.maintain()
    assert state.manifest()["targets"]["Orders"]["changes"] == []
    assert rows(state.target(S.ORDERS)) == before[0]
    assert replay(state, feed(spark, messages)).applied == {}


def test_views(spark):
    stream = feed(spark, DUPLICATE_REPLAY + [(1, 7, order("INS", 4, "w", "LSN_9"))])
    events = decode(stream)
    classified = A.classify(events)
    assert rows(views.apply_counts(classified)) == [(3, 1, 7, "LSN_9")]
    log = views.recent_log(classified, [S.ORDERS], 3).collect()
    assert [(r["sequence_number"], r["applied"], r["key_text"]) for r in log] == [
        (7, True, "OrderID=4"), (101, False, "OrderID=1"), (101, True, "OrderID=1"),
    ]
    assert rows(views.partition_log(classified), "partition_id", "sequence_number", "op") == [
        (0, 100, "INS"), (0, 101, "DUP"), (0, 101, "UPD"), (1, 7, "INS"),
    ]
    ledger = materialize(feed(spark, DUPLICATE_REPLAY[:1])).ledger
    assert rows(views.backlog(events, ledger, [S.ORDERS])) == [
        (0, 1, "seq 101 UPD OrderID=1", ""), (1, 1, "seq 7 INS OrderID=4", ""),
    ]
    orders = materialize(stream).targets["Orders"]
    assert [r["line"] for r in views.top_orders(orders, 1).collect()] == ["OrderID=4 · w · Qty 0 · 0.00"]
    changed = views.update_latest(orders, "OrderID", {"Quantity": F.lit(2)})
    assert rows(changed, "OrderID", "Quantity") == [(1, None), (4, 2)]
    assert rows(views.delete_where(orders, F.col("Product") == "w"), "OrderID") == [(1,)]
    assert views.next_key(orders, "OrderID").first()[0] == 5
