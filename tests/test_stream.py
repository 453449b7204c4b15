"""Streams: resume, restart, fan-out, broker columns, positions."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from helpers import feed, message, rows
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.session import new_folder
from sluice.sources import changes as C
from sluice.operators import decode as X
from sluice.streaming import consumer as streaming
from sluice.streaming.consumer import Consumer, batch_metrics, fan_out, start_consumer, start_together, waiting
from sluice.streaming.rates import start_rates, stream_rates


def order(op, key, product):
    return message(op, key, {"OrderID": key, "Product": product}, lsn=f"{op}{key}")


def publish(spark, source, messages):
    feed(spark, messages).coalesce(1).write.mode("append").parquet(source.path)


def run(spark, source, consumer):
    results = []
    query = start_consumer(spark, source, consumer, available_now=True, on_batch=results.append)
    query.awaitTermination()
    return [dict(r.applied) for r in results], query


def test_resume_restart_and_replay(spark):
    source = C.Source("parquet", new_folder(spark, "feed"))
    consumer = Consumer("c", new_folder(spark, "state"), new_folder(spark, "checkpoint"))
    publish(spark, source, [(0, 1, order("INS", 1, "a")), (1, 1, order("INS", 2, "b"))])
    assert run(spark, source, consumer)[0] == [{"Orders": 2}]
    publish(spark, source, [(0, 2, order("UPD", 1, "c")), (1, 1, order("INS", 2, "b"))])
    applied, query = run(spark, source, consumer)
    assert applied == [{"Orders": 1}]  # kept checkpoint: only the new file was read
    assert batch_metrics(query)[0]["rows"] == 2
    again = Consumer("c2", consumer.state_path, new_folder(spark, "checkpoint"))
    assert run(spark, source, again)[0] == [{}]  # new checkpoint: all read, all known
    state = consumer.state(spark)
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == [(1, "c"), (2, "b")]
    assert rows(state.offsets(), "partition_id", "last_sequence_number") == [(0, 2), (1, 1)]


def test_consumers_share_nothing(spark):
    source = C.Source("parquet", new_folder(spark, "feed"))
    publish(spark, source, [(0, 100 + n, order("INS", n, "x")) for n in range(5)])
    a, b = (
        Consumer(n, new_folder(spark, "state"), new_folder(spark, "checkpoint"), positions=p)
        for n, p in (("A", {}), ("B", {0: 102}))
    )
    for query in fan_out(spark, source, [a, b], available_now=True):
        query.awaitTermination()
    assert rows(a.state(spark).ledger(), "sequence_number") == [(n,) for n in range(100, 105)]
    assert rows(b.state(spark).ledger(), "sequence_number") == [(n,) for n in range(102, 105)]
    b.state(spark).reset()
    assert a.state(spark).ledger().count() == 5


def test_broker_columns_and_default_arrival(spark):
    def at(second):
        return datetime(2026, 1, 1, 0, 0, second)

    raw = spark.createDataFrame(
        [(0, 1, at(5), b"a"), (0, 2, at(3), b"b"), (1, 1, at(4), b"c")],
        "partition int, offset long, timestamp timestamp, value binary",
    )
    messages = C.with_arrival(C.message_columns(raw))
    ordered = messages.orderBy("arrival").select("partition_id", "sequence_number", "value").collect()
    # The second message of partition 0 never sorts before its first, whatever its time says.
    assert [tuple(r) for r in ordered] == [(1, 1, "c"), (0, 1, "a"), (0, 2, "b")]
    own = feed(spark, [(0, 1, "x")])
    assert C.with_arrival(own).columns == own.columns


def test_positions(spark):
    messages = feed(spark, [(p, s, "x") for p in (0, 1) for s in (1, 2, 3)])
    assert rows(C.start_at(messages, {0: 3}), "partition_id", "sequence_number") == [(0, 3), (1, 1), (1, 2), (1, 3)]
    assert C.start_at(messages, {}).count() == 6
    offsets = spark.createDataFrame([(0, 2)], "partition_id int, last_sequence_number long")
    assert rows(C.resume_after(messages, offsets), "partition_id", "sequence_number") == [(0, 3), (1, 1), (1, 2), (1, 3)]
    assert C.starting_offsets("t", {1: 7}, 2) == '{"t": {"0": -2, "1": 7}}'


def test_same_key_same_partition(spark):
    keys = spark.range(200).withColumn("k", F.col("id") % 20)
    assigned = C.assign_partition(keys, "k", 4)
    assert assigned.select("k", "partition_id").distinct().count() == 20
    assert set(r[0] for r in assigned.select("partition_id").distinct().collect()) <= {0, 1, 2, 3}


def line(op, key, quantity):
    row = {"OrderLineID": key, "OrderID": 1, "ProductID": 2, "Quantity": quantity, "UnitPrice": 1.5}
    return message(op, key, row, table="OrderLines")


def consumers_of(spark):
    def folder(name):
        return new_folder(spark, name)

    return [
        Consumer("both", folder("state"), folder("checkpoint"), (S.ORDERS, S.ORDER_LINES)),
        Consumer("late", folder("state"), folder("checkpoint"), (S.ORDERS,), positions={0: 3}),
        Consumer("lines", folder("state"), folder("checkpoint"), (S.ORDER_LINES,), positions={0: 2, 1: 2}),
    ]


def contents(spark, consumer):
    state = consumer.state(spark)
    return (
        [rows(state.target(s)) for s in consumer.specs],
        rows(state.ledger().drop("processed_at")),
        rows(state.offsets().drop("updated_at")),
        rows(state.quarantine(), "partition_id", "sequence_number", "reject_reason"),
    )


FEED = [
    [(0, 1, order("INS", 1, "a")), (0, 2, line("INS", 5, 1)), (0, 3, order("INS", 2, "b")), (1, 1, "{broken"), (1, 2, order("INS", 9, "x"))],
    [(0, 3, order("INS", 2, "b")), (0, 4, line("UPD", 5, 3)), (1, 3, order("DEL", 9, None)), (1, 4, "{also broken"),
     (1, 5, message("INS", 3, {"OrderID": 3}, table="Other"))],
]


def test_one_decode_gives_what_separate_consumers_get(spark):
    source = C.Source("parquet", new_folder(spark, "feed"))
    apart, together, checkpoint = consumers_of(spark), consumers_of(spark), new_folder(spark, "checkpoint")
    for part in FEED:
        publish(spark, source, part)
        for query in fan_out(spark, source, apart, available_now=True):
            query.awaitTermination()
        results = []
        query = start_together(spark, source, together, checkpoint, True, lambda name, r: results.append((name, dict(r.applied))))
        query.awaitTermination()
        assert [name for name, _ in results] == ["both", "late", "lines"]
        # Three consumers, and each message was read once.
        assert sum(p["numInputRows"] for p in query.recentProgress) == len(part)
    for a, b in zip(apart, together):
        assert contents(spark, a) == contents(spark, b), a.name


def test_a_consumer_that_fails_is_not_ahead_or_behind_after_the_restart(spark, monkeypatch):
    source = C.Source("parquet", new_folder(spark, "feed"))
    together, checkpoint = consumers_of(spark), new_folder(spark, "checkpoint")
    publish(spark, source, FEED[0])
    apply_decoded, calls = streaming.apply_decoded, []

    def failing(state, events):
        calls.append(state.path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return apply_decoded(state, events)

    monkeypatch.setattr(streaming, "apply_decoded", failing)
    with pytest.raises(Exception, match="lost"):
        start_together(spark, source, together, checkpoint, available_now=True).awaitTermination()
    assert together[0].state(spark).ledger().count() == 4 and together[1].state(spark).ledger().count() == 0
    start_together(spark, source, together, checkpoint, available_now=True).awaitTermination()
    assert [c.state(spark).ledger().count() for c in together] == [4, 2, 1]


def test_one_decode_needs_one_decoder_and_one_shape(spark):
    a, b = consumers_of(spark)[:2]
    other = Consumer("o", b.state_path, b.checkpoint, decoder=X.decode_documented)
    with pytest.raises(ValueError, match="decoder"):
        start_together(spark, C.Source("parquet", "x"), [a, other], "c")
    narrow = Consumer("n", b.state_path, b.checkpoint, (S.TableSpec("Orders", "OrderID", S.ORDERS.columns[:1]),))
    with pytest.raises(ValueError, match="columns of Orders"):
        start_together(spark, C.Source("parquet", "x"), [a, narrow], "c")


def test_stream_rates_go_on_after_a_restart(spark):
    rng, start = random.Random(5), datetime(2026, 1, 1)
    schema = "partition int, offset long, timestamp timestamp, value binary"
    frame = spark.createDataFrame([], schema)
    source = C.Source("parquet", new_folder(spark, "feed"), schema=frame.schema)
    path, checkpoint = new_folder(spark, "rates"), new_folder(spark, "checkpoint")
    expected, offset = Counter(), 0
    for _ in range(3):  # every run has messages of the same seconds, and some a day late
        part = []
        for _ in range(200):
            offset += 1
            at = start + timedelta(milliseconds=rng.randrange(5000)) - timedelta(days=rng.choice([0, 0, 1]))
            part.append((offset % 3, offset, at, b"x"))
            expected[offset % 3, at.replace(microsecond=0)] += 1
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source.path)
        start_rates(spark, source, path, checkpoint, available_now=True).awaitTermination()
    found = {(r["partition_id"], r["second"]): r["events"] for r in stream_rates(spark, path).collect()}
    assert found == dict(expected)


def test_waiting_messages_from_progress(spark):
    def progress(**offsets):  # the shape a broker's progress has; its connector is not here
        return SimpleNamespace(json=json.dumps({"sources": [offsets]}))

    latest = {"t": {"0": 12, "1": 7, "2": 3}}
    assert waiting(progress(latestOffset=latest, endOffset={"t": {"0": 10, "1": 7}})) == {("t", 0): 2, ("t", 1): 0, ("t", 2): 3}
    assert waiting(progress(latestOffset={"t": {"0": 4}}, endOffset=None)) == {("t", 0): 4}
    source = C.Source("parquet", new_folder(spark, "feed"))
    publish(spark, source, FEED[0])
    _, query = run(spark, source, consumers_of(spark)[0])
    assert waiting(query.lastProgress) is None  # files report no latest offset
