"""Set-based apply against a one-by-one fold in plain Python, on random feeds."""

import random
from collections import Counter

import pytest
from helpers import feed, message, rows
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators import apply as A, frequent as K
from sluice.operators.numbering import number_in_order, running_max
from sluice.session import new_folder
from sluice.streaming.consumer import apply_batch
from sluice.streaming.state import State


def fold(events):
    ledger, offsets, target = {}, {}, {}
    for partition, sequence, op, key, product in events:
        if (partition, sequence) in ledger:
            continue
        lsn = f"L{partition}_{sequence}"
        ledger[partition, sequence] = lsn
        offsets[partition] = (sequence, lsn)
        if op in ("INS", "UPD"):
            target[key] = product
        elif op == "DEL":
            target.pop(key, None)
    return ledger, offsets, target


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_a_fold(spark, seed):
    rng = random.Random(seed)
    distinct = [
        (rng.randrange(4), n, rng.choice(["INS", "UPD", "UPD", "DEL", "ODD"]), rng.randrange(1, 12), f"p{n}")
        for n in range(90)
    ]
    events = distinct + rng.choices(distinct, k=60)
    rng.shuffle(events)
    ledger, offsets, target = fold(events)

    state = State(spark, new_folder(spark, "state"))
    state.merge_share, state.fold_count = 0.3, 2
    size = 50
    for a in range(0, len(events), size):
        part = [
            (p, s, message(op, key, {"OrderID": key, "Product": product}, lsn=f"L{p}_{s}"))
            for p, s, op, key, product in events[a:a + size]
        ]
        apply_batch(state, feed(spark, part))
        state.maintain()
    assert rows(state.ledger().drop("processed_at", "arrival")) == sorted(
        ((p, s, lsn) for (p, s), lsn in ledger.items()), key=repr)
    assert rows(state.offsets().drop("updated_at", "last_arrival")) == sorted(
        ((p, s, lsn) for p, (s, lsn) in offsets.items()), key=repr)
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == sorted(target.items(), key=repr)


def test_numbering_equals_row_number(spark):
    rng = random.Random(3)
    data = [(rng.choice([0, 0, 0, 1, 2]), a) for a in rng.sample(range(10_000), 700)]
    df = spark.createDataFrame(data, "partition_id int, arrival long")
    expected, seen = [], {}
    for p, a in sorted(data, key=lambda r: r[1]):
        seen[p] = seen.get(p, 0) + 1
        expected.append((p, a, seen[p]))
    for bits in (4, 20):
        found = number_in_order(df, ["partition_id"], ["arrival"], "arrival", "n", bits)
        assert rows(found) == sorted(expected, key=repr)


def test_running_max_equals_a_scan(spark):
    rng = random.Random(4)
    data = [(s % 3, s, rng.randrange(1000)) for s in range(500)]
    df = spark.createDataFrame(data, "partition_id int, sequence_number long, t long")
    expected, top = [], {}
    for p, s, t in data:
        top[p] = max(top.get(p, 0), t)
        expected.append((p, s, t, top[p]))
    for bits in (3, 20):
        found = running_max(df, ["partition_id"], "sequence_number", F.col("t"), "m", bits)
        assert rows(found) == sorted(expected, key=repr)


def test_hot_copies_are_dropped_before_the_shuffle(spark):
    events = spark.range(1000).selectExpr(
        "CAST(id % 1 AS INT) AS partition_id", "if(id % 3 = 0, 7L, id) AS sequence_number", "id AS arrival",
        "'INS' AS operation", "CAST(id % 1 AS INT) AS key",
    )
    unique = A.dedup_in_batch(events)
    net = A.last_change_per_key(unique, "key")
    plan = net._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4 and plan.count("Exchange") == 2
    assert net.first()["arrival"] == 998
    assert unique.count() == len({7 if n % 3 == 0 else n for n in range(1000)})


def test_positions_far_apart_are_summed_in_levels(spark):
    spread = 1 << 40
    df = spark.range(50_000).select(F.lit(0).alias("partition_id"), ((F.col("id") - 25_000) * spread).alias("arrival"), "id")
    found = number_in_order(df, ["partition_id"], ["arrival"], "arrival", "n")
    assert found.filter("n <> id + 1").count() == 0 and found.count() == 50_000
    # Every row is a block; no window runs over the blocks of a whole group but the one over the few top runs.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_run") > 0
    tops = df.select((F.shiftright("arrival", 20 + 2 * 16)).alias("top")).distinct().count()
    assert tops <= 1 << 12
    top = running_max(df, ["partition_id"], "arrival", -F.abs(F.col("id") - 30_000), "m")
    assert top.filter("m <> IF(id <= 30000, id - 30000, 0)").count() == 0 and top.count() == 50_000


def test_running_max_of_one_event_delivered_a_million_times(spark):
    hot = spark.range(1_000_000).select(F.lit(0).alias("partition_id"), F.lit(5).cast("long").alias("s"), F.col("id").alias("t"))
    rest = spark.createDataFrame([(0, 4, 7), (0, 6, 3), (1, 5, 1)], "partition_id int, s long, t long")
    found = running_max(hot.unionByName(rest), ["partition_id"], "s", F.col("t"), "m")
    expected = {(0, 4): (7, 1), (0, 5): (999_999, 1_000_000), (0, 6): (999_999, 1), (1, 5): (1, 1)}
    per_position = found.groupBy("partition_id", "s").agg(F.min("m"), F.max("m"), F.count(F.lit(1))).collect()
    assert {(r[0], r[1]): (r[3], r[4]) for r in per_position} == expected
    assert all(r[2] == r[3] for r in per_position)


@pytest.mark.parametrize("capacity", [1, 7, 40, 1000])
def test_frequent_keys_are_within_the_bound(spark, capacity):
    rng = random.Random(capacity)
    parts = [[min(int(rng.paretovariate(0.7)), 300) for _ in range(400)] + [None] * 5 for _ in range(4)]
    frames = [spark.createDataFrame([(k,) for k in part], "k int") for part in parts]
    summary = K.key_summary(frames[0], ["k"], capacity)
    for frame in frames[1:]:
        summary = K.merged_summaries([summary, K.key_summary(frame, ["k"], capacity)], ["k"], capacity)
    exact = Counter(k for part in parts for k in part)
    collected = summary.collect()
    [error] = [r["error"] for r in collected if not r["listed"]]
    assert error <= sum(exact.values()) // (capacity + 1)
    found = {r["k"]: (r["at_least"], r["at_most"]) for r in K.frequent_keys(summary, ["k"]).collect()}
    assert len(found) == len(collected) - 1 <= capacity
    for key, count in exact.items():
        if key in found:
            assert found[key][0] <= count <= found[key][1] == found[key][0] + error
        else:
            assert count <= error
    if capacity == 1000:
        assert error == 0 and {k: low for k, (low, _) in found.items()} == exact


def test_frequent_keys_of_nothing(spark):
    empty = K.key_summary(spark.createDataFrame([], "k int"), ["k"], 3)
    assert [tuple(r) for r in empty.collect()] == [(None, False, 0, 0)]
    merged = K.merged_summaries([empty, empty], ["k"], 3)
    assert [tuple(r) for r in merged.collect()] == [(None, False, 0, 0)] and K.frequent_keys(merged, ["k"]).count() == 0


def test_a_state_knows_its_hottest_keys_after_folding(spark):
    state = State(spark, new_folder(spark, "state"), hot_keys=3, fold_count=2)
    rng, exact, sequence = random.Random(11), Counter(), 0
    for _ in range(7):
        batch = []
        for _ in range(40):
            key, sequence = rng.choice([1, 1, 1, 1, 2, 2, rng.randrange(3, 30)]), sequence + 1
            batch.append((0, sequence, message("UPD", key, {"OrderID": key})))
            exact[key] += 1
        apply_batch(state, feed(spark, [*batch, batch[0], (0, sequence + 100_000, "{bad")]))  # a duplicate and a reject
        state.maintain()
    assert any(not f["path"].startswith("events/") for f in state.manifest()["ledger"])
    found = {r["key"]: (r["at_least"], r["at_most"]) for r in state.frequent_keys().collect()}
    assert {1, 2} <= set(found) and len(found) <= 3
    assert all(low <= exact[k] <= high and high - low <= 280 // 4 for k, (low, high) in found.items())
    state.reset()
    assert state.frequent_keys().count() == 0
    before = {**state.manifest(), "ledger": [{"path": "ledger/x", "size": 1}]}
    with pytest.raises(ValueError, match="summary"):
        state.frequent_keys(before)
