"""The committed state at scale: which folders a batch opens, what a reader or merge shuffles, upkeep."""

import os
import re
from collections import Counter

import pytest
from helpers import feed, message, rows
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.plans.materialize import materialize
from sluice.session import new_folder
from sluice.streaming import consumer
from sluice.streaming.consumer import apply_batch, replay
from sluice.streaming.state import State, bucket_of, known_runs, may_hold


def order(op, key, product):
    return message(op, key, {"OrderID": key, "Product": product}, lsn=f"{op}{key}")


def batch(spark, n, drift, size=30):
    """Four partitions whose sequences are far apart; each batch follows the last one."""
    return feed(spark, [
        (p, drift * p + size * n + i, order("UPD", (7 * i + p) % 40, f"{n}.{i}.{p}")) for i in range(size) for p in range(4)
    ])


def opened(state):
    """Folders opened for the ledger, as they are."""
    seen, read = [], state.ledger_in
    state.ledger_in = lambda folders: (seen.append(len(folders)), read(folders))[1]
    return seen


def test_ordinary_batches_open_no_old_folder(spark):
    state = State(spark, new_folder(spark, "state"))
    seen = opened(state)
    for n in range(3):
        apply_batch(state, batch(spark, n, 1_000_000))
    # Late events: one lies in a run that is known whole, one before it.
    apply_batch(state, feed(spark, [(2, 2_000_000, order("INS", 1, "late")), (2, 1_999_000, order("INS", 2, "older"))]))
    assert replay(state, batch(spark, 1, 1_000_000)).applied == {}
    assert not seen
    assert state.ledger().count() == 3 * 4 * 30 + 1


@pytest.mark.parametrize("read_once", [False, True])
def test_ranges_with_gaps_open_the_folders_that_meet(spark, read_once):
    state = State(spark, new_folder(spark, "state"))
    for n in range(3):
        apply_batch(state, feed(spark, [(0, 1000 * n + 2 * i, order("INS", i, "x")) for i in range(20)]))
    seen = opened(state)
    late = feed(spark, [(0, 1000 + s, order("UPD", s, "late")) for s in (2, 3, 4, 5)])
    assert apply_batch(state, late, read_once=read_once).applied == {"Orders": 2}
    assert seen == [1]
    assert apply_batch(state, late, read_once=read_once).applied == {}
    assert rows(state.target(S.ORDERS).filter("Product = 'late'"), "OrderID") == [(3,), (5,)]
    assert len(os.listdir(f"{state.path}/events")) >= 4


def test_runs_from_the_notes():
    folders = [
        {"path": "a", "ranges": {"0": [1, 5, 5], "1": [7, 9, 2]}}, {"path": "b", "ranges": {"0": [6, 9, 4]}},
        {"path": "c", "ranges": {"0": [20, 29, 10]}}, {"path": "d", "ranges": {"0": [5, 6]}}, {"path": "e"},
    ]
    assert known_runs(folders[:3], {0: (3, 8)}) == ([(0, 1, 9)], [])
    assert known_runs(folders[:3], {0: (0, 99)}) == ([(0, 1, 9), (0, 20, 29)], [])
    assert known_runs(folders[:3], {0: (3, 8), 1: (8, 8)}) == ([(0, 1, 9)], folders[:1])
    assert known_runs(folders, {0: (6, 6)}) == ([(0, 6, 9)], folders[3:])
    many = [{"path": str(i), "ranges": {"0": [3 * i, 3 * i + 1, 2]}} for i in range(500)]
    assert known_runs(many, {0: (0, 9999)}) == ([], many)


def test_folders_by_range():
    folders = [{"path": "a", "ranges": {"0": [1, 5], "1": [7, 9]}}, {"path": "b"}, {"path": "c", "ranges": {}}]
    assert [f["path"] for f in may_hold(folders, {0: (6, 8)})] == ["b"]
    assert [f["path"] for f in may_hold(folders, {0: (6, 8), 1: (9, 9)})] == ["a", "b"]
    assert [f["path"] for f in may_hold(folders, None)] == ["a", "b", "c"]


def exchanges_above(plan, mark):
    """Exchanges between a marked scan and the top of a formatted plan."""
    lines = plan.split("\n")
    [at] = [i for i, line in enumerate(lines) if "Scan parquet" in line and mark in line]
    depth, above = len(re.match(r"[ :|+*()\d-]*", lines[at])[0]), []
    for line in reversed(lines[:at]):
        indent = len(re.match(r"[ :|+*()\d-]*", line)[0])
        if indent < depth:
            above.append(line)
            depth = indent
    return [line for line in above if "Exchange" in line]


def without_broadcast(spark, work):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return work()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_tasks(plan):
    return [int(n) for n in re.findall(r"SelectedBucketsCount: \d+ out of (\d+)", plan)]


def test_reading_and_merging_shuffle_no_base(spark):
    state = State(spark, new_folder(spark, "state"), merge_share=0.0, buckets=8)
    apply_batch(state, batch(spark, 0, 1000))
    state.maintain()
    apply_batch(state, batch(spark, 1, 1000))
    apply_batch(state, batch(spark, 2, 1000))
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    for n in (shuffles, "64"):  # fewer and more than the base has buckets
        spark.conf.set("spark.sql.shuffle.partitions", n)
        plan = without_broadcast(spark, lambda: plan_of(state.target(S.ORDERS)))
        assert "SortMergeJoin" in plan and exchanges_above(plan, "Bucketed: true") == []
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    before = rows(state.target(S.ORDERS))
    state.maintain()
    assert state.manifest()["targets"]["Orders"]["changes"] == []
    again = State(spark, state.path)
    assert rows(again.target(S.ORDERS)) == before and len(before) == 40
    assert [t for t in spark.catalog.listTables() if t.name.startswith("sluice_")] == []


def test_buckets_grow_with_the_target(spark):
    state = State(spark, new_folder(spark, "state"), merge_share=0.0, buckets=2, bucket_bytes=30_000)
    expected, counts = {}, []
    for n, keys in enumerate((50, 2000, 2000, 4000)):  # 40 times the first commit in the end
        first = len(expected)
        part = {k: f"{n}-{k}-{k * 7919 % 10007}" for k in range(first, first + keys)} | {k: f"again {n}" for k in range(0, first, 5)}
        expected |= part
        apply_batch(state, feed(spark, [(0, 100_000 * n + i, order("UPD", k, p)) for i, (k, p) in enumerate(part.items())]))
        state.maintain()
        [base] = state.manifest()["targets"]["Orders"]["base"]
        counts.append(base["buckets"])
        assert max(Counter({bucket_of(f): size for f, size in base["files"].items()}).values()) <= 1.5 * 30_000
    assert counts[0] == 2 and counts[-1] >= 8 and counts == sorted(counts)
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == sorted(expected.items(), key=repr)
    apply_batch(state, feed(spark, [(1, 1, order("DEL", 3, "x"))]))
    plan = without_broadcast(spark, lambda: plan_of(state.target(S.ORDERS)))
    assert scan_tasks(plan) == [counts[-1]] and exchanges_above(plan, "Bucketed: true") == []
    assert state.target(S.ORDERS).count() == len(expected) - 1


def test_a_merge_rewrites_touched_buckets_only(spark):
    state = State(spark, new_folder(spark, "state"), merge_share=0.0, buckets=16, keep_versions=1, keep_seconds=0)
    apply_batch(state, feed(spark, [(0, k, order("INS", k, "old")) for k in range(400)]))
    state.maintain()
    [before] = state.manifest()["targets"]["Orders"]["base"]
    version = state.manifest()["version"]
    mine = spark.range(400).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(16)).alias("b")).filter("b = 5")
    keys = [r.id for r in mine.collect()]
    changes = [(1, i, order("UPD" if i % 2 else "DEL", k, "new")) for i, k in enumerate(keys)]
    apply_batch(state, feed(spark, changes))
    state.maintain()
    [after] = state.manifest()["targets"]["Orders"]["base"]
    gone = set(before["files"]) - set(after["files"])
    assert after["path"] == before["path"] and {bucket_of(f) for f in gone} == {5} == {bucket_of(f) for f in set(after["files"]) - set(before["files"])}
    expected = {k: "old" for k in range(400)} | {k: "new" for k in keys}
    for k in keys[::2]:
        del expected[k]
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == sorted(expected.items(), key=repr)
    older = state.target(S.ORDERS, {**state.manifest(), "targets": {"Orders": {"base": [before], "changes": []}}})
    if version >= state.manifest()["version"]:  # its files are there as long as its version is
        assert older.count() == 400
    # a deletion of a whole bucket, then rows there again; files no version names go
    apply_batch(state, feed(spark, [(2, i, order("DEL", k, "x")) for i, k in enumerate(keys)]))
    state.maintain()
    apply_batch(state, feed(spark, [(3, 1, order("INS", keys[0], "back"))]))
    state.maintain()
    [last] = state.manifest()["targets"]["Orders"]["base"]
    assert rows(state.target(S.ORDERS).filter("Product <> 'old'"), "OrderID", "Product") == [(keys[0], "back")]
    assert not gone & set(os.listdir(f"{state.path}/{last['path']}"))


def test_a_commit_is_one_write_and_one_summary(spark):
    state = State(spark, new_folder(spark, "state"), (S.ORDERS, S.ORDER_LINES))
    written, summed = [], []
    write, summary = State.write, consumer._summary
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(State, "write", lambda self, *a: (written.append(a[1]), write(self, *a))[1])
        patch.setattr(consumer, "_summary", lambda df: (summed.append(1), summary(df))[1])
        for n in range(2):
            apply_batch(state, batch(spark, n, 1000))
    assert written == ["events", "events"] and len(summed) == 2


def test_one_key_with_nearly_all_traffic(spark):
    """Nine of ten events change one key; every commit, merge and read gives its last change."""
    state, last = State(spark, new_folder(spark, "state"), merge_share=0.0, buckets=4), {}
    for n in range(4):
        part = [(i % 4, 5000 * n + i, order("UPD", 7 if i % 10 else i, f"{n}.{i}")) for i in range(2000)]
        last |= {7 if i % 10 else i: f"{n}.{i}" for i in range(2000)}
        assert apply_batch(state, feed(spark, part)).applied == {"Orders": 2000}
        if n == 2:
            state.maintain()
    plan = plan_of(state.target(S.ORDERS))
    assert "WindowGroupLimit" in plan
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == sorted(last.items(), key=repr)
    assert replay(state, feed(spark, part)).applied == {}


def test_old_versions_and_folders_go(spark):
    state = State(spark, new_folder(spark, "state"), keep_versions=2, keep_seconds=0, fold_count=2, merge_share=0.1)
    for n in range(6):
        apply_batch(state, batch(spark, n, 1000, 5))
        state.maintain()
    expected = rows(state.target(S.ORDERS)), state.ledger().count()
    state.reset()
    for _ in range(2):
        apply_batch(state, batch(spark, 9, 1000, 5))
        apply_batch(state, batch(spark, 10, 1000, 5))
        state.maintain()
    versions = [f for f in os.listdir(f"{state.path}/_versions") if f.endswith(".json")]
    assert len(versions) <= 3
    assert len(os.listdir(f"{state.path}/events")) <= 8 and expected[1] == 120
    assert state.ledger().count() == 40 and state.target(S.ORDERS).count() > 0


def test_one_pass_reads_the_feed_once(spark):
    path = new_folder(spark, "feed")
    batch(spark, 0, 1000).write.parquet(path)
    messages = spark.read.schema(S.MESSAGE_SCHEMA).parquet(path)
    once, lazily = materialize(messages, keep=True), materialize(messages)
    for kept, lazy in zip(once.tables(), lazily.tables()):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert path not in plan
        times = [c for c in ("processed_at", "updated_at") if c in kept.columns]
        assert rows(kept.drop(*times)) == rows(lazy.drop(*times))
