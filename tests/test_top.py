"""The newest rows out of a committed state: the same as of a full sort, from few files."""

import random

import pytest
from helpers import feed, rows
from pyspark.sql import functions as F
from test_state import order

from sluice import schemas as S
from sluice.session import new_folder
from sluice.streaming.consumer import apply_batch
from sluice.streaming.state import State, files_from
from sluice.streaming.top import arrival_bound, key_bound, may_reach, recent_events, top_rows


def filled(spark, keys, **options):
    """A state whose base holds some keys, in 16 buckets."""
    state = State(spark, new_folder(spark, "state"), merge_share=0.0, **options)
    apply_batch(state, feed(spark, [(0, i, order("INS", k, f"p{k}")) for i, k in enumerate(keys)]))
    state.maintain()
    return state


def by_sort(state, n):
    return [r["OrderID"] for r in state.target(S.ORDERS).orderBy(F.col("OrderID").desc()).limit(n).collect()]


def by_notes(state, n):
    return [r["OrderID"] for r in top_rows(state, S.ORDERS, n).collect()]


def base_of(state):
    [base] = state.manifest()["targets"]["Orders"]["base"]
    return base


def test_notes_hold_each_files_highest_key(spark):
    state = filled(spark, range(500))
    base = base_of(state)
    assert set(base["highest"]) == set(base["files"]) and max(base["highest"].values()) == 499
    for file, highest in base["highest"].items():
        held = [r["OrderID"] for r in spark.read.parquet(f"{state.path}/{base['path']}/{file}").collect()]
        assert max(held) == highest and held == sorted(held)


@pytest.mark.parametrize("n", [1, 3, 10])
def test_the_top_opens_as_many_files_as_rows_are_wanted(spark, n):
    state = filled(spark, [k * k for k in range(400)])
    bound = key_bound(state, S.ORDERS, n, state.manifest())
    base = base_of(state)
    assert len(files_from(base, bound)) == n < len(base["files"])
    assert by_notes(state, n) == by_sort(state, n) == [k * k for k in range(399, 399 - n, -1)]


def test_unmerged_changes_move_the_bound(spark):
    state = filled(spark, range(400))
    changes = [(1, k, order("DEL", k, "x")) for k in range(395, 400)]  # the highest go
    changes += [(2, k, order("INS", k, "x")) for k in (1000, 50)]  # one above all, one that is there
    changes += [(3, k, order("DEL", k, "x")) for k in (2000, 2001)]  # deletions of what never was
    apply_batch(state, feed(spark, changes))
    for n in (1, 2, 4, 16, 17, 1000):
        assert by_notes(state, n) == by_sort(state, n)
    assert by_notes(state, 3) == [1000, 394, 393]
    apply_batch(state, feed(spark, [(4, k, order("DEL", k, "x")) for k in range(20, 395)]))
    assert by_notes(state, 5) == by_sort(state, 5) == [1000, 19, 18, 17, 16]


def test_random_histories_agree_with_a_full_sort(spark):
    draw = random.Random(5)
    state = filled(spark, draw.sample(range(-3000, 3000), 300))
    for n in range(4):
        keys = draw.sample(range(-3000, 3500), 60) + [k for k in by_sort(state, 12) if draw.random() < 0.7]
        apply_batch(state, feed(spark, [(n + 1, i, order(draw.choice(["INS", "DEL", "DEL"]), k, "y")) for i, k in enumerate(keys)]))
        if n == 1:
            state.maintain()  # most buckets are touched: a new base
        assert all(by_notes(state, wanted) == by_sort(state, wanted) for wanted in (1, 7, 40))


def test_replaced_files_are_noted_anew(spark):
    state = filled(spark, range(400))
    bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(16))
    keys = [r.id for r in spark.range(400).filter(bucket == 5).collect()]
    apply_batch(state, feed(spark, [(1, k, order("DEL", k, "x")) for k in keys[-3:]]))
    state.maintain()
    base = base_of(state)
    assert base["replaced"] and set(base["highest"]) == set(base["files"])
    assert keys[-4] in base["highest"].values() and keys[-1] not in base["highest"].values()
    assert by_notes(state, 9) == by_sort(state, 9)


def test_states_without_notes_a_base_or_rows(spark):
    empty = State(spark, new_folder(spark, "state"))
    assert by_notes(empty, 5) == [] and recent_events(empty, 5).collect() == []
    unmerged = State(spark, new_folder(spark, "state"))
    apply_batch(unmerged, feed(spark, [(0, k, order("INS", k, "x")) for k in range(9)]))
    assert by_notes(unmerged, 2) == [8, 7] and by_notes(unmerged, 0) == []
    older = filled(spark, range(40))
    manifest = older.manifest()
    del manifest["targets"]["Orders"]["base"][0]["highest"]
    assert [r["OrderID"] for r in top_rows(older, S.ORDERS, 2, manifest).collect()] == [39, 38]


def test_recent_events_open_the_last_folders(spark):
    state = State(spark, new_folder(spark, "state"), fold_count=3)
    for n in range(3):
        events = [(p, 10 * n + i, 100 * n + 4 * i + p, order("UPD", i, "x")) for i in range(5) for p in range(4)]
        apply_batch(state, spark.createDataFrame(events, S.MESSAGE_SCHEMA))
    folders = state.manifest()["ledger"]
    assert [f["arrivals"] for f in folders] == [[0, 19], [100, 119], [200, 219]]
    assert [len(may_reach(folders, arrival_bound(folders, n))) for n in (1, 20, 21, 40, 41, 60, 61)] == [1, 1, 2, 2, 3, 3, 3]
    late = spark.createDataFrame([(0, 5, 50, order("DEL", 3, "x"))], S.MESSAGE_SCHEMA)
    apply_batch(state, late)  # committed last, arrived long ago
    everything = sorted(((r["arrival"], r["partition_id"]) for r in state.ledger().collect()), reverse=True)
    for n in (1, 20, 30, 61, 100):
        assert [(r["arrival"], r["partition_id"]) for r in recent_events(state, n).collect()] == everything[:n]
    assert rows(recent_events(state, 1), "op", "key_text") == [("UPD", "OrderID=4")]
    state.maintain()  # folds the folders; what it keeps has no operation
    [folded] = state.manifest()["ledger"]
    assert folded["arrivals"] == [0, 219]
    assert rows(recent_events(state, 1), "arrival", "op", "key_text") == [(219, "—", None)]


def test_rejects_do_not_count_as_recent(spark):
    state = State(spark, new_folder(spark, "state"))
    apply_batch(state, feed(spark, [(0, 1, order("INS", 1, "x")), (0, 2, "no json"), (0, 3, "no json")]))
    [folder] = state.manifest()["ledger"]
    assert folder["arrivals"] == [0, 0] and rows(recent_events(state, 5), "arrival") == [(0,)]
