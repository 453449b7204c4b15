"""What a batch and a summary write and shuffle: ids and sizes where rows need not move."""

import random
from collections import Counter

import pytest
from helpers import feed, message, rows
from pyspark.sql import functions as F
from test_one_pass import plan, tables  # noqa: F401

from sluice import schemas as S
from sluice.operators import frequent as K
from sluice.plans import registered as R
from sluice.session import new_folder
from sluice.sources import derived as D
from sluice.streaming import consumer as C
from sluice.streaming.consumer import apply_batch
from sluice.streaming.state import State


def order(op, key, product):
    return message(op, key, {"OrderID": key, "Product": product})


@pytest.fixture
def written(monkeypatch):
    """Plans of the batches a state was made to write."""
    plans, write_events = [], State.write_events

    def noted(self, events, manifest):
        plans.append(plan(events))
        return write_events(self, events, manifest)

    monkeypatch.setattr(State, "write_events", noted)
    return plans


def kept(state):
    return len(state._files.names(f"{state.path}/events"))


def test_new_events_are_written_once_and_not_shuffled(spark, written):
    state = State(spark, new_folder(spark, "state"))
    for n in range(2):  # the ranges of both batches meet, their events do not
        batch = feed(spark, [(k % 2, 2 * k + n, order("UPD", k, f"p{n}")) for k in range(6)])
        assert apply_batch(state, batch, read_once=True).applied == {"Orders": 6}
    assert len(written) == kept(state) == 2 and not any("window" in p for p in written)
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == [(k, "p1") for k in range(6)]


def test_copies_and_known_events_are_left_out(spark, written):
    state = State(spark, new_folder(spark, "state"))
    first = feed(spark, [(0, 1, order("INS", 1, "a")), (0, 1, order("INS", 1, "copy")), (0, 2, "{"), (0, 2, order("INS", 2, "b"))])
    assert apply_batch(state, first, read_once=True).applied == {"Orders": 2}
    assert len(written) == 2 and kept(state) == 1
    mixed = feed(spark, [(0, 2, order("UPD", 2, "known")), (0, 3, order("UPD", 1, "c")), (0, 3, order("UPD", 1, "copy")), (0, 4, "{")])
    result = apply_batch(state, mixed, read_once=True)
    assert result.applied == {"Orders": 1} and result.rejected == 1
    assert rows(state.ledger(), "partition_id", "sequence_number") == [(0, 1), (0, 2), (0, 3)]
    assert rows(state.target(S.ORDERS), "OrderID", "Product") == [(1, "c"), (2, "b")]
    again, version = apply_batch(state, mixed, read_once=True), state.manifest()["version"]
    assert again.applied == {} and again.rejected == 0 and version == result.version


def test_a_known_batch_leaves_nothing(spark):
    state = State(spark, new_folder(spark, "state"))
    batch = feed(spark, [(0, 2 * k, order("INS", k, "a")) for k in range(5)])
    apply_batch(state, batch, read_once=True)
    assert apply_batch(state, batch, read_once=True).applied == {}
    assert kept(state) == 1


def test_keys_without_a_replay_are_not_moved_for_it(spark, tables):  # noqa: F811
    *_, replays = D.waves(spark, tables, lines=True)
    for part in plan(replays).split("repartitionbyexpression")[1:]:
        assert "% 5) = 0" in part
    assert replays.count() == replays.filter(D.is_replay()).count() > 0


def test_keys_of_the_other_half_are_not_moved(spark, tables):  # noqa: F811
    early, rest, _ = D.waves(spark, tables)
    for wave in (early, rest):
        [below] = plan(wave).split("repartitionbyexpression")[1:]
        assert "* 6)" in below
    both = early.unionByName(rest)
    assert sorted(both.collect()) == sorted(D.orders_feed(spark, tables).filter(~D.is_replay()).collect())
    assert early.exceptAll(both.filter(D.first_half(spark, tables))).count() == 0 < rest.count()


def test_only_the_row_is_searched_for_what_must_be_escaped(spark, tables):  # noqa: F811
    for feed_of in (D.orders_feed, D.lines_feed):
        text = plan(feed_of(spark, tables))
        assert "replace(replace(invoke(structstojson" in text and "replace(concat" not in text


def test_a_shared_decoding_reads_no_schema_name(spark, tables, monkeypatch):  # noqa: F811
    seen, decode = [], C.decode

    class Noted:
        def __init__(self, df):
            self.df = df

        def drop(self, *names):
            seen.extend(names)
            return self.df.drop(*names)

    monkeypatch.setattr(C, "decode", lambda *a: Noted(decode(*a)))
    assert R.queries()["s6_one_decode"](spark, tables).count() > 0 and seen == ["schema_name"]


def test_a_published_feed_is_small(spark, tables):  # noqa: F811
    _, source, _ = R._stream(spark, D.waves(spark, tables)[:1])
    assert all(".zstd." in f for f in spark.read.parquet(source.path).inputFiles())


def test_a_summary_sorts_and_moves_no_keys(spark):
    pick = random.Random(5)
    events = [(min(int(pick.paretovariate(0.7)), 400),) for _ in range(3000)]
    counts = Counter(k for (k,) in events)
    df = spark.createDataFrame(events, "key long")
    for capacity in (3, 20, 1000):
        summary = K.key_summary(df, ["key"], capacity)
        cut = next(iter(sorted(counts.values(), reverse=True)[capacity:]), 0)
        found = {r["key"]: (r["at_least"], r["error"]) for r in summary.collect()}
        assert found == {None: (0, cut)} | {k: (n - cut, 0) for k, n in counts.items() if n > cut}
        twice = {r["key"]: (r["at_least"], r["error"]) for r in K.merged_summaries([summary, summary], ["key"], capacity).collect()}
        assert twice == {k: (2 * n, 2 * e) for k, (n, e) in found.items()}
    assert "limit" not in plan(summary) and "sort" not in plan(summary.select(F.col("key")))
