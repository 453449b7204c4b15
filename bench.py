"""Benchmark: one JSON line with seconds per query, on files of change messages.

The messages are derived from the tables at ``$BENCH_SF_DIR`` and written out first (not
timed), as a broker would hold them. One untimed pass of the largest plan loads classes and
compiled code. Then every query runs over the whole feed: three times, of which the median counts,
or once if it commits state.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice import schemas as S
from sluice.operators import apply as A, decode as X, views as V
from sluice.plans.materialize import materialize
from sluice.session import new_folder, prepare, staged
from sluice.sources import derived as D
from sluice.sources.changes import Source, read_changes
from sluice.streaming.consumer import Consumer, apply_batch, replay, start_consumer
from sluice.streaming.state import State

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ORDERS, ORDER_LINES = D.ORDERS, D.ORDER_LINES
BOTH = (ORDERS, ORDER_LINES)
BATCHES, REPEATS = 10, 3
COMMITTING = ("apply_", "replay_", "stream_")


def run_out(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def written(spark: SparkSession, feed: DataFrame) -> DataFrame:
    source = Source("parquet", new_folder(spark, "bench"))
    feed.repartition(int(CPUS) * 2).write.parquet(source.path)
    return read_changes(spark, source)


def main() -> None:
    spark = prepare(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("sluice-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    orders = written(spark, D.orders_feed(spark, SF_DIR))
    both = written(spark, D.two_table_feed(spark, SF_DIR))
    documented = written(spark, D.documented_feed(spark, SF_DIR))
    messages = {"orders": orders.count(), "both": both.count()}

    def state(*specs: S.TableSpec) -> State:
        return State(spark, new_folder(spark, "bench-state"), specs or (ORDERS,))

    # Batches in arrival order; the last one holds the replays.
    last = orders.agg(F.max("sequence_number")).first()[0]
    part = F.when(D.is_replay(), BATCHES - 1).when(F.col("arrival") >= D.LATE, BATCHES - 2).otherwise(
        F.floor(F.col("sequence_number") * (BATCHES - 1) / (last + 1))
    )
    parts = [written(spark, orders.filter(part == n)) for n in range(BATCHES)]

    def batches() -> None:
        target = state()
        for messages_of_part in parts:
            apply_batch(target, messages_of_part)
        target.maintain()

    def headers() -> DataFrame:
        return X.header_events(X.decode_live(orders), [ORDERS])

    def stream() -> None:
        path = new_folder(spark, "bench-stream")
        orders.write.parquet(path)
        consumer = Consumer("bench", new_folder(spark, "bench-state"), new_folder(spark, "bench-checkpoint"), (ORDERS,))
        start_consumer(spark, Source("parquet", path), consumer, available_now=True).awaitTermination()

    kept = state(*BOTH)
    run_out(materialize(both, BOTH).targets["Orders"])
    apply_batch(state(*BOTH), both)

    queries = {
        "decode_live": (lambda: run_out(X.decode_live(orders).drop("row", "value")), "orders"),
        "to_orders": (lambda: run_out(X.to_table(X.decode_live(orders), ORDERS)), "orders"),
        "decode_documented": (lambda: run_out(X.to_table(X.decode_documented(documented), ORDERS)), None),
        "feed_view": (lambda: run_out(X.feed_view(both)), "both"),
        "materialize_orders": (lambda: run_out(materialize(orders, [ORDERS]).targets["Orders"]), "orders"),
        "materialize_lines": (lambda: run_out(materialize(both, BOTH).targets["OrderLines"]), "both"),
        "materialize_offsets": (lambda: run_out(materialize(orders, [ORDERS]).offsets), "orders"),
        "materialize_all": (lambda: [run_out(df) for df in materialize(both, BOTH, keep=True).tables()], "both"),
        "classify": (lambda: run_out(V.partition_log(A.classify(staged(headers())))), "orders"),
        "key_skew": (lambda: run_out(V.key_skew(headers(), "key")), "orders"),
        "assign_batches": (lambda: run_out(A.assign_batches(staged(headers()), 500)), "orders"),
        "apply_batch_two_tables": (lambda: apply_batch(kept, both), "both"),
        "replay_two_tables": (lambda: replay(kept, both), "both"),
        "top_order_lines": (lambda: run_out(V.top_order_lines(kept.target(ORDER_LINES))), None),
        f"apply_{BATCHES}_batches": (batches, "orders"),
        "stream_orders": (stream, "orders"),
    }
    seconds, rate = {}, {}
    for name, (query, feed) in queries.items():
        times = []
        for _ in range(1 if name.startswith(COMMITTING) else REPEATS):
            start = time.perf_counter()
            query()
            times.append(time.perf_counter() - start)
        seconds[name] = round(median(times), 3)
        if feed:
            rate[name] = round(messages[feed] / seconds[name])
    print(json.dumps({
        "metric": "total seconds over all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "events_per_second": rate,
        "messages": messages,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
