"""Events per partition and second, counted on the running stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators import views as V
from sluice.sources.changes import Source, read_changes

RATES_SCHEMA = "partition_id int, second timestamp, events long"


def start_rates(
    spark: SparkSession, source: Source, path: str, checkpoint: str, time: str = "broker_time", available_now: bool = False
) -> StreamingQuery:
    """Count a source's messages per broker partition and second of ``time``, without an end.

    The counts are the query's state, kept in the checkpoint: a restart goes on counting. Messages may be
    late by any time, so there is no watermark and the state holds one number per partition and
    second; for long histories choose the session's RocksDB state store. A batch writes the counts it
    changed under its number, so a batch that is repeated after a failure replaces what it wrote.
    """
    counts = V.events_per_second(read_changes(spark, source, stream=True), time)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_rates(spark: SparkSession, path: str) -> DataFrame:
    """The latest counts; a count only grows, so it is the greatest that was written."""
    written = spark.read.schema(f"{RATES_SCHEMA}, batch long").parquet(path)
    return written.groupBy("partition_id", "second").agg(F.max("events").alias("events"))
