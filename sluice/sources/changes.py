"""Reading change messages, choosing where to start, and shaping what is published."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.types import StructType

from sluice import schemas as S
from sluice.operators.numbering import running_max


# Default bounds of a micro-batch.
BATCH_BOUND = {"maxOffsetsPerTrigger": 1_000_000, "maxFilesPerTrigger": 1_000}


@dataclass(frozen=True)
class Source:
    """Where messages come from: a broker topic or files of message rows.

    ``format`` is ``kafka`` (needs Spark's Kafka connector on the classpath; ``options``
    carry servers, topic and security) or a file format such as parquet or json with
    ``path``. ``schema`` is the file schema; files may also have a broker's column names.
    ``append_time`` says that the broker sets a message's time when it appends it, so times never
    go back inside a partition and the arrival order needs no shuffle.
    """

    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    schema: StructType = field(default_factory=lambda: S.MESSAGE_SCHEMA)
    append_time: bool = False


def starting_offsets(topic: str, positions: Mapping[int, int], partitions: int) -> str:
    """A broker source's start option: given positions, the beginning for other partitions."""
    earliest = -2
    return json.dumps({topic: {str(p): positions.get(p, earliest) for p in range(partitions)}})


def start_option(source: Source, positions: Mapping[int, int]) -> str:
    """Where a new reader of the source begins: at its positions if the broker can seek there.

    That needs one topic and, as option ``partitions``, its number of partitions; else the source
    is read from the beginning and :func:`start_at` skips what lies before the positions.
    """
    topic, partitions = source.options.get("subscribe"), source.options.get("partitions")
    if source.format != "kafka" or not positions or not topic or "," in topic or not partitions:
        return "earliest"
    return starting_offsets(topic, positions, int(partitions))


def read_changes(
    spark: SparkSession,
    source: Source,
    stream: bool = False,
    start: str = "earliest",
) -> DataFrame:
    """Messages of all partitions as partition_id, sequence_number, arrival, value.

    A stream's position lives in its checkpoint: with a new checkpoint everything is read
    again from ``start``, with a kept one reading resumes where it stopped. Bounded batches
    come from the source's own options (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    reader = (spark.readStream if stream else spark.read).format(source.format)
    options = dict(source.options)
    options.pop("partitions", None)
    if stream:  # a first batch is not the whole log
        bound = "maxOffsetsPerTrigger" if source.format == "kafka" else "maxFilesPerTrigger"
        options.setdefault(bound, str(BATCH_BOUND[bound]))
    reader = reader.options(**options)
    if source.format == "kafka":
        return message_columns(reader.option("startingOffsets", start).load())
    return message_columns(reader.schema(source.schema).load(source.path))


def message_columns(df: DataFrame) -> DataFrame:
    """Rename a broker's columns to ours; the record key is not used, the value is text."""
    if "partition" not in df.columns:
        return df
    return df.select(
        F.col("partition").cast("int").alias("partition_id"),
        F.col("offset").cast("long").alias("sequence_number"),
        F.col("timestamp").alias("broker_time"),
        F.col("value").cast("string").alias("value"),
    )


def arrival_position(df: DataFrame) -> Column:
    """Arrival as one BIGINT, to be stored: the number itself, or the microsecond of its time.

    Default arrivals of one microsecond are in order of partition and sequence.
    """
    kind = df.schema["arrival"].dataType
    if isinstance(kind, T.StructType):
        return F.unix_micros("arrival.t")
    return F.unix_micros("arrival") if isinstance(kind, T.TimestampType) else F.col("arrival").cast("long")


def with_arrival(df: DataFrame, monotone: bool = False) -> DataFrame:
    """Add the default arrival order of a broker's messages, unless they carry their own.

    ``(t, partition_id, sequence_number)``, where t is the greatest broker time so far in the
    partition, so a partition always keeps its sequence order. Pass ``monotone`` when broker
    times never go back inside a partition (set on append): then no shuffle is needed.
    """
    if "arrival" in df.columns:
        return df
    if monotone:
        timed = df.withColumn("_t", F.col("broker_time"))
    else:
        timed = running_max(df, ["partition_id"], "sequence_number", F.col("broker_time"), "_t")
    return timed.withColumn("arrival", F.struct(F.col("_t").alias("t"), *S.EVENT_ID)).drop("_t")


def drop_empty(messages: DataFrame) -> DataFrame:
    """Skip messages without a body."""
    return messages.filter(F.col("value").isNotNull())


def start_at(messages: DataFrame, positions: Mapping[int, int]) -> DataFrame:
    """Ignore everything before a given sequence, per partition.

    ``positions`` has one entry per broker partition, few enough for a plain predicate, which
    reaches the file scan. Partitions not named are read from the beginning.
    """
    partition, sequence = F.col("partition_id"), F.col("sequence_number")
    wanted = ~partition.isin(list(positions)) if positions else F.lit(True)
    for p, first in positions.items():
        wanted = wanted | ((partition == p) & (sequence >= first))
    return messages.filter(wanted)


def resume_after(messages: DataFrame, offsets: DataFrame) -> DataFrame:
    """Only messages after each partition's stored offset; all where there is none.

    The offsets have one row per broker partition, and a NULL stored sequence keeps all of its
    partition. How the small side reaches the messages is Spark's choice by its size.
    """
    stored = offsets.select("partition_id", "last_sequence_number")
    last = F.col("last_sequence_number")
    return (
        messages.join(stored, "partition_id", "left")
        .filter(last.isNull() | (F.col("sequence_number") > last))
        .select(*messages.columns)
    )


def assign_partition(df: DataFrame, key: str | Column, n: int = 4) -> DataFrame:
    """Hash scheme of a publisher: the key decides the partition."""
    column = F.col(key) if isinstance(key, str) else key
    return df.withColumn("partition_id", F.pmod(F.xxhash64(column), F.lit(n)).cast("int"))


def select_published_columns(df: DataFrame, pk: str, include: Sequence[str]) -> DataFrame:
    """What a publisher sends of a table: its key and the listed columns, as text."""
    names = [pk, *[c for c in include if c != pk]]
    return df.select(
        F.col(pk).alias("key"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"),
    )
