"""Change feeds derived from the ``orders``, ``lineitem`` and ``events`` tables.

They stand in for a broker in tests, benchmarks and registered queries: a known set of
inserts, updates, deletes and replays per row, as JSON messages of the same shape a broker
delivers, so the result of applying them can be stated in plain SQL over the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sluice import schemas as S

PARTITIONS = 4
# Bits of an arrival, above any sequence number: events delivered late, and replays after those.
LATE, REPLAYED = 1 << 61, 1 << 62
# Further rows of one key are updates; each has the sequences above so many bits to itself.
FURTHER_BITS = 44

# The derived keys outgrow 32 bits where the tables are large.
ORDERS = replace(S.ORDERS, key_kind="bigint")
ORDER_LINES = replace(
    S.ORDER_LINES, key_kind="bigint",
    columns=tuple(replace(c, kind="bigint") if c.kind == "int" else c for c in S.ORDER_LINES.columns),
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key. What follows costs by the row, while files are split by bytes; a
    number of partitions that is asked for is not coalesced by bytes either."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _changes(rows: DataFrame, key: str, table: int, partition: Column) -> DataFrame:
    """One row per derived change: all keys INS, every 3rd UPD, 7th DEL, 5th replayed INS.

    Sequences of the tables interleave. The update of each 33rd key comes through the next
    partition and arrives after everything else but replays, so arrival contradicts sequence.
    ``further`` numbers the rows of one key: those after the first are an update each (k = 4).
    """
    k, late, further = F.col(key), (F.col("k") == 1) & (F.col(key) % 33 == 0), F.col("further")
    happens = F.array_compact(
        F.array(
            F.lit(0),
            F.when(k % 3 == 0, F.lit(1)),
            F.when(k % 7 == 0, F.lit(2)),
            F.when(k % 5 == 0, F.lit(3)),
        )
    )
    place = F.when(F.col("k").isin(1, 2), F.col("k")).otherwise(0)
    sequence = (k * 3 + place) * 2 + table + F.shiftleft(further.cast("long"), FURTHER_BITS)
    arrival = F.when(F.col("k") == 3, F.lit(REPLAYED)).when(late, F.lit(LATE)).otherwise(F.lit(0))
    return (
        rows.withColumn("k", F.explode(F.when(further > 0, F.array(F.lit(4))).otherwise(happens)))
        .withColumn("sequence_number", sequence.cast("long"))
        .withColumn("arrival", F.col("sequence_number") + arrival)
        .withColumn("operation", F.when(F.col("k").isin(1, 4), "UPD").when(F.col("k") == 2, "DEL").otherwise("INS"))
        .withColumn("partition_id", ((partition + late.cast("int")) % PARTITIONS).cast("int"))
    )


def order_changes(spark: SparkSession, sf_dir: str, only: Callable[[Column], Column] | None = None) -> DataFrame:
    """Changes of Orders, still as columns; ``only`` chooses rows by key before they are spread."""
    orders = read_table(spark, sf_dir, "orders")
    if only is not None:
        orders = orders.filter(only(F.col("o_orderkey")))
    orders = spread(orders, "o_orderkey").withColumn("further", F.lit(0))
    changes = _changes(orders, "o_orderkey", 0, F.col("o_orderkey"))
    text = F.col("o_orderkey").cast("string")
    return changes.select(
        "partition_id",
        "sequence_number", "arrival", "operation", "k",
        F.lit("Orders").alias("table"),
        F.lit("OrderID").alias("key_column"),
        F.col("o_orderkey").alias("key"),
        F.struct(
            F.col("o_orderkey").alias("OrderID"),
            F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("First "), text)).alias("CustomerFirstName"),
            F.concat(F.lit("Last "), text).alias("CustomerLastName"),
            F.col("o_orderstatus").alias("Company"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("SalesDate"),
            F.date_format(F.date_add("o_orderdate", 75), "yyyy-MM-dd").alias("EstimatedShipDate"),
            F.col("o_custkey").alias("ShippingID"),
            F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("Product"),
            F.when(F.col("k") == 1, 2).otherwise(1).alias("Quantity"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("Price"),
        ).alias("row"),
    )


def line_changes(spark: SparkSession, sf_dir: str, only: Callable[[Column], Column] | None = None) -> DataFrame:
    """Changes of OrderLines, still as columns: one at least for every row of ``lineitem``.

    Rows of one line number are that line's states one after the other, in order of their cells. ``only``
    chooses lines by key before their rows are spread.
    """
    line = F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("product"), F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    if only is not None:
        lineitem = lineitem.filter(only(line))
    states = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("product", "quantity", "price")
    lines = spread(lineitem, "l_orderkey", "l_linenumber").withColumn("further", F.row_number().over(states) - 1)
    lines = lines.withColumn("line", line)
    changes = _changes(lines, "line", 1, F.col("l_orderkey"))
    return changes.select(
        "partition_id",
        "sequence_number", "arrival", "operation", "k",
        F.lit("OrderLines").alias("table"),
        F.lit("OrderLineID").alias("key_column"),
        F.col("line").alias("key"),
        F.struct(
            F.col("line").alias("OrderLineID"),
            F.col("l_orderkey").alias("OrderID"),
            F.col("product").alias("ProductID"),
            (F.col("quantity") + F.when(F.col("k") == 1, 1).otherwise(0)).alias("Quantity"),
            F.col("price").alias("UnitPrice"),
        ).alias("row"),
    )


def live_json(changes: DataFrame) -> Column:
    """Live envelope; even keys carry ``data`` and ``current`` as text, odd ones as objects.

    Only the row needs a JSON writer: names, codes and numbers hold nothing to be escaped.
    """
    row, empty = F.when(F.col("operation") != "DEL", F.col("row")), F.lit(None).cast("string")
    source = (
        '"eventsource":{"db":"Shop","schema":"dbo","tbl":"', F.col("table"), '","pkkey":[{"columnname":"', F.col("key_column"),
        '","value":"', F.col("key").cast("string"), '"}],"transaction":{"committime":"L', F.col("sequence_number").cast("string"), '"}}',
    )
    # Text in text: what is known is escaped here, and the row twice at once.
    as_text = F.coalesce(_join('\\"current\\":\\"', _escaped(F.to_json(row), 2), '\\"'), F.lit(""))
    inside = [p.replace('"', '\\"') if isinstance(p, str) else p for p in source]
    as_object = F.coalesce(F.to_json(row, {"ignoreNullFields": "false"}), F.lit("null"))
    data = F.when(F.col("key") % 2 == 0, _join('"{', *inside, ',\\"eventrow\\":{', as_text, '}}"'))
    data = data.otherwise(_join("{", *source, ',"eventrow":{"current":', as_object, ',"old":null}}'))
    without_key = F.struct(
        F.struct(
            F.lit("Shop").alias("db"), F.lit("dbo").alias("schema"), F.col("table").alias("tbl"),
            F.array(F.struct(F.col("key_column").alias("columnname"), empty.alias("value"))).alias("pkkey"),
            F.struct(F.concat(F.lit("L"), F.col("sequence_number")).alias("committime")).alias("transaction"),
        ).alias("eventsource"),
        F.struct(row.alias("current"), empty.alias("old")).alias("eventrow"),
    )
    return F.when(
        F.col("key").isNull(), F.to_json(F.struct("operation", without_key.alias("data")), {"ignoreNullFields": "false"})
    ).otherwise(_join('{"operation":"', F.col("operation"), '","data":', data, "}"))


def _escaped(json: Column, depth: int = 1) -> Column:
    """JSON text as the inside of a JSON string (of one in another at depth 2): it has no control characters to be escaped."""
    backslash, quote = "\\" * 2**depth, "\\" * (2**depth - 1) + '"'
    return F.replace(F.replace(json, F.lit("\\"), F.lit(backslash)), F.lit('"'), F.lit(quote))


def documented_json(changes: DataFrame) -> Column:
    """The other envelope, with long operation names and before / after images."""
    long_name = (
        F.when(F.col("operation") == "INS", "INSERT")
        .when(F.col("operation") == "UPD", "UPDATE")
        .otherwise("DELETE")
    )
    before = F.when(
        F.col("operation") != "INS", F.col("row").withField("Quantity", F.lit(1))
    )
    data = F.struct(
        long_name.alias("operation"),
        F.lit("dbo").alias("schema"),
        F.col("table"),
        F.struct(F.col("key").alias("OrderID")).alias("primaryKey"),
        before.alias("before"),
        F.when(F.col("operation") != "DEL", F.col("row")).alias("after"),
        F.concat(F.lit("L"), F.col("sequence_number")).alias("commitLsn"),
        F.concat(F.lit("T"), F.col("sequence_number")).alias("transactionId"),
    )
    return F.to_json(F.struct(F.lit("1.0").alias("specversion"), data.alias("data")))


def _messages(changes: DataFrame, value: Column) -> DataFrame:
    """Messages of changes; a filter on the body does not write its JSON a second time."""
    return _step(changes, {"value": value}).select("partition_id", "sequence_number", "arrival", "value")


def waves(spark: SparkSession, sf_dir: str, lines: bool = False) -> list[DataFrame]:
    """The feed cut into batches: the first half of the Orders events by key, the others, line
    changes if asked for, and all replays."""
    tables = [order_changes, line_changes] if lines else [order_changes]
    middle = _middle(spark, sf_dir)
    first = F.col("arrival") < middle

    def events(changes: DataFrame, which: Column) -> DataFrame:
        return _messages(changes, live_json(changes)).filter(which)

    # Keys without an event in a wave are not moved for it: arrivals go from key * 6 to key * 6 + 4, or are late.
    early = order_changes(spark, sf_dir, lambda key: key * 6 < middle)
    rest = order_changes(spark, sf_dir, lambda key: (key * 6 >= middle - 4) | (key % 33 == 0))
    replays = [events(table(spark, sf_dir, lambda key: key % 5 == 0), is_replay()) for table in tables]
    others = [events(table(spark, sf_dir), ~is_replay()) for table in tables[1:]]
    return [
        events(early, ~is_replay() & first), events(rest, ~is_replay() & ~first), *others,
        reduce(DataFrame.unionByName, replays),
    ]


def is_replay() -> Column:
    return F.col("arrival") >= REPLAYED


def first_half(spark: SparkSession, sf_dir: str, per_key: int = 1) -> Column:
    """Condition for events that arrive before the feed's middle (keys ``per_key`` times as dense)."""
    return F.col("arrival") < _middle(spark, sf_dir, per_key)


def _middle(spark: SparkSession, sf_dir: str, per_key: int = 1) -> Column:
    last = read_table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("k"))
    return last.select((F.floor(F.col("k") / 2) * 6 * per_key).alias("middle")).scalar()


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(spark, sf_dir)
    return _messages(changes, live_json(changes))


def lines_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = line_changes(spark, sf_dir)
    return _messages(changes, live_json(changes))


def two_table_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_feed(spark, sf_dir).unionByName(lines_feed(spark, sf_dir))


def documented_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(spark, sf_dir)
    return _messages(changes, documented_json(changes))


def feed_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Orders feed with an empty body on every message of each 11th key."""
    changes = order_changes(spark, sf_dir)
    return _messages(changes, F.when(F.col("key") % 11 != 0, live_json(changes)))


def broker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a broker's column names, out of ``events``: timestamps are not in offset order."""
    events = read_table(spark, sf_dir, "events")
    late = F.when(F.col("event_id") % 10 == 0, F.lit(3600)).otherwise(F.lit(0)).cast("long")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - late * 1_000_000
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(F.lit("INS").alias("operation"), F.col("props").alias("data")))
        .cast("binary")
        .alias("value"),
        F.lit("orders").alias("topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(micros).alias("timestamp"),
    )


def _quoted(name: str, text: Column) -> Column:
    """``"name":"<text as a JSON string>"``."""
    pair = F.to_json(F.struct(text.alias(name)))
    return F.substring(pair, F.lit(2), F.length(pair) - 2)


def _pick(selector: Column, *texts: str | Column) -> Column:
    """The n-th fragment where the selector is n."""
    return F.element_at(
        F.array(*[t if isinstance(t, Column) else F.lit(t) for t in texts]),
        (selector + 1).cast("int"),
    )


def _join(*parts: str | Column) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _step(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns whose expressions stay where they are (see ``computed_once``)."""
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*df.columns, F.inline(F.array(row)))


# What each 23rd of the keys does wrong in the irregular feed; the rest is readable.
REJECT_CASES = {
    0: "truncated", 1: "no data", 2: "null data", 3: "null eventrow", 4: "numeric key value",
    5: "broken data text", 6: "broken row text", 7: "trailing text", 8: "numeric eventsource",
    9: "null transaction", 10: "numeric operation", 11: "numeric table", 12: "array message",
    13: "array row", 14: "fractional key column",
}


def irregular_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One INS message per order, in every shape the decoding rules tell apart.

    Which shape a part takes depends on the key modulo small numbers, so the expected result
    can be written as CASE expressions.
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    k = F.col("o_orderkey")
    key = k.cast("string")
    case = k % 23
    operation = F.when(case == 10, '"operation":7,').otherwise(
        _pick(k % 10, *['"operation":"INS",'] * 8, '"operation":null,', "")
    )
    table = F.when(case == 11, '"tbl":5').otherwise(
        F.when(k % 17 == 16, '"tbl":"orders"').otherwise('"tbl":"Orders"')
    )
    primary_key = (
        F.when(case == 4, _join(',"pkkey":[{"value":', key, "}]"))
        .when(case == 14, "")
        .otherwise(_pick(
            k % 8,
            _join(',"pkkey":[{"columnname":"OrderID","value":"', key, '"}]'),
            ',"pkkey":[{"value":"0"}]',
            ',"pkkey":[{"value":"abc"}]',
            "",
            ',"pkkey":[]',
            _join(',"pkkey":[{"value":"', key, '"},{"value":"999"}]'),
            _join(',"pkkey":[{"value":" ', key, ' "}]'),
            ',"pkkey":{}',
        ))
    )
    lsn = F.when(case == 9, ',"transaction":null').otherwise(_pick(
        k % 7,
        _join(',"transaction":{"committime":"T","commitlsn":"C', key, '"}'),
        _join(',"transaction":{"commitlsn":"","lsn":"N', key, '"}'),
        _join(',"transaction":{"committime":"T', key, '"}'),
        _join(',"transaction":{},"commitlsn":"S', key, '"'),
        _join(',"lsn":"U', key, '"'),
        ',"transaction":{"lsn":5}',
        F.lit(',"transaction":{"lsn":"' + "x" * 70 + '"}'),
    ))
    own_key = F.when(case == 14, '"OrderID":1.5,').otherwise(
        _pick(k % 3, _join('"OrderID":', key, ","), _join('"OrderID":"', key, '",'), "")
    )
    cells = _join(
        own_key,
        '"Quantity":', _pick(
            F.floor(k / 2) % 7, "2", '"2"', '" 2 "', "2.0", '"2.0"', "true", "3000000000"
        ),
        ',"Price":', _pick(k % 6, "11.5", '"11.50"', '"1,000"', '"2e0"', '"x"', "2e0"),
        ',"Company":', F.when(k % 4 == 0, "7").otherwise(_join('"', F.col("o_orderstatus"), '"')),
        ',"SalesDate":', _pick(
            k % 5, '"2026-04-20"', '"2026-04-20T23:30:00"', '"04/20/2026"', '"20 Apr 2026"', "5"
        ),
        F.when(k % 2 == 0, ',"EstimatedShipDate":"2026-04-20T23:30:00-05:00"').otherwise(""),
    )
    row = _join("{", cells, "}")
    rows = _step(orders.withColumn("k", k), {
        "case": case.cast("int"), "operation": operation, "cells": cells,
        "source": F.when(case == 8, '"eventsource":5').otherwise(
            _join('"eventsource":{', table, primary_key, lsn, "}")
        ),
    })
    k, case, cells = F.col("k"), F.col("case"), F.col("cells")
    current = (
        F.when(case == 13, '"current":[]')
        .when(case == 6, _quoted("current", _join("{", cells)))
        .when(k % 2 == 0, _quoted("current", _join("{", cells, "}")))
        .otherwise(_join('"current":{', cells, "}"))
    )
    event_row = F.when(case == 3, '"eventrow":null').otherwise(_join('"eventrow":{', current, ',"old":null}'))
    rows = _step(rows, {"data": _join("{", F.col("source"), ",", event_row, "}")})
    data = F.col("data")
    data_member = (
        F.when(case == 1, '"extra":1')
        .when(case == 2, '"data":null')
        .when(case == 5, _quoted("data", _join(data, ",")))
        .when(F.floor(k / 3) % 2 == 0, _quoted("data", data))
        .otherwise(_join('"data":', data))
    )
    rows = _step(rows, {"message": _join("{", F.col("operation"), data_member, "}")})
    message = F.col("message")
    value = (
        F.when(case == 0, F.substring(message, F.lit(1), F.length(message) - 1))
        .when(case == 7, _join(message, " and more"))
        .when(case == 12, _join("[", message, "]"))
        .otherwise(message)
    )
    return _step(rows.select("k", "case", "message"), {"value": value}).select(
        (k % PARTITIONS).cast("int").alias("partition_id"),
        k.alias("sequence_number"),
        k.alias("arrival"),
        "value",
    )


def feed_with_unknown_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Orders feed with another operation code on every change of each 13th key."""
    changes = order_changes(spark, sf_dir)
    operation = F.when(F.col("key") % 13 == 0, "TRUNC").otherwise(F.col("operation"))
    changes = changes.withColumn("operation", operation)
    return _messages(changes, live_json(changes))
