"""Expected results of the registered queries, as plain SQL over the given tables.

None of these decode anything: they state what the derived feeds must come to.
"""

from __future__ import annotations

from sluice.sources.derived import FURTHER_BITS, LATE, REPLAYED


def _event_columns(key: str, table: int, partition: str) -> str:
    sequence = f"(({key} * 3 + CASE WHEN k = 3 THEN 0 ELSE k END) * 2 + {table})"
    return f"""
    CAST(({partition} + CASE WHEN k = 1 AND {key} % 33 = 0 THEN 1 ELSE 0 END) % 4 AS INTEGER) AS partition_id,
    {sequence} AS sequence_number,
    {sequence} + CASE WHEN k = 3 THEN {REPLAYED} WHEN k = 1 AND {key} % 33 = 0 THEN {LATE} ELSE 0 END AS arrival,
    CASE k WHEN 1 THEN 'UPD' WHEN 2 THEN 'DEL' ELSE 'INS' END AS operation,
    'L' || CAST({sequence} AS VARCHAR) AS commit_lsn"""


def _ks(key: str) -> str:
    return f"""unnest([0] || CASE WHEN {key} % 3 = 0 THEN [1] ELSE [] END
        || CASE WHEN {key} % 7 = 0 THEN [2] ELSE [] END
        || CASE WHEN {key} % 5 = 0 THEN [3] ELSE [] END) AS k"""


# Order changes as rows: ev (all deliveries) and firsts (without replays).
ORDERS_CTE = f"""ok AS (SELECT *, {_ks('o_orderkey')} FROM orders),
ev AS (SELECT {_event_columns('o_orderkey', 0, 'o_orderkey')},
    k, o_orderkey AS key,
    CASE WHEN k <> 2 AND o_orderkey % 4 <> 0 THEN 'First ' || o_orderkey END AS CustomerFirstName,
    CASE WHEN k <> 2 THEN 'Last ' || o_orderkey END AS CustomerLastName,
    CASE WHEN k <> 2 THEN o_orderstatus END AS Company,
    CASE WHEN k <> 2 THEN CAST(o_orderdate AS DATE) END AS SalesDate,
    CASE WHEN k <> 2 THEN CAST(o_orderdate AS DATE) + 75 END AS EstimatedShipDate,
    CASE WHEN k <> 2 THEN CAST(o_custkey AS INTEGER) END AS ShippingID,
    CAST(NULL AS VARCHAR) AS ShippingLocation,
    CASE WHEN k <> 2 AND o_orderkey % 9 <> 0 THEN o_orderpriority END AS Product,
    CAST(CASE k WHEN 2 THEN NULL WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS Quantity,
    CASE WHEN k <> 2 THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS Price
  FROM ok),
firsts AS (SELECT * FROM ev WHERE k <> 3)"""

LINES_CTE = f"""lines AS (SELECT l_orderkey, l_orderkey * 8 + l_linenumber AS line, l_partkey AS product,
    CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, CAST(l_quantity AS BIGINT), CAST(l_extendedprice AS DECIMAL(18,2))) - 1 AS further
  FROM lineitem),
lk AS (SELECT *, {_ks('line')} FROM lines WHERE further = 0),
further_lev AS (SELECT CAST(l_orderkey % 4 AS INTEGER) AS partition_id, further * {1 << FURTHER_BITS} + line * 6 + 1 AS sequence_number,
    4 AS k, line AS key, l_orderkey AS OrderID, product AS ProductID, quantity AS Quantity, price AS UnitPrice
  FROM lines WHERE further > 0),
lev AS (SELECT {_event_columns('line', 1, 'l_orderkey')},
    k, line AS key,
    CASE WHEN k <> 2 THEN l_orderkey END AS OrderID,
    CASE WHEN k <> 2 THEN product END AS ProductID,
    CASE WHEN k <> 2 THEN quantity + CASE WHEN k = 1 THEN 1 ELSE 0 END END AS Quantity,
    CASE WHEN k <> 2 THEN price END AS UnitPrice
  FROM lk
  UNION ALL SELECT partition_id, sequence_number, sequence_number, 'UPD', 'L' || CAST(sequence_number AS VARCHAR),
    k, key, OrderID, ProductID, Quantity, UnitPrice FROM further_lev),
lfirsts AS (SELECT * FROM lev WHERE k <> 3)"""

WITH_ORDERS = f"WITH {ORDERS_CTE} "
WITH_BOTH = f"WITH {ORDERS_CTE}, {LINES_CTE} "
ORDER_COLUMNS = (
    "CustomerFirstName, CustomerLastName, Company, SalesDate, EstimatedShipDate, ShippingID,"
    " ShippingLocation, Product, Quantity, Price"
)
LINE_COLUMNS = "OrderID, ProductID, Quantity, UnitPrice"
EVENT = "partition_id, sequence_number, arrival"

# Keys whose row is there in the end: not deleted, or updated after the deletion.
REMAINS = "({0} % 7 <> 0 OR {0} % 33 = 0)"

# The middle of the Orders feed: everything below is "before", late events and replays are "after".
MIDDLE = "(SELECT max(o_orderkey) // 2 * 6 FROM orders)"


def target(condition: str = "TRUE") -> str:
    """Final Orders rows in closed form."""
    return f"""SELECT o_orderkey AS OrderID,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'First ' || o_orderkey END AS CustomerFirstName,
    'Last ' || o_orderkey AS CustomerLastName, o_orderstatus AS Company, CAST(o_orderdate AS DATE) AS SalesDate,
    CAST(o_orderdate AS DATE) + 75 AS EstimatedShipDate, CAST(o_custkey AS INTEGER) AS ShippingID,
    CAST(NULL AS VARCHAR) AS ShippingLocation,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS Product,
    CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS Quantity,
    CAST(o_totalprice AS DECIMAL(10,2)) AS Price
  FROM orders WHERE {REMAINS.format('o_orderkey')} AND {condition}"""


# A line's last state counts, but the late update of each 33rd one brings back its first.
LINES_TARGET = f"""SELECT line AS OrderLineID, l_orderkey AS OrderID, product AS ProductID,
    quantity + CASE WHEN further = 0 AND line % 3 = 0 THEN 1 ELSE 0 END AS Quantity, price AS UnitPrice
  FROM lines WHERE further > 0 OR {REMAINS.format('line')}
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY CASE WHEN line % 33 = 0 THEN -further ELSE further END DESC) = 1"""

# Irregular messages: what the key's remainders come to.
_SHAPES = """shapes AS (SELECT o_orderkey AS key, o_orderkey % 23 AS c, o_orderkey % 17 = 16 AS other_table,
    CAST(o_orderkey % 4 AS INTEGER) AS partition_id, o_orderkey AS sequence_number, o_orderkey AS arrival,
    CASE WHEN o_orderkey % 10 >= 8 THEN '?' ELSE 'INS' END AS operation,
    CASE WHEN o_orderkey % 23 <> 14 AND o_orderkey % 8 IN (0, 5, 6) THEN nullif(o_orderkey, 0) END AS envelope_key,
    CASE WHEN o_orderkey % 3 IN (0, 1) THEN o_orderkey ELSE 0 END AS row_key,
    CASE o_orderkey % 7 WHEN 0 THEN 'C' || o_orderkey WHEN 1 THEN 'N' || o_orderkey
      WHEN 2 THEN 'T' || o_orderkey WHEN 3 THEN 'S' || o_orderkey WHEN 4 THEN 'U' || o_orderkey
      WHEN 5 THEN 'n/a' ELSE repeat('x', 64) END AS commit_lsn, o_orderstatus
  FROM orders),
reasons AS (SELECT *, CASE
    WHEN c IN (0, 7, 12) THEN 'bad message' WHEN c = 10 THEN 'bad operation' WHEN c = 1 THEN 'no data'
    WHEN c IN (2, 5) THEN 'bad data' WHEN c = 8 THEN 'bad eventsource' WHEN c = 11 THEN 'bad table'
    WHEN c = 4 THEN 'bad primary key' WHEN c = 3 THEN 'bad eventrow' WHEN c = 6 THEN 'bad row image'
    WHEN c = 9 THEN 'bad transaction' END AS unreadable
  FROM shapes),
typed AS (SELECT *, coalesce(unreadable, CASE WHEN other_table THEN NULL
    WHEN c = 13 THEN 'row image is no object' WHEN c = 14 THEN 'bad key column' END) AS reject_reason
  FROM reasons),
mine AS (SELECT * FROM typed WHERE reject_reason IS NULL OR NOT (other_table AND c IN (3, 4, 6, 9, 10))),
good AS (SELECT *, coalesce(envelope_key, row_key, 0) AS OrderID
  FROM typed WHERE reject_reason IS NULL AND NOT other_table)"""
WITH_SHAPES = f"WITH {_SHAPES} "


def oracle_sql() -> dict[str, str]:
    half = f"arrival < {MIDDLE}"
    key_text = "'OrderID=' || CAST(key AS VARCHAR)"
    ledger_before = f"(SELECT partition_id, sequence_number FROM firsts WHERE {half})"
    unseen = f"(partition_id, sequence_number) NOT IN {ledger_before}"
    offsets = """SELECT partition_id, arg_max(sequence_number, arrival) AS last_sequence_number,
        arg_max(commit_lsn, arrival) AS last_commit_lsn, max(arrival) AS last_arrival FROM {} GROUP BY partition_id"""
    both = """SELECT partition_id, sequence_number, arrival, operation, commit_lsn, 'Orders' AS tbl, key, k FROM ev
        UNION ALL SELECT partition_id, sequence_number, arrival, operation, commit_lsn, 'OrderLines', key, k FROM lev"""
    money = "CAST(CAST({} AS DECIMAL(38,2)) AS VARCHAR)"
    # Source
    sql = {
        "s1_read_changes": f"{WITH_ORDERS} SELECT {EVENT}, operation FROM ev",
        "s1_broker_arrival": """WITH b AS (SELECT CAST(event_id % 4 AS INTEGER) AS partition_id, event_id AS sequence_number,
            CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END AS t FROM events)
            SELECT partition_id, sequence_number, max(t) OVER (PARTITION BY partition_id ORDER BY sequence_number
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t FROM b""",
        "s2_resume": f"""{WITH_ORDERS}, waves AS (SELECT sequence_number, partition_id, k, CASE WHEN k = 3 THEN 3 WHEN {half} THEN 1 ELSE 2 END AS wave FROM ev)
            SELECT CAST(wave AS INTEGER) AS run, CAST(sum(CASE WHEN k <> 3 THEN 1 ELSE 0 END) AS BIGINT) AS applied FROM waves GROUP BY wave""",
        "s3_start_at": f"""{WITH_ORDERS} SELECT {EVENT} FROM ev
            WHERE (partition_id = 0 AND sequence_number >= 600) OR (partition_id = 1 AND sequence_number >= 3000) OR partition_id NOT IN (0, 1)""",
        "s4_resume_after": f"""{WITH_ORDERS}, stored AS (SELECT partition_id, max(sequence_number) AS last FROM firsts
              WHERE {half} AND partition_id <> 3 GROUP BY partition_id)
            SELECT {EVENT} FROM ev LEFT JOIN stored USING (partition_id) WHERE last IS NULL OR sequence_number > last""",
        "s5_drop_empty": f"{WITH_ORDERS} SELECT {EVENT} FROM ev WHERE key % 11 <> 0",
        "s6_fan_out": f"""{WITH_ORDERS}, c AS (SELECT 'A' AS consumer, * FROM firsts
              UNION ALL SELECT 'B', * FROM firsts WHERE sequence_number >= 600),
            n AS (SELECT consumer, key, arg_max(operation, arrival) AS op FROM c GROUP BY consumer, key)
            SELECT l.consumer, ledger_rows, target_rows FROM
              (SELECT consumer, count(*) AS ledger_rows FROM c GROUP BY consumer) l JOIN
              (SELECT consumer, count(*) AS target_rows FROM n WHERE op <> 'DEL' GROUP BY consumer) t USING (consumer)""",
        "s6_one_decode": f"""{WITH_BOTH}, b AS (SELECT * FROM firsts WHERE sequence_number >= 600),
            net AS (SELECT key, arg_max(operation, arrival) AS op, arg_max(Quantity, arrival) AS q FROM b GROUP BY key)
            SELECT 'A' AS consumer, 'Orders' AS target, OrderID AS key, CAST(Quantity AS BIGINT) AS Quantity FROM ({target()})
            UNION ALL SELECT 'A', 'OrderLines', OrderLineID, Quantity FROM ({LINES_TARGET})
            UNION ALL SELECT 'B', 'Orders', key, q FROM net WHERE op <> 'DEL'""",
        "s7_load_state": f"{WITH_ORDERS} SELECT partition_id, sequence_number, commit_lsn FROM firsts",
        "s8_reset_state": target(),
        "s9_commit_state": f"""{WITH_BOTH}, a AS ({both}) SELECT 'ledger' AS part, count(*) AS n FROM a WHERE k <> 3
            UNION ALL SELECT 'offsets', count(DISTINCT partition_id) FROM a
            UNION ALL SELECT 'Orders', (SELECT count(*) FROM orders WHERE {REMAINS.format('o_orderkey')})
            UNION ALL SELECT 'OrderLines', (SELECT count(*) FROM ({LINES_TARGET}))""",
        "s10_assign_partition": """SELECT count(*) AS keys, count(*) AS key_partition_pairs, TRUE AS in_range
            FROM (SELECT DISTINCT o_custkey FROM orders)""",
        "s11_select_published_columns": """SELECT o_orderkey AS key, CAST(json_object('o_orderkey', o_orderkey,
            'o_orderstatus', o_orderstatus, 'o_orderpriority', o_orderpriority) AS VARCHAR) AS value FROM orders""",
        # Decode
        "d1_decode_live": f"""{WITH_BOTH}, a AS ({both}) SELECT {EVENT}, operation, 'dbo' AS schema_name, tbl AS "table", nullif(key, 0) AS key_id, commit_lsn,
            operation <> 'DEL' AS has_row, CAST(NULL AS VARCHAR) AS reject_reason FROM a""",
        "d1_decode_irregular": f"""{WITH_SHAPES} SELECT {EVENT}, operation, CASE WHEN other_table THEN 'orders' ELSE 'Orders' END AS "table",
            envelope_key AS key_id, commit_lsn FROM typed WHERE unreadable IS NULL""",
        "d2_unwrap_json": f"{WITH_ORDERS} SELECT {EVENT}, key, Product, Company FROM ev",
        "d3_row_image": f"{WITH_ORDERS} SELECT {EVENT}, operation <> 'DEL' AS has_row, operation <> 'DEL' AS has_image FROM ev",
        "d4_primary_key": f"{WITH_SHAPES} SELECT {EVENT}, OrderID FROM good",
        "d5_commit_lsn": f"{WITH_SHAPES} SELECT {EVENT}, commit_lsn FROM typed WHERE unreadable IS NULL",
        "d6_to_orders": f"{WITH_ORDERS} SELECT {EVENT}, operation, commit_lsn, key AS OrderID, {ORDER_COLUMNS} FROM ev",
        "d6_irregular_values": f"""{WITH_SHAPES} SELECT {EVENT}, OrderID,
            CASE WHEN key % 4 <> 0 THEN o_orderstatus END AS Company,
            CASE WHEN key % 5 <> 4 THEN DATE '2026-04-20' END AS SalesDate,
            CASE WHEN key % 2 = 0 THEN DATE '2026-04-21' END AS EstimatedShipDate,
            CAST(CASE WHEN key // 2 % 7 <= 2 THEN 2 END AS INTEGER) AS Quantity,
            CAST(CASE key % 6 WHEN 0 THEN 11.5 WHEN 1 THEN 11.5 WHEN 2 THEN 1000 WHEN 5 THEN 2 END AS DECIMAL(10,2)) AS Price
            FROM good""",
        "d7_to_order_lines": f"{WITH_BOTH} SELECT {EVENT}, operation, commit_lsn, key AS OrderLineID, {LINE_COLUMNS} FROM lev",
        "d8_decode_documented": f"{WITH_ORDERS} SELECT {EVENT}, operation, commit_lsn, key AS OrderID, {ORDER_COLUMNS} FROM ev",
        "d9_rejects": f"""{WITH_SHAPES} SELECT partition_id, sequence_number, unreadable AS reject_reason
            FROM reasons WHERE unreadable IS NOT NULL""",
        "d10_bad_key_rejects": f"""{WITH_SHAPES} SELECT partition_id, sequence_number, reject_reason
            FROM mine WHERE unreadable IS NULL AND reject_reason IS NOT NULL""",
        "d11_feed_view": f"""{WITH_BOTH}, a AS ({both}) SELECT {EVENT}, operation, 'Shop' AS "database", 'dbo' AS "schema", tbl AS "table",
            'dbo.' || tbl AS table_full_name, 'ID: ' || CAST(key AS VARCHAR) AS primary_key,
            CASE WHEN tbl = 'Orders' AND operation <> 'DEL' THEN CASE WHEN key % 4 <> 0 THEN 'First ' || key || ' ' ELSE '' END || 'Last ' || key
              ELSE '' END AS customer_name FROM a""",
        # Apply
        "a1_only_table": f"{WITH_BOTH}, a AS ({both}) SELECT {EVENT}, key FROM a WHERE tbl = 'OrderLines'",
        "a2_subscribe": f'{WITH_BOTH}, a AS ({both}) SELECT {EVENT}, tbl AS "table", key FROM a',
        "a3_route": f"{WITH_BOTH}, a AS ({both}) SELECT tbl AS target, {EVENT}, key FROM a",
        "a3_route_by_schema": f"{WITH_ORDERS} SELECT 'Orders' AS target, 'dbo' AS schema_name, {EVENT}, key FROM ev",
        "a4_route_by_config": f"""{WITH_BOTH} SELECT 'Orders' AS target, {EVENT}, key, CASE WHEN operation <> 'DEL' THEN Product END AS first_cell FROM ev
            UNION ALL SELECT 'OrderLines', {EVENT}, key, CAST(ProductID AS VARCHAR) FROM lev""",
        "a5_dedup_in_batch": f"{WITH_ORDERS} SELECT {EVENT}, operation FROM firsts",
        "a6_new_events": f"{WITH_ORDERS} SELECT {EVENT}, operation FROM ev WHERE {unseen}",
        "a7_classify": f"{WITH_ORDERS} SELECT {EVENT}, operation, k <> 3 AND NOT {half} AS applied FROM ev",
        "a8_last_change_per_key": f"""{WITH_ORDERS} SELECT key AS OrderID, arg_max(operation, arrival) AS operation,
            arg_max(sequence_number, arrival) AS sequence_number FROM firsts GROUP BY key""",
        "a9_merge_orders": target(),
        "a10_merge_order_lines": f"WITH {LINES_CTE} {LINES_TARGET}",
        "a11_unknown_operation": f"""{WITH_ORDERS}, o AS (SELECT *, key % 13 = 0 AS odd FROM firsts)
            SELECT 'ledger rows' AS what, count(*) AS n FROM o
            UNION ALL SELECT 'target rows', count(*) FROM (SELECT key FROM o WHERE NOT odd GROUP BY key HAVING arg_max(operation, arrival) <> 'DEL')""",
        "a12_append_ledger": f"{WITH_ORDERS} SELECT {EVENT}, commit_lsn FROM firsts",
        "a13_upsert_offsets": f"{WITH_ORDERS} {offsets.format('firsts')}",
        "a15_apply_batch": target(),
        "a16_apply_multi_table": f"""{WITH_BOTH}, a AS ({both}) {offsets.format("(SELECT * FROM a WHERE k <> 3 AND tbl = 'OrderLines')")}""",
        "a16_multi_table_lines": f"WITH {LINES_CTE} {LINES_TARGET}",
        "a17_apply_partitions": f"""{WITH_ORDERS} SELECT partition_id, count(*) AS applied, arg_max(sequence_number, arrival) AS last_sequence_number
            FROM firsts GROUP BY partition_id""",
        "a18_assign_batches": f"""{WITH_ORDERS} SELECT {EVENT}, CAST(ceil(row_number() OVER (PARTITION BY partition_id ORDER BY arrival) / 100.0) AS BIGINT) AS batch FROM ev""",
        "a18_assign_broker_batches": """SELECT CAST(event_id % 4 AS INTEGER) AS partition_id, event_id AS sequence_number,
            CAST(ceil(row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) / 100.0) AS BIGINT) AS batch FROM events""",
        "a19_replay": target(),
        "a20_abort_batch": f"""{WITH_ORDERS}, b AS (SELECT * FROM firsts WHERE {half}),
            net AS (SELECT key, arg_max(operation, arrival) AS op, arg_max(Quantity, arrival) AS Quantity FROM b GROUP BY key)
            SELECT key AS OrderID, Quantity FROM net WHERE op <> 'DEL'""",
        "a21_materialize": target(),
        # Views
        "v1_ledger_view": f"{WITH_ORDERS} SELECT {EVENT}, commit_lsn FROM firsts",
        "v2_latest_offset": f"""{WITH_ORDERS} SELECT partition_id, sequence_number AS last_sequence_number, commit_lsn AS last_commit_lsn,
            arrival AS last_arrival FROM firsts ORDER BY arrival DESC LIMIT 1""",
        "v3_offsets_by_partition": f"{WITH_ORDERS} {offsets.format('firsts')}",
        "v4_count_rows": f"""SELECT count(*) AS "rows" FROM orders WHERE {REMAINS.format('o_orderkey')}""",
        "v5_top_orders": f"""WITH t AS ({target()}) SELECT OrderID, 'OrderID=' || CAST(OrderID AS VARCHAR) || ' · ' || coalesce(Product, '?') || ' · Qty '
            || CAST(Quantity AS VARCHAR) || ' · ' || {money.format('Price')} AS line FROM t ORDER BY OrderID DESC LIMIT 50""",
        "v6_top_order_lines": f"""WITH {LINES_CTE}, t AS ({LINES_TARGET}) SELECT OrderLineID, 'OrderLineID=' || CAST(OrderLineID AS VARCHAR) || ' · OrderID='
            || CAST(OrderID AS VARCHAR) || ' · ProductID=' || CAST(ProductID AS VARCHAR) || ' · ' || CAST(Quantity AS VARCHAR) || ' × '
            || {money.format('UnitPrice')} || ' = ' || {money.format('Quantity * UnitPrice')} AS line FROM t ORDER BY OrderLineID DESC LIMIT 50""",
        "v6_line_totals": f"WITH {LINES_CTE}, t AS ({LINES_TARGET}) SELECT OrderLineID, CAST(Quantity * UnitPrice AS DECIMAL(38,2)) AS LineTotal FROM t",
        "v7_apply_counts": f"""{WITH_ORDERS}, l AS (SELECT * FROM firsts ORDER BY arrival DESC LIMIT 1)
            SELECT (SELECT count(*) FROM firsts) AS applied, (SELECT count(*) FROM ev WHERE k = 3) AS duplicates,
              sequence_number AS last_sequence_number, commit_lsn AS last_commit_lsn FROM l""",
        "v8_recent_log": f"{WITH_ORDERS} SELECT arrival, operation, {key_text} AS key_text, sequence_number, k <> 3 AS applied FROM ev ORDER BY arrival DESC LIMIT 200",
        "v8_recent_applied": f"""{WITH_ORDERS} SELECT arrival, partition_id, sequence_number, operation AS op, {key_text} AS key_text, commit_lsn
            FROM firsts ORDER BY arrival DESC LIMIT 200""",
        "v9_partition_log": f"{WITH_ORDERS} SELECT partition_id, arrival, sequence_number, CASE WHEN k = 3 THEN 'DUP' ELSE operation END AS op, commit_lsn FROM ev",
        "v9_loaded_partition_log": f"{WITH_ORDERS} SELECT partition_id, sequence_number, '—' AS op, commit_lsn FROM firsts",
        "v10_backlog": f"""{WITH_ORDERS}, w AS (SELECT * FROM firsts WHERE NOT {half})
            SELECT partition_id, count(*) AS waiting, 'seq ' || CAST(arg_min(sequence_number, arrival) AS VARCHAR) || ' ' || arg_min(operation, arrival)
              || ' OrderID=' || CAST(arg_min(key, arrival) AS VARCHAR) AS next_event,
              CASE WHEN count(*) > 1 THEN '+' || CAST(count(*) - 1 AS VARCHAR) || ' more' ELSE '' END AS more
            FROM w GROUP BY partition_id""",
        "v10_backlog_irregular": f"""{WITH_SHAPES}, w AS (SELECT * FROM good WHERE sequence_number % 2 <> 0)
            SELECT partition_id, count(*) AS waiting, 'seq ' || min(sequence_number) || ' ' || arg_min(operation, sequence_number)
              || ' on .Orders' AS next_event,
              CASE WHEN count(*) > 1 THEN '+' || (count(*) - 1) || ' more' ELSE '' END AS more
            FROM w GROUP BY partition_id""",
        "v11_quarantine": f"{WITH_SHAPES} SELECT partition_id, sequence_number, reject_reason FROM mine WHERE reject_reason IS NOT NULL",
        "v12_key_skew": f"""{WITH_ORDERS}, g AS (SELECT key, count(*) AS n, count(DISTINCT partition_id) AS p FROM ev GROUP BY key)
            SELECT count(*) AS keys, CAST(sum(n) AS BIGINT) AS events, max(n) AS hottest_key_events,
              CAST(max(n) AS DOUBLE) / sum(n) AS hottest_key_share, count(*) FILTER (WHERE p > 1) AS keys_in_many_partitions,
              count(*) FILTER (WHERE key = 0) AS absent_keys FROM g""",
        "v12_key_skew_irregular": f"""{WITH_SHAPES}, g AS (SELECT OrderID AS key, count(*) AS n, count(DISTINCT partition_id) AS p FROM good GROUP BY OrderID)
            SELECT count(*) AS keys, CAST(sum(n) AS BIGINT) AS events, max(n) AS hottest_key_events,
              CAST(max(n) AS DOUBLE) / sum(n) AS hottest_key_share, count(*) FILTER (WHERE p > 1) AS keys_in_many_partitions,
              count(*) FILTER (WHERE key = 0) AS absent_keys FROM g""",
        "v12_events_per_user": "SELECT user_id, count(*) AS events FROM events GROUP BY user_id",
        # Summaries of three parts, each less its 101st count, added up, less the 101st sum.
        "v12_frequent_users": """WITH c AS (SELECT event_id % 3 AS part, user_id, count(*) AS n FROM events GROUP BY ALL),
            r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY n DESC) AS place FROM c),
            k AS (SELECT part, coalesce(max(n) FILTER (WHERE place = 101), 0) AS cut FROM r GROUP BY part),
            m AS (SELECT user_id, sum(n - cut) AS n FROM c JOIN k USING (part) WHERE n > cut GROUP BY user_id),
            last AS (SELECT coalesce((SELECT n FROM m ORDER BY n DESC LIMIT 1 OFFSET 100), 0) AS cut)
            SELECT user_id, CAST(n - cut AS BIGINT) AS at_least, CAST(n + (SELECT sum(cut) FROM k) AS BIGINT) AS at_most
            FROM m, last WHERE n > cut""",
        "v12_frequent_keys": f"""{WITH_BOTH}, a AS ({both})
            SELECT tbl AS "table", key, count(*) AS at_least, count(*) AS at_most FROM a WHERE k <> 3 GROUP BY ALL""",
        "v12_partition_skew": f"""{WITH_ORDERS} SELECT partition_id, count(*) AS events,
            CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share FROM ev GROUP BY partition_id""",
        "v13_events_per_second": """SELECT CAST(event_id % 4 AS INTEGER) AS partition_id, date_trunc('second',
            CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END) AS "second", count(*) AS events FROM events GROUP BY ALL""",
        "v13_stream_rates": """SELECT CAST(event_id % 4 AS INTEGER) AS partition_id, date_trunc('second',
            CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END) AS "second", count(*) AS events FROM events GROUP BY ALL""",
        "v13_replay_counts": f"""{WITH_ORDERS} SELECT partition_id, count(*) AS delivered, count(DISTINCT sequence_number) AS distinct_events,
            count(*) - count(DISTINCT sequence_number) AS repeats FROM ev GROUP BY partition_id""",
        "v13_ledger_growth": f"""{WITH_ORDERS} SELECT partition_id, count(*) AS ledger_rows, min(sequence_number) AS first_sequence,
            max(sequence_number) AS last_sequence FROM firsts GROUP BY partition_id""",
        "v15_feed_count": f"{WITH_BOTH}, a AS ({both}) SELECT count(*) AS events FROM a",
        "v15_feed_newest_first": f"{WITH_ORDERS} SELECT {EVENT}, operation, 'ID: ' || CAST(key AS VARCHAR) AS primary_key FROM ev",
        "v16_latest_errors": """SELECT event_id, event_type, "value", ts FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10""",
        "v16_latest_quarantine": f"""{WITH_SHAPES} SELECT partition_id, sequence_number, reject_reason FROM mine
            WHERE reject_reason IS NOT NULL ORDER BY sequence_number DESC LIMIT 10""",
        "v17_ship_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 75 AS ship_date FROM orders",
        "v18_next_key": f"SELECT coalesce(max(o_orderkey), 0) + 1 AS next_key FROM orders WHERE {REMAINS.format('o_orderkey')}",
        "v19_update_latest": f"""WITH t AS ({target()}) SELECT OrderID, CAST(CASE WHEN OrderID = (SELECT max(OrderID) FROM t) THEN 7 ELSE Quantity END AS INTEGER) AS Quantity,
            CAST(CASE WHEN OrderID = (SELECT max(OrderID) FROM t) THEN 22.00 ELSE Price END AS DECIMAL(10,2)) AS Price FROM t""",
        "v19_delete_where": target("o_orderstatus <> 'F'"),
        "v20_change_mask": f"""{WITH_ORDERS} SELECT {EVENT}, operation,
            CASE WHEN operation = 'UPD' THEN 'Quantity' WHEN key % 9 = 0 THEN 'Company,SalesDate,Quantity,Price'
              ELSE 'Company,SalesDate,Product,Quantity,Price' END AS changed FROM ev""",
    }
    return sql | {"v5_top_committed_orders": sql["v5_top_orders"], "v6_top_committed_lines": sql["v6_top_order_lines"]}
