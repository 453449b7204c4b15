"""Decoding of change messages: JSON text to typed events, with reasons for rejects.

Decoding is a chain of projections over VARIANT values, no Python code per row. Each message
is parsed once (twice or three times only where the feed nests JSON as text). Messages that
cannot be decoded are kept, with a ``reject_reason``; all others have NULL there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sluice import schemas as S
from sluice.functions import variant as V
from sluice.functions.barrier import computed_once
from sluice.session import require_settings

# Members read from the live envelope and from the documented one (fixed values).
_LIVE_DATA = (
    "struct<eventsource: struct<db: variant, schema: variant, tbl: variant,"
    " pkkey: array<struct<value: variant>>,"
    " transaction: struct<commitlsn: variant, lsn: variant, committime: variant>,"
    " commitlsn: variant, lsn: variant>,"
    " eventrow: struct<current: variant>>"
)
_DOCUMENTED_DATA = (
    "struct<operation: variant, schema: variant, `table`: variant, primaryKey: variant,"
    " before: variant, after: variant, commitLsn: variant, transactionId: variant>"
)
# Places of the commit LSN, in order of preference (fixed values).
_LSN_PLACES = [
    "_source.transaction.commitlsn",
    "_source.transaction.lsn",
    "_source.transaction.committime",
    "_source.commitlsn",
    "_source.lsn",
]


def unwrap_json(df: DataFrame, data_type: str, members: str = "") -> DataFrame:
    """Parse ``value`` and read its ``data`` member, an object or a JSON string holding one.

    Adds ``_env`` (``data`` and further members of the envelope, NULL if the message is no
    object) and ``_data`` of the given type, NULL if it is neither. ``_parsed`` and
    ``_nested`` hold the parsed texts for a closer look at unusual messages.
    """
    keep = df.columns
    env = f"struct<{members}data: {data_type}>"
    df = df.selectExpr(*keep, f"{V.parse_whole('value')} AS _parsed")
    df = df.selectExpr("*", f"{V.as_array('_parsed', env)} AS _elements")
    keep = [*keep, "_parsed"]
    df = computed_once(df, {"_env": V.whole_value("_elements")}, keep)
    as_text = V.text("try_variant_get(_parsed, '$[0].data', 'variant')")
    df = df.selectExpr(
        "*",
        f"IF(_env IS NOT NULL AND _env.data IS NULL, {V.parse_whole(as_text)}, NULL) AS _nested",
    )
    df = df.selectExpr("*", f"{V.as_array('_nested', data_type)} AS _elements")
    return df.selectExpr(
        *keep, "_env", "_nested", f"coalesce(_env.data, {V.whole_value('_elements')}) AS _data"
    )


def _present(member: str) -> str:
    """A member of ``data`` that is there, whatever it holds (JSON null too)."""
    return (
        f"(coalesce(try_variant_get(_nested, '$[0].{member}', 'variant'),"
        f" try_variant_get(_parsed, '$[0].data.{member}', 'variant')) IS NOT NULL)"
    )


def _open_live(df: DataFrame) -> DataFrame:
    """Split the live envelope into its parts: ``_env``, ``_data``, ``_key``, ``row`` ..."""
    df = unwrap_json(df, _LIVE_DATA, "operation: variant, ")
    return row_image(computed_once(df, {
        "_has_key": "coalesce(size(_data.eventsource.pkkey) > 0, false)",
        "_key": "get(_data.eventsource.pkkey, 0)",
        "_current": "_data.eventrow.current",
        "_row_text": V.text("_data.eventrow.current"),
        "_operation": V.text("_env.operation"),
        "_table": V.text("_data.eventsource.tbl"),
        "_key_text": V.text("get(_data.eventsource.pkkey, 0).value"),
    }))


def row_image(df: DataFrame) -> DataFrame:
    """The row after the change: ``current`` as VARIANT, or no image if missing or null."""
    df = computed_once(df, {
        "has_row": f"NOT {V.is_absent('_current')}",
        "_row_elements": f"IF(_row_text IS NOT NULL, {V.as_array(V.parse_whole('_row_text'), 'variant')}, NULL)",
    })
    dropped = ("_row_elements", "_row_text", "_current")
    return df.selectExpr(
        *[c for c in df.columns if c not in dropped],
        "CASE WHEN has_row AND _row_text IS NULL THEN _current"
        f" ELSE {V.whole_value('_row_elements')} END AS row",
    )


# First rule a live message breaks, or NULL. Every rule is about one part of the envelope.
_LIVE_REJECT_REASON = f"""CASE
    WHEN _env IS NULL THEN 'bad message'
    WHEN {V.is_bad_text('_env.operation', '_operation')} THEN 'bad operation'
    WHEN _data IS NULL THEN
        IF(try_variant_get(_parsed, '$[0].data', 'variant') IS NULL, 'no data', 'bad data')
    WHEN _data.eventsource IS NULL AND {_present('eventsource')} THEN 'bad eventsource'
    WHEN {V.is_bad_text('_data.eventsource.tbl', '_table')} THEN 'bad table'
    WHEN _has_key AND _key IS NULL THEN 'bad primary key'
    WHEN {V.is_bad_text('_key.value', '_key_text')} THEN 'bad primary key'
    WHEN _data.eventrow IS NULL AND {_present('eventrow')} THEN 'bad eventrow'
    WHEN has_row AND row IS NULL THEN 'bad row image'
    WHEN _data.eventsource IS NOT NULL AND _data.eventsource.transaction IS NULL
        AND {_present('eventsource.transaction')} THEN 'bad transaction'
    END"""


def commit_lsn(places: Sequence[str]) -> str:
    """First non-empty string among the places, cut to the ledger's column size."""
    found = ", ".join(f"nullif({V.text(p)}, '')" for p in places)
    return f"left(coalesce({found}, '{S.NO_LSN}'), {S.LSN_LENGTH})"


def decode_live(df: DataFrame) -> DataFrame:
    """Decode live envelopes.

    Adds operation, schema_name, table, key_id (first key part, NULL if absent or 0),
    commit_lsn, row (VARIANT), has_row and reject_reason to the message columns. Schema and LSN are read
    outside the barrier: plans that do not use them leave them out, and no rule filters on the LSN.
    """
    require_settings(df.sparkSession)
    decoded = computed_once(_open_live(df), {
        "operation": f"coalesce(_operation, '{S.UNKNOWN_OPERATION}')",
        "table": "coalesce(_table, '')",
        "key_id": "nullif(try_cast(_key_text AS BIGINT), 0)",
        "row": "row",
        "has_row": "has_row",
        "reject_reason": _LIVE_REJECT_REASON,
        "_source": "_data.eventsource",
    }, df.columns)
    return decoded.selectExpr(
        *df.columns, "operation", f"coalesce({V.text('_source.schema')}, '') AS schema_name", "table", "key_id",
        f"{commit_lsn(_LSN_PLACES)} AS commit_lsn", "row", "has_row", "reject_reason",
    )


def decode_documented(df: DataFrame, key_columns: dict[str, str] | None = None) -> DataFrame:
    """Decode the other envelope (long operation names, primaryKey object, before / after).

    Same output as :func:`decode_live`, plus ``before`` and ``transaction_id``.
    ``key_columns`` maps a table to the member of ``primaryKey`` holding its key. A delete
    needs no ``after`` image. All header members are required.
    """
    require_settings(df.sparkSession)
    key_columns = key_columns or {s.name: s.key for s in (S.ORDERS, S.ORDER_LINES)}
    opened = computed_once(unwrap_json(df, _DOCUMENTED_DATA), {
        "_pk": V.fields("_data.primaryKey", list(key_columns.values())),
        "_op": V.text("_data.operation"),
        "_table": V.text("_data.table"),
        "_schema": V.text("_data.schema"),
    })
    codes = " ".join(f"WHEN '{long}' THEN '{short}'" for long, short in S.LONG_OPERATIONS.items())
    keys = " ".join(
        f"WHEN '{table}' THEN {V.integer(f'_pk.`{column}`', 'BIGINT')}" for table, column in key_columns.items()
    )
    no_after = V.is_absent("_data.after")
    return computed_once(opened, {
        "operation": f"CASE _op {codes} ELSE coalesce(_op, '{S.UNKNOWN_OPERATION}') END",
        "schema_name": "coalesce(_schema, '')",
        "table": "coalesce(_table, '')",
        "key_id": f"nullif(CASE _table {keys} END, 0)",
        "commit_lsn": commit_lsn(["_data.commitLsn"]),
        "row": f"IF({no_after}, NULL, _data.after)",
        "has_row": f"NOT {no_after}",
        "reject_reason": f"""CASE
            WHEN _env IS NULL THEN 'bad message'
            WHEN _data IS NULL THEN 'bad data'
            WHEN _op IS NULL THEN 'bad operation'
            WHEN _schema IS NULL OR _table IS NULL THEN 'bad table'
            WHEN _pk IS NULL THEN 'bad primary key'
            WHEN _op IN ('INSERT', 'UPDATE') AND {no_after} THEN 'no row image'
            END""",
        "before": f"IF({V.is_absent('_data.before')}, NULL, _data.before)",
        "transaction_id": V.text("_data.transactionId"),
    }, df.columns)


def _read(column: S.Column) -> str:
    """First step of typing a cell: all that looks at the JSON value."""
    cell = f"_cells.`{column.name}`"
    if column.kind in ("int", "bigint"):
        return V.integer(cell, column.kind)
    if column.kind == "decimal":
        return V.number_text(cell)
    text = f"CAST({cell} AS STRING)"
    return f"btrim({text})" if column.kind == "date" else text


def _convert(column: S.Column) -> str:
    """Second step: what was read, as the column's type (decimals still wide)."""
    read = f"`_{column.name}`"
    return V.day(read) if column.kind == "date" else V.wide_decimal(read, column.scale)


def _value(column: S.Column) -> str:
    value = f"`_{column.name}`"
    return V.parsed_decimal(value) if column.kind == "decimal" else value


def _typed(column: S.Column) -> str:
    """The value as the column's type, NULL if it does not fit."""
    short = column.kind == "decimal" and column.size - column.scale <= V.DECIMAL_DIGITS
    # What fits a column of so few digits is within the limit of parsed decimals too.
    return f"try_cast({f'`_{column.name}`' if short else _value(column)} AS {column.data_type.simpleString()})"


def _violation(column: S.Column) -> str:
    """The typed value does not go into the target column (or is NULL where required)."""
    rules = [] if column.nullable else [f"{_value(column)} IS NULL"]
    if column.kind == "text" and column.size:
        # Sizes count UTF-16 units; UTF-8 never has fewer bytes, so most values need no encoding.
        value = _value(column)
        units = f"octet_length(encode({value}, 'UTF-16BE')) > {2 * column.size}"
        rules.append(f"coalesce(octet_length({value}) > {column.size} AND {units}, false)")
    elif column.kind == "decimal":
        rules.append(f"{_value(column)} IS NOT NULL")
        return f"{_typed(column)} IS NULL AND ({' OR '.join(rules)})"
    return " OR ".join(rules) or "false"


# Columns read per step: keeps each generated method small enough to be compiled to
# machine code (8000 bytes of bytecode).
_COLUMNS_PER_STEP = 5


def typed_rows(decoded: DataFrame, spec: S.TableSpec, into: str | None = None) -> DataFrame:
    """Type the row images of one table.

    Adds ``into`` (default: the table's name), a struct of the target's columns, and ``key``.
    Rows of other tables get NULL for both. Where the key or a value cannot go into the
    target, ``reject_reason`` says so; absent members become NULL, extra members are ignored.
    """
    kept = [c for c in decoded.columns if c not in ("key", "reject_reason")]
    previous_key = "key" if "key" in decoded.columns else "CAST(NULL AS BIGINT)"
    mine = f"(table = '{spec.name}')"
    texts = [c.name for c in spec.columns if c.kind in ("text", "date")]
    cells = V.fields("row", [spec.key, *spec.column_names], texts)
    df = computed_once(decoded, {
        "_cells": f"IF({mine}, {cells}, NULL)",
        "key": previous_key,
    })

    # The key: first key part of the envelope, else the row's key column, else 0.
    own_key = f"_cells.`{spec.key}`"
    in_envelope = f"try_cast(key_id AS {spec.key_kind})"
    df = computed_once(df, {
        "_key_in_row": f"IF({in_envelope} IS NULL, {V.integer(own_key, spec.key_kind)}, NULL)"
    })
    bad_key = f"{in_envelope} IS NULL AND _key_in_row IS NULL AND {V.is_bad_text(own_key)}"
    df = computed_once(df, {
        "key": f"IF({mine}, CAST(coalesce({in_envelope}, _key_in_row, 0) AS BIGINT), key)",
        "reject_reason": f"""CASE WHEN reject_reason IS NOT NULL THEN reject_reason
            WHEN {mine} AND has_row AND _cells IS NULL THEN 'row image is no object'
            WHEN {mine} AND {bad_key} THEN 'bad key column' END""",
    }, [*kept, "_cells"])

    # The other columns: read a few at a time, then convert those that need it.
    for i in range(0, len(spec.columns), _COLUMNS_PER_STEP):
        part = spec.columns[i : i + _COLUMNS_PER_STEP]
        df = computed_once(df, {f"_{c.name}": _read(c) for c in part})
    convert = {f"_{c.name}": _convert(c) for c in spec.columns if c.kind in ("decimal", "date")}
    if convert:
        df = computed_once(df, convert, [c for c in df.columns if c not in convert and c != "_cells"])
    changes_row = f"operation IN ('{S.INSERT}', '{S.UPDATE}')"
    violation = " OR ".join(f"({_violation(c)})" for c in spec.columns) or "false"
    image = ", ".join(f"{_typed(c)} AS `{c.name}`" for c in spec.columns)
    return computed_once(df, {
        "key": "key",
        into or spec.name: f"IF({mine}, struct({image}), NULL)",
        "reject_reason": f"""CASE WHEN reject_reason IS NOT NULL THEN reject_reason
            WHEN {mine} AND {changes_row} AND ({violation}) THEN 'value does not fit the table' END""",
    }, kept)


def flat_events(typed: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Typed events of one table with its columns laid flat."""
    return typed.filter(F.col("table") == spec.name).select(
        *S.EVENT_ID, "arrival", "operation", "commit_lsn",
        F.col("key").cast(spec.key_kind).alias(spec.key), f"{spec.name}.*",
    )


def to_table(decoded: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Accepted events of one table, flat: event columns, the key and the typed columns."""
    mine = decoded.filter(F.col("table") == spec.name)
    return flat_events(accepted(typed_rows(mine, spec)), spec)


def to_orders(decoded: DataFrame) -> DataFrame:
    return to_table(decoded, S.ORDERS)


def to_order_lines(decoded: DataFrame) -> DataFrame:
    return to_table(decoded, S.ORDER_LINES)


def typed_events(decoded: DataFrame, specs: Sequence[S.TableSpec]) -> DataFrame:
    """Decoded events of the subscribed tables, all in one DataFrame.

    One nullable struct column per table holds that table's typed row, so events of all
    tables can share one pass of deduplication. Rejects keep their text in ``value`` and
    are part of the result unless they are known to belong to another table.
    """
    names = [s.name for s in specs]
    unknown = F.col("reject_reason").isNotNull() & (F.col("table") == "")
    df = decoded.filter(F.col("table").isin(names) | unknown)
    for spec in specs:
        df = typed_rows(df, spec)
    return df.selectExpr(
        *S.EVENT_ID, "arrival", "operation", "schema_name", "table", "key", "commit_lsn", *names,
        "reject_reason", "IF(reject_reason IS NOT NULL, value, NULL) AS value",
    )


def header_events(decoded: DataFrame, specs: Sequence[S.TableSpec]) -> DataFrame:
    """Accepted events by their envelope and key alone, for views that need no cell.

    Row images are not typed: an event whose cells do not fit its table is among them.
    """
    names = [s.name for s in specs]
    events = decoded.filter(F.col("table").isin(names) & F.col("reject_reason").isNull())
    keys = " ".join(
        f"WHEN '{s.name}' THEN coalesce(try_cast(key_id AS {s.key_kind}), {V.integer(f'_cells.`{s.key}`', s.key_kind)}, 0)"
        for s in specs
    )
    cells = V.fields("row", list(dict.fromkeys(s.key for s in specs)))
    events = computed_once(events, {"_cells": f"IF(key_id IS NULL, {cells}, NULL)"})
    return events.selectExpr(
        *S.EVENT_ID, "arrival", "operation", "schema_name", "table",
        f"CAST(CASE table {keys} END AS BIGINT) AS key", "commit_lsn",
    )


def accepted(events: DataFrame) -> DataFrame:
    return events.filter(F.col("reject_reason").isNull())


def rejects(events: DataFrame) -> DataFrame:
    """Messages that cannot be applied, with their reason and full text."""
    return events.filter(F.col("reject_reason").isNotNull()).select(
        *S.EVENT_ID, "reject_reason", "value"
    )


def feed_view(df: DataFrame) -> DataFrame:
    """One line per readable message of *any* table, for people to look at."""
    keep = [*S.EVENT_ID, "arrival"]
    names = ["CustomerFirstName", "CustomerLastName"]
    opened = computed_once(
        _open_live(df.select(*keep, "value")), {"_names": V.fields("row", names)}
    )
    # Transactions are not looked at here, so a bad one does not hide the message.
    unreadable = " OR ".join([
        f"coalesce({_LIVE_REJECT_REASON}, 'bad transaction') <> 'bad transaction'",
        "(has_row AND _names IS NULL)",
        *[
            f"coalesce({V.is_bad_text(m)}, false)"
            for m in ("_data.eventsource.db", "_data.eventsource.schema", *[f"_names.{n}" for n in names])
        ],
    ])
    part = {m: f"coalesce({V.text(f'_data.eventsource.{m}')}, '')" for m in ("db", "schema", "tbl")}
    first, last = (f"coalesce({V.text(f'_names.{n}')}, '')" for n in names)
    lines = computed_once(opened, {
        "operation": f"coalesce(_operation, '{S.UNKNOWN_OPERATION}')",
        "database": part["db"],
        "schema": part["schema"],
        "table": part["tbl"],
        "table_full_name": f"concat({part['schema']}, '.', {part['tbl']})",
        "primary_key": "coalesce(concat('ID: ', nullif(_key_text, '')), '')",
        "customer_name": f"btrim(concat({first}, ' ', {last}))",
        "_readable": f"NOT ({unreadable})",
    }, keep)
    return lines.filter("_readable").drop("_readable").withColumn("received_at", F.current_timestamp())
