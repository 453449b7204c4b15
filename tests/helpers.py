"""Building small feeds and reading results."""

import json

from sluice import schemas as S


def message(op, key, row=None, table="Orders", lsn=None, key_column=None, data_text=False, row_text=False, **extra):
    key_column = key_column or ("OrderID" if table == "Orders" else "OrderLineID")
    current = json.dumps(row) if (row_text and row is not None) else row
    data = {
        "eventsource": {
            "db": "Shop", "schema": "dbo", "tbl": table,
            "pkkey": [{"columnname": key_column, "value": str(key)}],
            "transaction": {"committime": lsn} if lsn else {},
        },
        "eventrow": {"current": current, "old": None},
    }
    return json.dumps({"operation": op, "data": json.dumps(data) if data_text else data, **extra})


def feed(spark, rows):
    """rows: (partition, sequence, value); arrival is the position in the list."""
    return spark.createDataFrame(
        [(p, s, n, v) for n, (p, s, v) in enumerate(rows)], S.MESSAGE_SCHEMA
    )


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
