"""Names and types of the tables a change feed is applied to.

A target table is described by a :class:`TableSpec`; everything downstream (typed
decoding, constraint checks, merging, the state layout) is derived from it, so a further
table needs a further spec and no further code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    """One typed column of a target: ``kind`` is text, int, bigint, decimal or date."""

    name: str
    kind: str
    size: int = 0
    scale: int = 0
    nullable: bool = True

    @property
    def data_type(self) -> T.DataType:
        if self.kind == "int":
            return T.IntegerType()
        if self.kind == "bigint":
            return T.LongType()
        if self.kind == "date":
            return T.DateType()
        if self.kind == "decimal":
            return T.DecimalType(self.size, self.scale)
        return T.StringType()


def parse_column(text: str) -> Column:
    """``name`` (text of any length) or ``name type``, as a configuration writes it."""
    name, _, declared = text.strip().partition(" ")
    kind, _, sizes = declared.strip().lower().rstrip(")").partition("(")
    numbers = [int(n) for n in sizes.split(",") if n.strip()]
    kind = {"": "text", "varchar": "text", "nvarchar": "text", "string": "text", "integer": "int"}.get(kind.strip(), kind.strip())
    if kind not in ("text", "int", "bigint", "decimal", "date"):
        raise ValueError(f"unknown column type in {text!r}")
    if kind == "decimal" and not numbers:
        numbers = [18, 2]
    return Column(name, kind, *numbers[:2])


@dataclass(frozen=True)
class TableSpec:
    """A target table: its name on the feed, key column (int or bigint) and other columns."""

    name: str
    key: str
    columns: tuple[Column, ...] = field(default=())
    schema_name: str = "dbo"
    key_kind: str = "int"

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(self.key, Column(self.key, self.key_kind).data_type)]
        fields += [T.StructField(c.name, c.data_type) for c in self.columns]
        return T.StructType(fields)


# Target columns, sizes and types.
ORDERS = TableSpec(
    "Orders",
    "OrderID",
    (
        Column("CustomerFirstName", "text", 50),
        Column("CustomerLastName", "text", 50),
        Column("Company", "text", 100),
        Column("SalesDate", "date"),
        Column("EstimatedShipDate", "date"),
        Column("ShippingID", "int"),
        Column("ShippingLocation", "text", 100),
        Column("Product", "text", 100),
        Column("Quantity", "int"),
        Column("Price", "decimal", 10, 2),
    ),
)
ORDER_LINES = TableSpec(
    "OrderLines",
    "OrderLineID",
    (
        Column("OrderID", "int", nullable=False),
        Column("ProductID", "int", nullable=False),
        Column("Quantity", "int", nullable=False),
        Column("UnitPrice", "decimal", 18, 2, nullable=False),
    ),
)

# Operation codes of the live envelope, and their long names in the other one.
INSERT, UPDATE, DELETE, UNKNOWN_OPERATION = "INS", "UPD", "DEL", "?"
LONG_OPERATIONS = {"INSERT": INSERT, "UPDATE": UPDATE, "DELETE": DELETE}
NO_LSN, LSN_LENGTH = "n/a", 64

MESSAGE_SCHEMA = T.StructType([
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("sequence_number", T.LongType()),
    T.StructField("arrival", T.LongType()),
    T.StructField("value", T.StringType()),
])
LEDGER_SCHEMA = T.StructType([
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("sequence_number", T.LongType()),
    T.StructField("commit_lsn", T.StringType()),
    T.StructField("arrival", T.LongType()),
    T.StructField("processed_at", T.TimestampType()),
])
OFFSETS_SCHEMA = T.StructType([
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("last_sequence_number", T.LongType()),
    T.StructField("last_commit_lsn", T.StringType()),
    T.StructField("last_arrival", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("sequence_number", T.LongType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("rejected_at", T.TimestampType()),
])
EVENT_ID = ["partition_id", "sequence_number"]
