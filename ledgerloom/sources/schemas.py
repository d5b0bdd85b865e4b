"""Declared schemas of the five raw tables: header in the file, type."""

from __future__ import annotations

from pyspark.sql import types as T

# Dates may arrive as text; the staging and cleaning plans parse them.
RAW_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "orders": [
        ("Order ID", "string"),
        ("Order Date", "string"),
        ("Ship Date", "string"),
        ("Customer ID", "string"),
        ("Product ID", "string"),
        ("Country", "string"),
        ("Channel", "string"),
        ("Quantity", "int"),
        ("Unit Price", "decimal(12,2)"),
        ("Discount", "decimal(6,4)"),
        ("Shipping Cost", "decimal(12,2)"),
        ("Payment Method", "string"),
    ],
    "products": [
        ("Product ID", "string"),
        ("Product Name", "string"),
        ("Category", "string"),
        ("Sub-Category", "string"),
        ("Brand", "string"),
        ("Unit Cost", "decimal(14,4)"),
        ("List Price", "decimal(12,2)"),
        ("Launch Date", "string"),
    ],
    "customers": [
        ("Customer ID", "string"),
        ("Customer Name", "string"),
        ("Segment", "string"),
        ("Country", "string"),
        ("City", "string"),
        ("Acquisition Date", "string"),
        ("Acquisition Channel", "string"),
    ],
    "returns": [("Order ID", "string"), ("Return Date", "string"), ("Reason", "string")],
    "sales_targets": [("Country", "string"), ("Year-Month", "string"), ("Target Revenue", "decimal(14,2)")],
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in RAW_COLUMNS[table]))


CORRUPT = "_corrupt_record"
DATES = ("Order Date", "Ship Date", "Launch Date", "Acquisition Date", "Return Date")


def typed_schema(table: str, corrupt: bool = False) -> T.StructType:
    """The declared schema with dates as dates; ``corrupt`` adds the column that keeps records that do not fit."""
    fields = [f"`{name}` {'date' if name in DATES else kind}" for name, kind in RAW_COLUMNS[table]]
    return T.StructType.fromDDL(", ".join([*fields, f"{CORRUPT} string"] if corrupt else fields))
