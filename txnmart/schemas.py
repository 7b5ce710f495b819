"""Canonical schemas. Nothing in the load path is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine source columns, in file order (the reader maps by position).
SOURCE_FIELDS = [
    "transaction_id",
    "order_timestamp",
    "channel",
    "product_category",
    "quantity",
    "amount",
    "payment_method",
    "customer_id",
    "status",
]

SOURCE = T.StructType([T.StructField(name, T.StringType()) for name in SOURCE_FIELDS])

RAW = T.StructType(
    [T.StructField("raw_row_id", T.LongType(), False)]
    + SOURCE.fields
    + [T.StructField("loaded_at", T.TimestampType(), False)]
)

QUARANTINE = T.StructType(
    [T.StructField("quarantine_id", T.LongType(), False), T.StructField("raw_row_id", T.LongType())]
    + SOURCE.fields
    + [
        T.StructField("invalid_reason", T.StringType()),
        T.StructField("quarantined_at", T.TimestampType(), False),
    ]
)

DIM_DATE = T.StructType(
    [
        T.StructField("date_key", T.IntegerType(), False),
        T.StructField("date_actual", T.DateType(), False),
        T.StructField("week_start", T.DateType(), False),
        T.StructField("month_start", T.DateType(), False),
        T.StructField("year_num", T.IntegerType(), False),
        T.StructField("quarter_num", T.IntegerType(), False),
        T.StructField("month_num", T.IntegerType(), False),
        T.StructField("week_num", T.IntegerType(), False),
        T.StructField("day_of_week_num", T.IntegerType(), False),
        T.StructField("day_name", T.StringType(), False),
        T.StructField("is_weekend", T.BooleanType(), False),
    ]
)


def dim_schema(entity: str) -> T.StructType:
    """Schema of a name dimension, e.g. ``dim_schema("channel")``."""
    return T.StructType(
        [
            T.StructField(f"{entity}_key", T.LongType(), False),
            T.StructField(f"{entity}_name", T.StringType(), False),
        ]
    )


MONEY = T.DecimalType(14, 2)

FACT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("order_timestamp", T.TimestampNTZType(), False),
        T.StructField("date_key", T.IntegerType(), False),
        T.StructField("channel_key", T.LongType(), False),
        T.StructField("product_category_key", T.LongType(), False),
        T.StructField("payment_method_key", T.LongType(), False),
        T.StructField("status_key", T.LongType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("amount", MONEY, False),
        T.StructField("is_value_eligible", T.BooleanType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
    ]
)

# Counts of raw rows by what becomes of them; one row.
ACCOUNTING = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("raw_rows", "exact_duplicate_rows", "quarantined_rows", "rows_without_status", "valid_rows")
    ]
)
