"""Typed view of raw rows: cleaned values beside the raw texts they came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.functions import parse, text

# Raw texts that identify an exact copy. The customer id takes part in trimmed form.
ROW_TEXTS = [
    "transaction_id_raw",
    "order_timestamp",
    "channel",
    "product_category",
    "quantity",
    "amount",
    "payment_method",
    "customer_id",
    "status",
]


def typed(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Clean and parse every field; narrow, so it runs inside the scan stage.

    The raw ``customer_id`` is not carried, only its trimmed form. ``keep`` names
    further input columns to pass through.
    """
    c = F.col
    return raw.select(
        "raw_row_id",
        text.blank_to_null(c("transaction_id")).alias("transaction_id"),
        parse.parse_order_ts(c("order_timestamp")).alias("order_ts"),
        text.normalize_channel(c("channel")).alias("channel_clean"),
        text.title_clean(c("product_category")).alias("product_category_clean"),
        parse.parse_int(c("quantity")).alias("quantity_int"),
        parse.parse_amount(c("amount")).alias("amount_num"),
        text.blank_to_null(c("payment_method")).alias("payment_method_clean"),
        text.blank_to_null(c("customer_id")).alias("customer_id"),
        text.normalize_status(c("status")).alias("status_clean"),
        c("transaction_id").alias("transaction_id_raw"),
        "order_timestamp",
        "channel",
        "product_category",
        "quantity",
        "amount",
        "payment_method",
        "status",
        *keep,
    )
