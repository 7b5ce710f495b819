"""The fact table: one row per cleaned transaction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.functions.calendar import date_key, month_start
from txnmart.operators.dedup import dedup_latest
from txnmart.operators.joins import lookup, measure
from txnmart.operators.quality import VALUE_STATUS, valid
from txnmart.schemas import FACT
from txnmart.sources.raw import instant

CLEAN_COLUMNS = [
    "raw_row_id",
    "transaction_id",
    "order_ts",
    "channel_clean",
    "product_category_clean",
    "payment_method_clean",
    "status_clean",
    "customer_id",
    "quantity_int",
    "amount_num",
]


@dataclass(frozen=True)
class Dims:
    date: DataFrame
    channel: DataFrame
    product_category: DataFrame
    payment_method: DataFrame
    status: DataFrame


def clean_latest(df: DataFrame, as_of: str | None) -> DataFrame:
    """Valid typed rows, the latest version per transaction id.

    Exact copies need no separate pass here: a survivor's content is the same
    whichever copy is kept.
    """
    return dedup_latest(valid(df, as_of).select(*CLEAN_COLUMNS), counted=df.filter(F.col("transaction_id").isNotNull()))


def build_fact(clean: DataFrame, dims: Dims, loaded_at: str | None = None) -> DataFrame:
    """Replace names by surrogate keys; a narrow stage while the dims fit a broadcast."""
    return dated(keyed(clean, dims), loaded_at)


def keyed(clean: DataFrame, dims: Dims) -> DataFrame:
    """The columns that the others of the fact derive from, so all that a shuffle of it has to move."""
    rows = clean
    named = {entity: getattr(dims, entity) for entity in ("channel", "product_category", "payment_method", "status")}
    sizes = measure(named)
    for entity, dim in named.items():
        rows = lookup(rows, dim, {f"{entity}_clean": f"{entity}_name"}, sizes[entity])
    return rows.select(
        "transaction_id",
        F.col("order_ts").alias("order_timestamp"),
        "channel_key",
        "product_category_key",
        "payment_method_key",
        "status_key",
        "customer_id",
        F.col("quantity_int").alias("quantity"),
        F.col("amount_num").alias("amount"),
        (F.col("status_clean") == VALUE_STATUS).alias("is_value_eligible"),
    )


def dated(rows: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """`keyed` rows with the remaining columns of the fact; others stay."""
    columns = {"date_key": date_key(F.col("order_timestamp")), "loaded_at": instant(loaded_at)}
    names = FACT.fieldNames()
    return rows.withColumns(columns).select(*names, *[name for name in rows.columns if name not in names])


def with_month(fact: DataFrame) -> DataFrame:
    """Add the partition column of the stored fact table."""
    return fact.withColumn("month_start", month_start(F.col("order_timestamp")))
