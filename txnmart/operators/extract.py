"""Wide extract for dashboards and its filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.operators.joins import lookup, measure
from txnmart.plans.mart import Mart

DATE_COLUMNS = ["date_actual", "week_start", "year_num", "quarter_num", "month_num", "week_num",
                "day_of_week_num", "day_name", "is_weekend"]


def dashboard_extract(mart: Mart) -> DataFrame:
    """One row per fact row, with names instead of keys and all date attributes."""
    days = mart.dim_date.drop("month_start")
    rows = mart.fact.join(F.broadcast(days), "date_key")  # at most one row per calendar day
    named = {e: getattr(mart, f"dim_{e}") for e in ("channel", "product_category", "payment_method", "status")}
    sizes = measure(named)
    for entity, dim in named.items():
        rows = lookup(rows, dim, {f"{entity}_key": f"{entity}_key"}, sizes[entity])
    return rows.select(
        "transaction_id",
        "order_timestamp",
        *DATE_COLUMNS,
        "month_start",
        "channel_name",
        "product_category_name",
        "payment_method_name",
        "status_name",
        "customer_id",
        "quantity",
        "amount",
        "is_value_eligible",
    )


def filtered(
    mart: Mart,
    start: str | None = None,
    end: str | None = None,
    channels: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    statuses: Sequence[str] | None = None,
    customers: Sequence[str] | None = None,
    transactions: Sequence[str] | None = None,
) -> DataFrame:
    """`dashboard_extract` of chosen rows, with the filters put on the stored columns of the fact.

    Names become keys first, at most one for each chosen name, so that the scan skips months by date, pages
    of sorted files by key, and row groups by the Bloom filters of customer and transaction ids.
    """
    fact, month = mart.fact, F.col("month_start")
    if start is not None:
        first = F.lit(start).cast("date")
        fact = fact.filter((F.col("date_key") >= int(start.replace("-", ""))) & (month >= F.trunc(first, "month")))
    if end is not None:
        fact = fact.filter((F.col("date_key") <= int(end.replace("-", ""))) & (month <= F.lit(end).cast("date")))
    for entity, chosen in [("channel", channels), ("product_category", categories), ("status", statuses)]:
        if chosen is not None:
            named = getattr(mart, f"dim_{entity}").filter(F.col(f"{entity}_name").isin(list(chosen)))
            fact = fact.filter(F.col(f"{entity}_key").isin([row[0] for row in named.select(f"{entity}_key").collect()]))
    for column, chosen in [("customer_id", customers), ("transaction_id", transactions)]:
        if chosen is not None:
            fact = fact.filter(F.col(column).isin(list(chosen)))
    return dashboard_extract(replace(mart, fact=fact))


def apply_filters(
    extract: DataFrame,
    start: str | None = None,
    end: str | None = None,
    channels: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Dashboard filters; a filter left out selects everything. Dates are inclusive.

    A date range also bounds ``month_start``, the partition column, so months outside
    it are not read.
    """
    day, month = F.col("date_actual"), F.col("month_start")
    if start is not None:
        first = F.lit(start).cast("date")
        extract = extract.filter((day >= first) & (month >= F.trunc(first, "month")))
    if end is not None:
        last = F.lit(end).cast("date")
        extract = extract.filter((day <= last) & (month <= last))
    for column, chosen in [
        ("channel_name", channels),
        ("product_category_name", categories),
        ("status_name", statuses),
    ]:
        if chosen is not None:
            extract = extract.filter(F.col(column).isin(list(chosen)))
    return extract
