"""Dimensions. Their scopes differ on purpose:

* dates: the span of every in-range timestamp, invalid rows included;
* channels: cleaned labels of modeled rows only;
* categories and payment methods: cleaned labels of all raw rows;
* statuses: constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmart.functions import parse, text
from txnmart.functions.calendar import date_attributes
from txnmart.operators.numbering import number_names, one_dim
from txnmart.operators.quality import STATUSES, in_range, in_range_text
from txnmart.session import written

# Entities whose names come from the data.
NAMED = ["channel", "product_category", "payment_method"]


def label_spans(raw: DataFrame, as_of: str | None) -> DataFrame:
    """One scan of raw rows for three dimensions: label pairs with their in-range date span.

    Grouping on the raw labels combines within each task and leaves few labels to clean.
    """
    order_timestamp = F.col("order_timestamp")
    day = F.when(in_range_text(order_timestamp, as_of), parse.parse_order_ts(order_timestamp).cast("date"))
    spans = (
        raw.select("product_category", "payment_method", day.alias("day"))
        .groupBy("product_category", "payment_method")
        .agg(F.min("day").alias("min_date"), F.max("day").alias("max_date"))
    )
    return spans.select(
        text.title_clean(F.col("product_category")).alias("product_category_clean"),
        text.blank_to_null(F.col("payment_method")).alias("payment_method_clean"),
        "min_date",
        "max_date",
    )


def date_span(df: DataFrame, as_of: str | None) -> DataFrame:
    """First and last in-range day of a typed frame."""
    day = F.when(in_range(F.col("order_ts"), as_of), F.col("order_ts").cast("date"))
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def dim_date(spans: DataFrame) -> DataFrame:
    """Every day from the earliest ``min_date`` to the latest ``max_date``; empty for no dates."""
    span = spans.agg(F.min("min_date").alias("first"), F.max("max_date").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.select(*date_attributes(F.col("day")))


def channel_names(clean: DataFrame) -> DataFrame:
    """``clean`` holds valid rows after business-key deduplication."""
    return _names(clean, "channel")


def product_category_names(df: DataFrame) -> DataFrame:
    return _names(df, "product_category")


def payment_method_names(df: DataFrame) -> DataFrame:
    return _names(df, "payment_method")


def _names(df: DataFrame, entity: str) -> DataFrame:
    """Distinct cleaned labels as (entity, name)."""
    label = F.col(f"{entity}_clean")
    return df.filter(label.isNotNull()).select(F.lit(entity).alias("entity"), label.alias("name")).distinct()


def name_dims(names: DataFrame) -> dict[str, DataFrame]:
    """Dimensions of every named entity in a union of the frames above, numbered in one pass."""
    numbered = written(number_names(names))
    return {entity: one_dim(numbered, entity) for entity in NAMED}


def dim_status(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(key).cast("long").alias("status_key"), F.lit(name).alias("status_name"))
        for key, name in enumerate(STATUSES, start=1)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def merge_dim(existing: DataFrame, names: DataFrame, entity: str) -> DataFrame:
    """Add names not yet in ``existing``, with keys after its highest; known names keep their keys."""
    name, key = f"{entity}_name", f"{entity}_key"
    new = names.select(name).filter(F.col(name).isNotNull()).distinct().join(existing, name, "left_anti")
    numbered = number_names(new.select(F.lit(entity).alias("entity"), F.col(name).alias("name")))
    highest = existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    added = one_dim(numbered, entity).select((F.col(key) + highest).alias(key), name)
    return existing.select(key, name).unionByName(added)
