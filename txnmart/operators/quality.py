"""Data-quality rules, quarantine, integrity checks and row accounting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.functions.parse import parse_float
from txnmart.operators.cleaning import typed
from txnmart.operators.dedup import dedup_exact, text_digest
from txnmart.sources.raw import instant

# The accepted statuses, the value-bearing one, and the earliest order time.
STATUSES = ["completed", "refunded", "failed"]
VALUE_STATUS = "completed"
EARLIEST = "2020-01-01 00:00:00"
SEPARATOR = "; "


def latest_allowed(as_of: str | None) -> Column:
    """One day past ``as_of`` (or past now)."""
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return now + F.expr("INTERVAL 1 DAY")


def in_range(ts: Column, as_of: str | None) -> Column:
    return ts.between(F.lit(EARLIEST).cast("timestamp_ntz"), latest_allowed(as_of))


def in_range_text(c: Column, as_of: str | None) -> Column:
    """`in_range` on a timestamp's text: the accepted form sorts in time order.

    Only meaningful for text that also parses.
    """
    latest = F.date_format(latest_allowed(as_of), "yyyy-MM-dd HH:mm:ss")
    return F.trim(c).between(F.lit(EARLIEST), latest)


def rules(as_of: str | None, strict_status: bool = False) -> list[tuple[str, Column]]:
    """Ordered (reason, failing condition) pairs over a typed frame.

    A condition that evaluates to NULL does not fire. So a missing status gives no
    reason unless ``strict_status`` adds one.
    """
    c = F.col
    checks = [
        ("missing transaction_id", c("transaction_id").isNull()),
        ("missing or malformed timestamp", c("order_ts").isNull()),
        ("timestamp outside expected range", ~in_range(c("order_ts"), as_of)),
        ("missing channel", c("channel_clean").isNull()),
        ("missing product_category", c("product_category_clean").isNull()),
        ("quantity not numeric", c("quantity_int").isNull()),
        ("quantity is zero or negative", c("quantity_int") <= 0),
        ("amount missing or not numeric", c("amount_num").isNull()),
        ("amount is zero or negative", c("amount_num") <= 0),
        ("missing payment_method", c("payment_method_clean").isNull()),
        ("missing customer_id", c("customer_id").isNull()),
        ("unknown status", ~c("status_clean").isin(STATUSES)),
    ]
    if strict_status:
        checks.append(("missing status", c("status_clean").isNull()))
    return checks


def invalid_reason(checks: list[tuple[str, Column]]) -> Column:
    """Reasons of all failing rules joined by ``'; '``; the empty string means valid."""
    return F.concat_ws(SEPARATOR, *[F.when(fails, F.lit(reason)) for reason, fails in checks])


def validated(df: DataFrame, as_of: str | None, strict_status: bool = False) -> DataFrame:
    """Typed rows with their ``invalid_reason``."""
    return df.withColumn("invalid_reason", invalid_reason(rules(as_of, strict_status)))


def acceptable(as_of: str | None, strict_status: bool = False) -> Column:
    """True where no rule fires, else false or NULL; same outcome as an empty reason list.

    The optimizer pushes this filter below the cleaning projection and so repeats every
    cleaned expression it refers to. It therefore tests the raw text where that decides
    the matter: a label is missing exactly if its text is blank, and the accepted
    timestamp form sorts in time order.
    """
    c = F.col
    status_known = F.lower(F.trim("status")).isin(STATUSES)
    conditions = [
        in_range_text(c("order_timestamp"), as_of),
        F.trim("transaction_id_raw") != "",
        F.trim("channel") != "",
        F.trim("product_category") != "",
        F.trim("payment_method") != "",
        c("customer_id").isNotNull(),
        status_known if strict_status else (status_known | F.coalesce(F.trim("status") == "", F.lit(True))),
        c("quantity_int") > 0,
        c("amount_num") > 0,
        c("order_ts").isNotNull(),
    ]
    return reduce(and_, conditions)


def valid(df: DataFrame, as_of: str | None) -> DataFrame:
    """Typed rows that may enter the fact table: no rule fires and the status is present."""
    return df.filter(acceptable(as_of, strict_status=True))


def quarantine(
    df: DataFrame, as_of: str | None, strict_status: bool = False, quarantined_at: str | None = None
) -> DataFrame:
    """Invalid typed rows as raw texts plus the reason, one per distinct source row.

    Validity depends only on the row texts, so copies share it. Filtering first means
    the deduplication shuffles only the invalid rows. ``quarantine_id`` equals the
    surviving ``raw_row_id``: unique, and the same on every rebuild or retry.
    """
    bad = df.filter(~F.coalesce(acceptable(as_of, strict_status), F.lit(False)))
    bad = validated(bad, as_of, strict_status)
    return dedup_exact(bad, carry=["invalid_reason"]).select(
        F.col("raw_row_id").alias("quarantine_id"),
        "raw_row_id",
        F.col("transaction_id_raw").alias("transaction_id"),
        "order_timestamp",
        "channel",
        "product_category",
        "quantity",
        "amount",
        "payment_method",
        "customer_id",
        "status",
        "invalid_reason",
        instant(quarantined_at).alias("quarantined_at"),
    )


def quarantine_reasons(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows per single reason; a row with several reasons counts under each."""
    return (
        quarantined.select(F.explode(F.split("invalid_reason", SEPARATOR)).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("quarantined_rows"))
        .orderBy(F.desc("quarantined_rows"), "reason")
    )


# --- declared constraints as checks -------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (should be none for a primary or unique key)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact key values without a dimension row, with their row counts (should be none).

    Counting per key first leaves one row per key to compare, whatever the skew.
    """
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return used.join(dim.select(key), key, "left_anti")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of each required column, as (column_name, null_rows), in one scan."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


# --- accounting ---------------------------------------------------------------------


def validate_raw(raw: DataFrame) -> DataFrame:
    """One-row summary of a raw file: size, repeated ids, missing fields, bad amounts."""
    amount = parse_float(F.col("amount"))
    columns = [name for name in raw.columns if name not in ("raw_row_id", "loaded_at")]
    distinct_ids = F.count_distinct("transaction_id") + F.max(F.col("transaction_id").isNull().cast("int"))
    return raw.agg(
        F.count(F.lit(1)).alias("rows_including_duplicates"),
        F.lit(", ".join(columns)).alias("columns"),
        F.coalesce(F.count(F.lit(1)) - distinct_ids, F.lit(0)).alias("duplicate_transaction_ids"),
        F.count_if(F.col("order_timestamp").isNull()).alias("null_timestamps"),
        F.count_if(F.col("channel").isNull()).alias("null_channels"),
        F.count_if(F.col("product_category").isNull()).alias("null_products"),
        F.count_if(F.col("amount").isNull()).alias("null_amounts"),
        F.count_if(amount == 0).alias("zero_amounts"),
        F.count_if(amount < 0).alias("negative_amounts"),
    )


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")


def load_counts(raw: DataFrame, fact: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rows loaded, modeled and quarantined."""
    parts = [_count(raw, "raw_rows"), _count(fact, "fact_rows"), _count(quarantined, "quarantined_rows")]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("value", "row_count")


def dq_summary(accounting: DataFrame, fact: DataFrame, quarantined: DataFrame) -> DataFrame:
    """The data-quality report as (metric, value) rows, given `classified` of the raw rows."""
    copies = accounting.select("raw_rows", F.col("exact_duplicate_rows").alias("exact_duplicate_rows_removed"))
    quarantined_rows = quarantined.agg(F.count(F.lit(1)).alias("invalid_or_quarantined_rows_after_exact_dedup"))
    eligible = F.col("is_value_eligible")
    modeled = fact.agg(
        F.count(F.lit(1)).alias("clean_modeled_transactions"),
        F.count_if(eligible).alias("completed_transactions_used_for_value"),
        F.sum(F.when(eligible, F.col("amount"))).alias("completed_value"),
        F.sum(F.when(eligible, F.col("quantity"))).alias("completed_units"),
    )

    def as_rows(one_row: DataFrame) -> DataFrame:
        wide = one_row.select([F.col(name).cast("decimal(24,2)").alias(name) for name in one_row.columns])
        return wide.unpivot([], wide.columns, "metric", "value")

    return reduce(DataFrame.unionByName, [as_rows(part) for part in (copies, quarantined_rows, modeled)])


def classified(raw: DataFrame, as_of: str | None) -> DataFrame:
    """Counts of raw rows by what becomes of them, one row.

    Rows are classified where they are read, and counted by the digest of their texts. This shuffles
    the digests of all distinct texts, so a build does it once and stores the row.
    """
    ok = F.coalesce(acceptable(as_of), F.lit(False))
    kind = F.when(~ok, 0).when(F.col("status_clean").isNull(), 1).otherwise(2).cast("byte")
    rows = typed(raw).select(text_digest().alias("digest"), kind.alias("kind"))
    texts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("kind").alias("kind"))
    return texts.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("exact_duplicate_rows"),
        F.count_if(F.col("kind") == 0).alias("quarantined_rows"),
        F.count_if(F.col("kind") == 1).alias("rows_without_status"),
        F.count_if(F.col("kind") == 2).alias("valid_rows"),
    )


def row_accounting(accounting: DataFrame, fact: DataFrame) -> DataFrame:
    """Where every raw row went, one row, given `classified` of the raw rows:
    raw = exact duplicates + quarantined + without status + superseded versions + fact.
    """
    modeled = fact.agg(F.count(F.lit(1))).scalar()
    return accounting.select(
        "raw_rows",
        "exact_duplicate_rows",
        "quarantined_rows",
        "rows_without_status",
        (F.col("valid_rows") - modeled).alias("superseded_rows"),
        modeled.alias("fact_rows"),
    )
