"""Profile of a source file: value shares, amount distributions, customer range."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.functions import parse, text

# Customer pool growth and floor, and the spread used when a category has none.
POOL_FACTOR = 20
POOL_MINIMUM = 50_000
DEFAULT_SPREAD = 0.25


def whole_number(c: Column) -> Column:
    """Numeric text as a whole number, fraction cut off; other text is NULL."""
    return parse.parse_float(c).try_cast("long")


# How each profiled column is cleaned before counting. Channel and payment labels stay
# as they are, so that generated data keeps the spelling variants; the product label is
# title-cased but not stripped.
PROFILED: dict[str, Callable[[Column], Column]] = {
    "channel": lambda c: c,
    "product_category": text.title_letters,
    "status": F.lower,
    "payment_method": lambda c: c,
    "quantity": whole_number,
}


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of a column after its profile cleaning; NULLs are left out."""
    value = PROFILED[column](F.col(column))
    values = df.select(value.alias("value")).filter("value IS NOT NULL")
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def all_value_counts(df: DataFrame) -> DataFrame:
    """(attribute, value, n) of every profiled column, from one scan; values as text."""
    pairs = [
        F.struct(F.lit(column).alias("attribute"), clean(F.col(column)).cast("string").alias("value"))
        for column, clean in PROFILED.items()
    ]
    values = df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL")
    return values.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, share) of a column, shares adding up to one."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("value", (F.col("n") / total).alias("share"))


def top_shares(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values, or for quantity the ``k`` lowest."""
    shares = value_shares(df, column)
    order = [F.asc("value")] if column == "quantity" else [F.desc("share"), F.asc("value")]
    return shares.orderBy(*order).limit(k)


def fit_lognormal(df: DataFrame) -> DataFrame:
    """Mean and population spread of log amounts per category, over positive amounts.

    Amounts under one count as one; a spread of zero becomes `DEFAULT_SPREAD`.
    """
    category = text.profile_category(F.col("product_category"))
    amount = parse.parse_float(F.col("amount"))
    log_amount = F.log(F.greatest("amount", F.lit(1.0)))
    return (
        df.select(category.alias("product_category"), amount.alias("amount"))
        .filter((F.col("amount") > 0) & F.col("product_category").isNotNull())
        .groupBy("product_category")
        .agg(
            F.avg(log_amount).alias("log_mean"),
            F.coalesce(F.nullif(F.stddev_pop(log_amount), F.lit(0.0)), F.lit(DEFAULT_SPREAD)).alias("log_std"),
        )
    )


def customer_pool(df: DataFrame) -> DataFrame:
    """Highest numeric customer id (``C`` removed) and the size of the generated customer range."""
    digits = F.replace("customer_id", F.lit("C"), F.lit(""))
    number = F.when(digits.rlike(r"^[0-9]+\z"), digits.try_cast("long"))
    highest = df.agg(F.max(number).alias("max_customer_num"))
    pool = F.greatest(F.col("max_customer_num") * POOL_FACTOR, F.lit(POOL_MINIMUM)).cast("long")
    return highest.select("max_customer_num", pool.alias("customer_pool"))


def compare_distribution(source: DataFrame, synthetic: DataFrame, column: str) -> DataFrame:
    """Shares of both frames side by side, 0 where a value is missing, source share descending."""
    ours = value_shares(source, column).withColumnRenamed("share", "source_share")
    theirs = value_shares(synthetic, column).withColumnRenamed("share", "synthetic_share")
    return (
        ours.join(theirs, "value", "full_outer")
        .select(
            "value",
            F.coalesce("source_share", F.lit(0.0)).alias("source_share"),
            F.coalesce("synthetic_share", F.lit(0.0)).alias("synthetic_share"),
        )
        .orderBy(F.desc("source_share"), "value")
    )
