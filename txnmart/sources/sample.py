"""Messy raw transactions derived from the ``orders`` and ``customer`` tables.

Every order becomes one source row with deterministic defects chosen by its key:
untrimmed and superseded ids, broken or out-of-range timestamps, channel spelling
variants, blank fields, non-numeric and non-positive numbers, unknown statuses,
plus exact copies of every 125th row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Order dates are moved 25 years forward; this instant pins "now" for them.
AS_OF = "2026-06-01 00:00:00"
COPY_ID_OFFSET = 1_000_000_000_000


def _every(key: Column, divisor: int) -> Column:
    return key % divisor == 7


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_row_id`` plus the nine source columns, all text."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    k = F.col("o_orderkey")
    moved = F.col("o_orderdate") + F.make_ym_interval(F.lit(25)) + F.make_dt_interval(hours=(k % 24).cast("int"))
    base = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        k.alias("raw_row_id"),
        F.when(_every(k, 211), None)
        .when(k % 13 == 5, F.concat(F.lit("T"), (k - 1).cast("string")))
        .otherwise(F.concat(F.lit(" T"), k.cast("string")))
        .alias("transaction_id"),
        F.when(_every(k, 307), None)
        .when(_every(k, 311), "2026-13-01 99:99")
        .when(_every(k, 313), "2019-06-01 00:00:00")
        .when(_every(k, 317), "2026-02-30 10:00:00")
        .otherwise(moved.cast("string"))
        .alias("order_timestamp"),
        F.when(_every(k, 199), "  ")
        .when(F.col("o_orderpriority") == "1-URGENT", "web")
        .when(F.col("o_orderpriority") == "2-HIGH", " Website")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "APP")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Partner")
        .otherwise("mobile app ")
        .alias("channel"),
        F.when(~_every(k, 283), F.col("c_mktsegment")).alias("product_category"),
        F.when(_every(k, 197), "two")
        .when(_every(k, 193), "0")
        .otherwise((1 + k % 5).cast("string"))
        .alias("quantity"),
        F.when(_every(k, 101), None)
        .when(_every(k, 499), "0")
        .when(_every(k, 503), "-12.50")
        .otherwise(F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
        .alias("amount"),
        F.when(_every(k, 401), "")
        .when(k % 4 == 0, "card")
        .when(k % 4 == 1, "bank_transfer")
        .otherwise("wallet")
        .alias("payment_method"),
        F.when(~_every(k, 409), F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("customer_id"),
        F.when(_every(k, 419), "pending")
        .when(_every(k, 421), None)
        .when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", "completed")
        .when(k % 2 == 0, "refunded")
        .otherwise("failed")
        .alias("status"),
    )
    # Copied orders are emitted twice from one pass over the join, not by a second scan.
    shifts = F.when(F.col("raw_row_id") % 125 == 0, F.array(F.lit(0), F.lit(COPY_ID_OFFSET)))
    shifted = base.select("*", F.explode(F.coalesce(shifts, F.array(F.lit(0)))).alias("shift"))
    return shifted.withColumn("raw_row_id", F.col("raw_row_id") + F.col("shift")).drop("shift")
