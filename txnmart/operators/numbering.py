"""Dense numbering and running totals without a single-task global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmart.session import written


def running_total(df: DataFrame, order: Sequence[str], value: str, total: str) -> DataFrame:
    """Add ``total``: the sum of ``value`` over all rows before this one by the unique columns ``order``.

    Rows are range-partitioned and written, which fixes their slice numbers; each
    slice sums its own rows and adds the total of the slices before it.
    """
    slices = written(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    # One row per slice, at most the number of shuffle partitions: small enough for one
    # window and for a broadcast.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = slices.groupBy("_slice").agg(F.sum(value).alias("_sum"))
    offsets = sums.select("_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        slices.join(F.broadcast(offsets), "_slice")
        .withColumn(total, F.col("_offset") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("_slice", "_offset")
    )


def number_names(names: DataFrame) -> DataFrame:
    """Surrogate keys 1..n in name order within each entity, for distinct (entity, name) rows."""
    counted = running_total(names.withColumn("_one", F.lit(1).cast("long")), ["entity", "name"], "_one", "_before")
    # One row per entity: a handful, whatever the number of names.
    first = counted.groupBy("entity").agg(F.min("_before").alias("_first"))
    numbered = counted.join(F.broadcast(first), "entity")
    return numbered.select("entity", (F.col("_before") - F.col("_first") + 1).cast("long").alias("key"), "name")


def one_dim(numbered: DataFrame, entity: str) -> DataFrame:
    """The dimension of one entity out of `number_names`."""
    own = numbered.filter(F.col("entity") == entity)
    return own.select(F.col("key").alias(f"{entity}_key"), F.col("name").alias(f"{entity}_name"))
