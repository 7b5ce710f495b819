"""Incremental load: clean only newly landed rows and merge them by transaction id.

The clean table holds the latest valid version of each transaction, partitioned by
month. A batch touches only the months it has rows for and the months its ids were
in before; other months are neither read in full nor rewritten.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart.functions.calendar import month_start
from txnmart.operators.cleaning import typed
from txnmart.operators.dedup import dedup_latest
from txnmart.operators.fact import CLEAN_COLUMNS, clean_latest
from txnmart.operators.quality import quarantine
from txnmart.schemas import QUARANTINE, RAW, SOURCE_FIELDS
from txnmart.session import written

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("raw_row_id", T.LongType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("channel_clean", T.StringType()),
        T.StructField("product_category_clean", T.StringType()),
        T.StructField("payment_method_clean", T.StringType()),
        T.StructField("status_clean", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("quantity_int", T.IntegerType()),
        T.StructField("amount_num", T.DecimalType(14, 2)),
        T.StructField("month_start", T.DateType()),
    ]
)


def create_clean_table(spark: SparkSession, path: str) -> None:
    """Write an empty clean table unless ``path`` exists."""
    empty = spark.createDataFrame([], CLEAN_SCHEMA)
    empty.write.mode("ignore").partitionBy("month_start").parquet(path)


def clean_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLEAN_SCHEMA).parquet(path)


def quarantine_table(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined rows of all batches, one per distinct source row."""
    batches = spark.read.schema(QUARANTINE).parquet(path)
    texts = [*SOURCE_FIELDS, "invalid_reason"]
    return batches.groupBy(*texts).agg(
        F.min("raw_row_id").alias("raw_row_id"), F.min("quarantined_at").alias("quarantined_at")
    )


def past_mark(raw: DataFrame, mark: int | None) -> DataFrame:
    """Raw rows landed after the high-water mark, a ``raw_row_id``."""
    return raw if mark is None else raw.filter(F.col("raw_row_id") > mark)


def merge_latest(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union of both frames with the latest version per transaction id."""
    return dedup_latest(existing.select(*CLEAN_COLUMNS).unionByName(incoming.select(*CLEAN_COLUMNS)))


def upsert(incoming: DataFrame, path: str) -> None:
    """Merge one batch of valid, deduplicated rows into the clean table at ``path``.

    Merged months are staged first and then replace the old ones, so the same batch
    can be run again after a failure with the same result.
    """
    spark = incoming.sparkSession
    incoming = written(incoming.withColumn("month_start", month_start(F.col("order_ts"))))
    existing = clean_table(spark, path)
    replaced = existing.join(incoming.select("transaction_id"), "transaction_id", "left_semi")
    touched = _months(incoming.unionByName(replaced))
    if not touched:
        return
    affected = existing.filter(F.col("month_start").isin(touched))
    merged = merge_latest(affected, incoming).withColumn("month_start", month_start(F.col("order_ts")))
    _replace_months(written(merged), path, touched)


def _replace_months(staged: DataFrame, path: str, touched: list[date]) -> None:
    """Replace the months ``touched`` of the table at ``path`` by the staged rows."""
    (
        staged.hint("rebalance", F.col("month_start"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month_start")
        .parquet(path)
    )
    # A month whose rows all moved elsewhere gets no new rows, so empty it explicitly.
    for month in sorted(set(touched) - set(_months(staged))):
        emptied = staged.drop("month_start").limit(0)
        emptied.write.mode("overwrite").parquet(f"{path}/month_start={month.isoformat()}")


def _months(df: DataFrame) -> list[date]:
    """Distinct months, at most one per month of the accepted date range; as literals they prune partitions."""
    return [row.month_start for row in df.select("month_start").distinct().collect()]


def apply_batch(raw: DataFrame, batch: str, clean_path: str, quarantine_path: str, as_of: str | None = None) -> None:
    """Clean one batch of raw rows: valid rows are merged, invalid ones quarantined under the batch name."""
    cleaned = typed(raw)
    create_clean_table(raw.sparkSession, clean_path)
    upsert(clean_latest(cleaned, as_of), clean_path)
    quarantine(cleaned, as_of).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch}")


def load_new(
    spark: SparkSession,
    landed_path: str,
    clean_path: str,
    quarantine_path: str,
    checkpoint: str,
    as_of: str | None = None,
) -> None:
    """Process every landed raw file not processed before, then stop.

    The stream's checkpoint remembers the files. A batch that is replayed after a
    failure overwrites its own output.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        apply_batch(rows, str(batch_id), clean_path, quarantine_path, as_of)

    stream = spark.readStream.schema(RAW).parquet(landed_path)
    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
