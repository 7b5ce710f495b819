"""Batches merged into the clean table against one full build."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, SMALL, rows_of
from txnmart.operators import quality
from txnmart.operators.cleaning import typed
from txnmart.operators.fact import clean_latest
from txnmart.plans.mart import build_mart
from txnmart.queries import scratch, two_batches
from txnmart.sources.raw import write_table
from txnmart.sources.sample import raw_transactions
from txnmart.streaming.incremental import apply_batch, clean_table, load_new, past_mark, quarantine_table


@pytest.fixture(scope="module")
def source(spark):
    return write_table(raw_transactions(spark, str(SMALL)), scratch(spark, "raw"))


def full(source):
    return rows_of(clean_latest(typed(source), AS_OF))


def test_batches_equal_a_full_build_and_can_be_replayed(spark, source):
    root = scratch(spark, "inc")
    first, second = two_batches(source).values()
    assert past_mark(source, None).count() == source.count()
    for name, batch in (("a", first), ("b", second), ("b", second)):
        apply_batch(batch, name, f"{root}/clean", f"{root}/bad", AS_OF)
    assert rows_of(clean_table(spark, f"{root}/clean").drop("month_start")) == full(source)
    got = quarantine_table(spark, f"{root}/bad").select("raw_row_id", "invalid_reason")
    assert rows_of(got) == rows_of(quality.quarantine(typed(source), AS_OF).select("raw_row_id", "invalid_reason"))
    mart = build_mart(source, f"{root}/mart", AS_OF, clean=clean_table(spark, f"{root}/clean"))
    assert mart.fact.count() == 1280


def test_a_row_may_leave_its_month_empty(spark, raw):
    root = scratch(spark, "inc")
    rows = raw({"order_timestamp": "2026-01-05 10:00:00"}, {"order_timestamp": "2026-03-05 10:00:00"},
               {"order_timestamp": "2026-02-05 10:00:00"})
    for i in (1, 2, 3):
        apply_batch(rows.filter(F.col("raw_row_id") == i), str(i), f"{root}/clean", f"{root}/bad", AS_OF)
    kept = clean_table(spark, f"{root}/clean").select("raw_row_id", F.col("month_start").cast("string"))
    assert rows_of(kept) == [(2, "2026-03-01")]
    apply_batch(rows.limit(0), "none", f"{root}/clean", f"{root}/bad", AS_OF)
    assert clean_table(spark, f"{root}/clean").count() == 1


def test_a_stream_processes_each_landed_file_once(spark, source):
    root = scratch(spark, "stream")
    mark = source.agg(F.floor(F.avg("raw_row_id"))).first()[0]
    stamped = source.withColumn("loaded_at", F.lit(AS_OF).cast("timestamp"))
    paths = (f"{root}/landed", f"{root}/clean", f"{root}/bad", f"{root}/progress")
    for part in (stamped.filter(F.col("raw_row_id") <= mark), past_mark(stamped, mark)):
        part.write.mode("append").parquet(paths[0])
        load_new(spark, *paths, AS_OF)
    assert rows_of(clean_table(spark, paths[1]).drop("month_start")) == full(source)
