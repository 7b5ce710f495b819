"""Deduplication, lookups and numbering, with hot keys."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, rows_of
from txnmart.operators.cleaning import typed
from txnmart.operators.dedup import dedup_exact, dedup_latest, row_texts, text_digest
from txnmart.operators.dims import merge_dim
from txnmart.operators.fact import clean_latest
from txnmart.operators.joins import lookup, measure
from txnmart.operators.numbering import number_names, running_total
from txnmart.operators.quality import classified


def test_exact_copies_use_raw_texts_but_the_trimmed_customer(raw):
    rows = raw({}, {}, {"customer_id": " C1 "}, {"amount": "10.0"}, {"status": None}, {"status": None})
    got = dedup_exact(row_texts(rows)).select("raw_row_id", "copies")
    assert rows_of(got) == [(1, 3), (4, 1), (5, 2)]


def test_latest_version_breaks_ties_by_row_id(raw):
    same = "2026-01-05 10:00:00"
    rows = typed(raw({"amount": "1"}, {"order_timestamp": "2026-01-06 10:00:00", "amount": "2"}, {"amount": "3"},
                     {"transaction_id": "T2", "order_timestamp": same, "amount": "4"},
                     {"transaction_id": " T2", "order_timestamp": same, "amount": "5"}))
    assert rows_of(dedup_latest(rows).select("raw_row_id", "transaction_id")) == [(2, "T1"), (5, "T2")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"),
        F.col("id").alias("order_ts"),
        F.col("id").alias("raw_row_id"),
    )
    result = dedup_latest(rows)
    assert result.count() == 20_001
    assert result.filter("transaction_id = 'hot'").first().raw_row_id == 29_997
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_hot_keys_are_not_sorted_before_the_shuffle(spark, raw):
    rows = typed(raw({"amount": "1"}, {"order_timestamp": "2026-01-06 10:00:00"}, {"transaction_id": None}, {"transaction_id": "T2"}))
    result = clean_latest(rows, AS_OF)
    assert [row[0] for row in rows_of(result.select("raw_row_id"))] == [2, 4]
    plan = plan_of(result)
    assert "Exchange" in plan and not any(step in plan[plan.index("Exchange") :] for step in ("Sort", "WindowGroupLimit"))


def test_hot_and_other_keys_keep_their_latest_rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise((F.col("id") % 6_000).cast("string"))
    rows = spark.range(0, 30_000, 1, 8).select(key.alias("transaction_id"), (F.col("id") % 7).alias("order_ts"), F.col("id").alias("raw_row_id"))
    best = rows.groupBy("transaction_id").agg(F.max(F.struct("order_ts", "raw_row_id")).alias("best"))
    expected = best.select("transaction_id", "best.order_ts", "best.raw_row_id")
    assert rows_of(dedup_latest(rows)) == rows_of(expected)
    assert rows_of(dedup_latest(rows, counted=rows.limit(0))) == rows_of(expected)


def test_digests_tell_fields_and_nulls_apart(raw):
    rows = raw({}, {}, {"customer_id": " C1 "}, {"channel": None}, {"channel": ""}, {"channel": "-"}, {"channel": "web4:", "product_category": ""},
               {"channel": "we", "product_category": "bhome"}, {"quantity": None, "amount": "2"}, {"quantity": "2", "amount": None})
    groups = typed(rows).groupBy(text_digest()).agg(F.min("raw_row_id").alias("first"), F.count("*").alias("copies")).select("first", "copies")
    assert rows_of(groups) == rows_of(dedup_exact(row_texts(rows)).select("raw_row_id", "copies"))


def test_accounting_shuffles_digests_only(raw):
    counts = classified(raw({}, {}, {"amount": "x"}, {"amount": "x"}, {"status": None}, {"amount": "3"}), AS_OF)
    assert rows_of(counts) == [(6, 2, 1, 1, 2)]
    moved = [line for line in plan_of(counts).splitlines() if "Exchange" in line and "hashpartitioning" in line]
    assert moved and all("hashpartitioning(digest" in line for line in moved)


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_lookup_is_the_same_broadcast_or_salted(spark, max_bytes):
    rows = spark.range(0, 3_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("label")
    )
    dim = spark.createDataFrame([("hot", 1), *[(str(i), i + 10) for i in range(40)]], "name string, key int")
    found = lookup(rows, dim, {"label": "name"}, measure({"dim": dim})["dim"], max_bytes=max_bytes, salts=8)
    assert found.columns == ["id", "label", "key"]
    expected = rows.join(dim, F.col("label") == F.col("name")).select("id", "label", "key")
    assert rows_of(found) == rows_of(expected)


def test_measure_counts_text_bytes(spark):
    sizes = measure({"a": spark.createDataFrame([("xyz",)], "s string"), "b": spark.range(0).select("id")})
    assert sizes == {"a": 16 + 3, "b": 0}


def test_running_total_spans_slices(spark):
    rows = spark.range(1_000).select(F.format_string("%04d", "id").alias("name"), (F.col("id") % 7).alias("n"))
    got = running_total(rows, ["name"], "n", "before").orderBy("name").collect()
    total = 0
    for row in got:
        assert row.before == total
        total += row.n


def test_keys_are_dense_in_name_order_per_entity(spark):
    names = [("x", f"n{i:03d}") for i in range(200)] + [("y", "b"), ("y", "a")]
    got = number_names(spark.createDataFrame(names, "entity string, name string")).collect()
    assert sorted((r.entity, r.key, r.name) for r in got) == [
        *[("x", i + 1, f"n{i:03d}") for i in range(200)], ("y", 1, "a"), ("y", 2, "b")]


def test_merging_a_dim_keeps_known_keys(spark):
    known = spark.createDataFrame([(3, "Web")], "channel_key long, channel_name string")
    names = spark.createDataFrame([("Web",), ("Mobile App",), (None,), ("Kiosk",), ("Kiosk",)], "channel_name string")
    assert rows_of(merge_dim(known, names, "channel")) == [(3, "Web"), (4, "Kiosk"), (5, "Mobile App")]
    assert rows_of(merge_dim(known.limit(0), names, "channel"))[0] == (1, "Kiosk")
