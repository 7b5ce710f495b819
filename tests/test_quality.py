"""Rules, quarantine, checks and accounting."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, rows_of
from txnmart.operators import quality
from txnmart.operators.cleaning import typed

RULE_CASES = [
    ({}, ""),
    ({"transaction_id": "  "}, "missing transaction_id"),
    ({"order_timestamp": "2026-02-30 10:00:00"}, "missing or malformed timestamp"),
    ({"order_timestamp": None}, "missing or malformed timestamp"),
    ({"order_timestamp": "2019-12-31 23:59:59"}, "timestamp outside expected range"),
    ({"order_timestamp": "2020-01-01 00:00:00"}, ""),
    ({"order_timestamp": "2026-06-02 00:00:00"}, ""),
    ({"order_timestamp": "2026-06-02 00:00:01"}, "timestamp outside expected range"),
    ({"channel": ""}, "missing channel"),
    ({"channel": "kiosk"}, ""),
    ({"product_category": "   "}, "missing product_category"),
    ({"quantity": "two"}, "quantity not numeric"),
    ({"quantity": None}, "quantity not numeric"),
    ({"quantity": "0"}, "quantity is zero or negative"),
    ({"amount": "1e5"}, "amount missing or not numeric"),
    ({"amount": "0.004"}, "amount is zero or negative"),
    ({"amount": "-12.50"}, "amount is zero or negative"),
    ({"payment_method": " "}, "missing payment_method"),
    ({"customer_id": None}, "missing customer_id"),
    ({"status": "pending"}, "unknown status"),
    ({"status": None}, ""),
    ({"status": " REFUNDED "}, ""),
    ({"channel": None, "quantity": "-1", "status": "x"}, "missing channel; quantity is zero or negative; unknown status"),
]


def test_reasons(raw):
    checked = quality.validated(typed(raw(*[change for change, _ in RULE_CASES])), AS_OF)
    got = [row.invalid_reason for row in checked.orderBy("raw_row_id").collect()]
    assert got == [reason for _, reason in RULE_CASES]


@pytest.mark.parametrize("strict", [False, True])
def test_direct_test_agrees_with_the_reason_list(raw, strict):
    choices = {
        "transaction_id": ["T", " ", None],
        "order_timestamp": ["2026-01-05 10:00:00", "2026-02-30 00:00:00", "2018-01-01 00:00:00", "2026-06-02 00:00:01", None],
        "channel": ["web", ""],
        "quantity": ["1", "0", "x"],
        "amount": ["1.00", "0.001", None],
        "customer_id": ["C1", "  "],
        "status": ["failed", "odd", "  ", None],
    }
    df = typed(raw(*[dict(zip(choices, values)) for values in product(*choices.values())]))
    ok = F.coalesce(quality.acceptable(AS_OF, strict), F.lit(False))
    reason = quality.invalid_reason(quality.rules(AS_OF, strict))
    assert df.filter(ok != (reason == "")).count() == 0


def test_default_as_of_is_now(raw):
    df = typed(raw({"order_timestamp": "2025-01-01 00:00:00"}, {"order_timestamp": "2099-01-01 00:00:00"}))
    assert [row.raw_row_id for row in quality.valid(df, None).collect()] == [1]
    assert quality.quarantine(df, None).first().invalid_reason == "timestamp outside expected range"


def test_missing_status_is_neither_valid_nor_quarantined_unless_strict(raw):
    df = typed(raw({"status": None}, {"status": " "}))
    assert quality.valid(df, AS_OF).count() == 0
    assert quality.quarantine(df, AS_OF).count() == 0
    strict = quality.quarantine(df, AS_OF, strict_status=True).collect()
    assert [row.invalid_reason for row in strict] == ["missing status"] * 2


def test_quarantine_keeps_raw_texts_and_one_row_per_copy(raw):
    bad = {"amount": " x ", "transaction_id": " T9 ", "customer_id": " C7 "}
    df = typed(raw({}, bad, bad, {**bad, "customer_id": "C7"}, {**bad, "amount": "x"}))
    got = quality.quarantine(df, AS_OF, quarantined_at=AS_OF).orderBy("raw_row_id").collect()
    assert [(row.raw_row_id, row.transaction_id, row.amount, row.customer_id) for row in got] == [
        (2, " T9 ", " x ", "C7"),
        (5, " T9 ", "x", "C7"),
    ]
    assert [row.quarantine_id for row in got] == [2, 5]


def test_reason_counts_split_combined_reasons(spark):
    df = spark.createDataFrame([("a; b",), ("b",)], "invalid_reason string")
    assert rows_of(quality.quarantine_reasons(df)) == [("a", 1), ("b", 2)]


def test_constraint_checks(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (9, "b")], "k int, v string")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows_of(quality.duplicate_keys(fact, ["k"])) == [(1, 2)]
    assert rows_of(quality.orphan_keys(fact, dim, "k")) == [(9, 1)]
    assert rows_of(quality.null_violations(fact, ["k", "v"])) == [("k", 0), ("v", 1)]


def test_raw_summary_counts_repeats_beyond_the_first(raw):
    df = raw({"transaction_id": "A"}, {"transaction_id": "A", "amount": "0"}, {"transaction_id": None, "amount": "-1"},
             {"transaction_id": None, "amount": None, "channel": None})
    row = quality.validate_raw(df).first()
    assert row.rows_including_duplicates == 4 and row.duplicate_transaction_ids == 2
    assert (row.null_amounts, row.zero_amounts, row.negative_amounts, row.null_channels) == (1, 1, 1, 1)
    assert quality.validate_raw(df.limit(0)).first().rows_including_duplicates == 0
