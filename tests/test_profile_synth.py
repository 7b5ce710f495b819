"""Profile of a source and the generated data."""

import bisect
import dataclasses
import itertools
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from txnmart.functions.draws import below, scattered
from txnmart.operators import profile, synth
from txnmart.schemas import SOURCE_FIELDS


def test_shares_clean_each_column_its_own_way(raw):
    df = raw({"channel": " web", "product_category": " HOME", "status": "Failed", "quantity": "2.9"},
             {"channel": "web", "product_category": "home", "status": "failed", "quantity": "2"},
             {"channel": None, "product_category": "home", "status": "FAILED", "quantity": "two"})
    assert rows_of(profile.value_shares(df, "channel")) == [(" web", 0.5), ("web", 0.5)]
    assert rows_of(profile.value_shares(df, "product_category")) == [(" Home", 1 / 3), ("Home", 2 / 3)]
    assert rows_of(profile.value_shares(df, "status")) == [("failed", 1.0)]
    assert rows_of(profile.value_shares(df, "quantity")) == [(2, 1.0)]
    counts = profile.all_value_counts(df).filter("attribute = 'product_category'").select("value", "n")
    assert rows_of(counts) == [(" Home", 1), ("Home", 2)]


def test_top_shares_order(raw):
    df = raw({"quantity": "3"}, {"quantity": "3"}, {"quantity": "1"}, {"status": "failed", "quantity": "2"})
    assert [row.value for row in profile.top_shares(df, "quantity", 2).collect()] == [1, 2]
    assert [row.value for row in profile.top_shares(df, "status", 1).collect()] == ["completed"]


def test_lognormal_fit_floors_amounts_and_spread(raw):
    df = raw({"amount": "0.5"}, {"amount": "100", "product_category": "toys"}, {"amount": "1e2", "product_category": "\ttoys "},
             {"amount": "-4"}, {"amount": "x"}, {"amount": "10", "product_category": None})
    got = {row.product_category: row for row in profile.fit_lognormal(df).collect()}
    assert set(got) == {"Home", "Toys"}
    assert (got["Home"].log_mean, got["Home"].log_std) == (0.0, 0.25)
    assert got["Toys"].log_mean == pytest.approx(math.log(100)) and got["Toys"].log_std == 0.25


def test_customer_pool(raw):
    ids = [{"customer_id": c} for c in ("C7", "9000", "Cx", None, "C9C1")]
    assert profile.customer_pool(raw(*ids)).first() == (9000, 180_000)
    assert profile.customer_pool(raw({"customer_id": "C1"})).first() == (1, 50_000)


def test_comparison_fills_missing_values_with_zero(raw):
    left, right = raw({"channel": "a"}, {"channel": "a"}, {"channel": "b"}), raw({"channel": "c"}, {"channel": "b"})
    got = [tuple(row) for row in profile.compare_distribution(left, right, "channel").collect()]
    assert got == [("a", 2 / 3, 0.0), ("b", 1 / 3, 0.5), ("c", 0.0, 0.5)]


def test_day_weights(spark):
    days = {str(row.day): row for row in synth.day_weights(spark).collect()}
    assert len(days) == 1096
    assert sum(row.share for row in days.values()) == pytest.approx(1)
    weights = {day: days[day].weight for day in ("2024-01-02", "2024-01-06", "2024-11-04", "2024-04-20", "2024-04-26")}
    assert weights == {"2024-01-02": 1.0, "2024-01-06": 1.25, "2024-11-04": 1.25, "2024-04-20": 2.125, "2024-04-26": 1.0}


@pytest.mark.parametrize(("n", "chunk", "expected"), [(1_000, 250, 8), (1_003, 250, 8), (100, 250_000, 0), (250_000, 250_000, 2_000)])
def test_copies_have_the_exact_count_per_chunk(spark, n, chunk, expected):
    picks = synth.duplicate_ids(spark, n, chunk=chunk)
    row = picks.agg(F.count("*").alias("n"), F.count_distinct("row_number").alias("d"),
                    F.min("row_number"), F.max("row_number")).first()
    assert (row.n, row.d) == (expected, expected)
    if expected:
        assert 0 <= row[2] and row[3] < n
    per_chunk = picks.groupBy(F.expr(f"row_number div {chunk}")).count().agg(F.max("count")).first()[0]
    assert (per_chunk or 0) <= int(chunk * 0.008)


def test_copies_are_a_simple_random_sample(spark):
    """Ten of a hundred rows in each of 400 chunks: every row alike often, and two of one stretch as often as they should."""
    picks = synth.duplicate_ids(spark, 40_000, rate=0.1, chunk=100)
    chunks = {}
    for (number,) in picks.collect():
        chunks.setdefault(number // 100, set()).add(number % 100)
    assert len(chunks) == 400 and all(len(own) == 10 for own in chunks.values())
    often = [sum(at in own for own in chunks.values()) for at in range(100)]
    # Each is drawn 40 times on average; the sum of squared deviations over the variance of 36 is about 99, give or take 14.
    assert 50 < sum((n - 40) ** 2 for n in often) / 36 < 160
    together = sum(own >= {at, at + 1} for own in chunks.values() for at in range(0, 100, 2))
    # Expected 400 * 50 * (10 * 9) / (100 * 99) = 182 pairs; none at all if each stretch gave one.
    assert 140 < together < 225
    assert len({tuple(sorted(own)) for own in chunks.values()}) == 400


def test_issue_precedence(spark):
    always = {issue: 1.0 for issue in synth.ISSUE_RATES}
    df = spark.range(1).select(F.col("id").alias("row_number"), F.lit("2024-01-01 00:00:00").alias("order_timestamp"),
                               F.lit("Web").alias("channel"), F.lit("Home").alias("product_category"),
                               F.lit("5.00").alias("amount"))
    row = synth.inject_issues(df, rates=always).first()
    assert (row.order_timestamp, row.channel, row.product_category) == (synth.MALFORMED_TIMESTAMP, None, None)
    assert float(row.amount) == 0
    row = synth.inject_issues(df, rates={**always, "zero_amount": 0.0}).first()
    assert row.amount is None
    row = synth.inject_issues(df, rates={**always, "zero_amount": 0.0, "null_amount": 0.0}).first()
    assert row.amount == "-5.00"


def test_generated_rows(spark, raw):
    source = raw(
        *[{"channel": c, "product_category": p, "amount": a, "quantity": q, "status": s, "customer_id": "C10"}
          for c, p, a, q, s in [("web", "home", "20", "1", "completed"), (" Web ", "home", "30", "2", "failed"),
                                ("app", "toys", "500", "1", "completed"), ("web", "new", "0", "1", "completed")]]
    )
    n = 20_000
    rows = synth.generate(source, n=n, chunk=5_000).repartition(3)
    assert rows.columns == SOURCE_FIELDS
    assert rows.count() == n + 4 * 40
    ids = rows.agg(F.min("transaction_id"), F.max("transaction_id"), F.count_distinct("transaction_id")).first()
    assert tuple(ids) == ("SYN1000000", f"SYN{1_000_000 + n - 1}", n)
    for column in ("channel", "product_category", "status", "quantity"):
        for row in profile.compare_distribution(source, rows, column).collect():
            assert abs(row.source_share - row.synthetic_share) < 0.02
    fitted = {row.product_category: row for row in profile.fit_lognormal(rows).collect()}
    assert fitted["New"].log_mean == pytest.approx(4.0, abs=0.05)  # no positive amounts to learn from
    assert fitted["New"].log_std == pytest.approx(0.5, abs=0.05)
    assert fitted["Toys"].log_mean == pytest.approx(math.log(500), abs=0.05)
    customers = rows.agg(F.min(F.substring("customer_id", 2, 9).cast("int")), F.max(F.substring("customer_id", 2, 9).cast("int"))).first()
    assert customers[0] >= 1 and customers[1] <= 50_000


def test_generated_rows_do_not_depend_on_partitioning(spark, raw):
    source = raw({}, {"channel": "app", "amount": "9"})
    draws = synth.draw_table(source)

    def rows(partitions):
        ids = spark.range(0, 500, 1, partitions).withColumnRenamed("id", "row_number")
        return rows_of(synth.inject_issues(synth.synth_rows(ids, draws, 100)))

    assert rows(1) == rows(5)


def test_draws_find_the_interval_that_holds_the_number(spark, raw):
    """Against a search over cumulative weights, with the table broadcast and with it shuffled."""
    labels = ["web"] * 9 + ["app"] * 2 + ["a", "b", "c", "partner", "partner"]
    draws = synth.draw_table(raw(*[{"channel": label} for label in labels]))
    values = sorted(set(labels))
    ends = list(itertools.accumulate(labels.count(value) for value in values))
    assert draws.lines["channel"] == (len(labels), len(labels) // len(values))

    ids = spark.range(2_000).withColumnRenamed("id", "row_number")
    ids = scattered(ids, "row_number")
    numbers = ids.withColumn("n", below("channel", 42, F.lit(len(labels))))
    expected = {row.row_number: values[bisect.bisect_right(ends, row.n)] for row in numbers.collect()}
    for size in (draws.size, 1 << 40):
        drawn = synth.draw(ids, dataclasses.replace(draws, size=size), "channel").collect()
        assert len(drawn) == 2_000
        assert {row.row_number: row.channel for row in drawn} == expected


def test_a_source_without_values_cannot_be_drawn_from(spark, raw):
    with pytest.raises(ValueError, match="channel"):
        synth.generate(raw({"channel": None}), n=10)
