"""Report windows and shares against known figures, ordering and empty input."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnmart.operators import metrics

# Known weekly results (week, transactions, value, units, growth %, 4-week average, deviation %).
WEEKS = [
    ("2026-02-09", 24, "2253.34", 42, None, None, None),
    ("2026-02-16", 172, "17260.33", 278, 665.9887100925738, None, None),
    ("2026-02-23", 180, "18459.64", 303, 6.948360778733642, None, None),
    ("2026-03-02", 179, "17659.82", 290, -4.332803890000026, 13908.2825, 26.97340595432971),
    ("2026-03-09", 181, "18837.00", 275, 6.665866356508743, 18054.1975, 4.335847660910974),
    ("2026-04-13", 209, "20785.21", 349, None, None, None),
    ("2026-04-20", 412, "43933.84", 650, 111.370681364297, None, None),
]
CHANNELS = [("Web", "179311.44", 51.9920619884451), ("Mobile App", "122385.24", 35.48608490652204),
            ("Partner Marketplace", "43185.66", 12.521853105032864)]


def weekly_frame(spark, rows):
    data = [(date.fromisoformat(week), count, units, Decimal(value) if value else None) for week, count, value, units in rows]
    return spark.createDataFrame(
        data, "week_start date, completed_transactions long, completed_units long, completed_value decimal(24,2)"
    )


@pytest.fixture
def known(spark):
    return weekly_frame(spark, [week[:4] for week in WEEKS])


def test_growth_report_reproduces_known_weeks(known):
    got = metrics.growth_report(known).collect()
    for row, (week, count, value, units, growth, average, deviation) in list(zip(got, WEEKS))[:5]:
        assert (row.week_start, row.transactions, row.value, row.units) == (
            date.fromisoformat(week), count, Decimal(value), units)
        assert row.wow_value_growth_pct == (None if growth is None else pytest.approx(growth, abs=1e-9))
        assert row.rolling_4wk_avg == (None if average is None else pytest.approx(average, abs=1e-9))
        assert row.vs_4wk_avg_pct == (None if deviation is None else pytest.approx(deviation, abs=1e-9))
    assert got[-1].wow_value_growth_pct == pytest.approx(111.370681364297, abs=1e-9)


def test_growth_rounds_and_compares_with_the_previous_row_present(known):
    got = metrics.growth(known).collect()
    assert [row.wow_value_growth_pct for row in got[:4]] == [None, Decimal("665.99"), Decimal("6.95"), Decimal("-4.33")]
    assert got[5].previous_week_value == Decimal("18837.00")


def test_growth_after_a_week_without_value(spark):
    weeks = weekly_frame(spark, [("2026-01-05", 0, None, None), ("2026-01-12", 1, "5.00", 1), ("2026-01-19", 1, "0.00", 1),
                                 ("2026-01-26", 1, "7.00", 1)])
    assert [row.wow_value_growth_pct for row in metrics.growth(weeks).collect()] == [None, None, Decimal("-100.00"), None]


def test_anomaly_uses_partial_frames_and_sorts_by_size(spark, known):
    got = metrics.anomaly(known).collect()
    by_week = {row.week_start.isoformat(): row.pct_vs_4wk_avg for row in got}
    assert by_week["2026-02-09"] == Decimal("0.00")
    assert by_week["2026-03-02"] == Decimal("26.97")
    sizes = [abs(row.pct_vs_4wk_avg) for row in got]
    assert sizes == sorted(sizes, reverse=True)
    empty_first = weekly_frame(spark, [("2026-01-05", 0, None, None), ("2026-01-12", 1, "5.00", 1)])
    assert [row.week_start.isoformat() for row in metrics.anomaly(empty_first).collect()] == ["2026-01-12"]


def test_shares_of_known_channels(spark):
    total = sum(Decimal(value) for _, value, _ in CHANNELS)
    df = spark.createDataFrame([(n, Decimal(v)) for n, v, _ in CHANNELS], "name string, value decimal(24,2)")
    pct = metrics.ratio_pct(F.col("value"), F.lit(total))
    got = {row.name: row.pct for row in df.select("name", pct.alias("pct")).collect()}
    assert got == {name: Decimal(str(round(share, 2))) for name, _, share in CHANNELS}


def test_figures_of_an_empty_fact(spark):
    fact = spark.createDataFrame([], "quantity int, amount decimal(14,2), is_value_eligible boolean")
    assert metrics.totals(fact).first().asDict() == {
        "completed_transaction_volume": 0, "completed_units": None, "completed_transaction_value": None,
        "avg_completed_order_value": None}
    assert metrics.executive_dashboard(fact).first().non_completed_transaction_rate_pct is None


def test_average_order_value_rounds_exact_halves_up(spark):
    fact = spark.createDataFrame(
        [(1, Decimal("0.01"), True), (1, Decimal("0.02"), True), (1, Decimal("9.00"), False)],
        "quantity int, amount decimal(14,2), is_value_eligible boolean",
    )
    row = metrics.executive_dashboard(fact).first()
    assert row.avg_completed_order_value == Decimal("0.02")
    assert row.non_completed_transaction_rate_pct == Decimal("33.33")
