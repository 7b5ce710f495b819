"""Cleaning, parsing and calendar expressions on edge values."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnmart.functions import draws, parse, text
from txnmart.functions.calendar import date_attributes, date_key, week_start

TEXT_CASES = [
    (text.blank_to_null, [("  a b ", "a b"), ("   ", None), ("", None), (None, None), ("\t", "\t")]),
    (
        text.normalize_channel,
        [
            (" WEB ", "Web"), ("Website", "Web"), ("app", "Mobile App"), ("Mobile", "Mobile App"),
            ("mobile app ", "Mobile App"), ("partner", "Partner Marketplace"), ("MARKETPLACE", "Partner Marketplace"),
            ("partner marketplace", "Partner Marketplace"), ("in-store kiosk", "In-Store Kiosk"),
            ("  ", None), (None, None),
        ],
    ),
    (
        text.title_clean,
        [
            ("home", "Home"), (" HOME garden ", "Home Garden"), ("home-garden", "Home-Garden"), ("o'neil", "O'Neil"),
            ("3rd floor", "3rd Floor"), ("a_b", "A_B"), ("été", "Été"), ("", None), (" ", None), (None, None),
        ],
    ),
    (text.title_letters, [("3rd floor", "3Rd Floor"), ("HOME", "Home"), ("o'neil", "O'Neil"), (" x", " X")]),
    (text.profile_category, [("\t home \n", "Home"), ("  ", None), ("a-b", "A-B"), (None, None)]),
    (text.normalize_status, [(" Completed ", "completed"), ("", None), (None, None)]),
    (
        parse.parse_int,
        [
            ("7", 7), (" 7 ", 7), ("-3", -3), ("007", 7), ("1.5", None), ("+3", None), ("12\n", None), ("two", None),
            ("", None), (None, None), ("99999999999", None),
        ],
    ),
    (
        parse.parse_amount,
        [
            ("12.345", Decimal("12.35")), ("-2.345", Decimal("-2.35")), ("0.004", Decimal("0.00")),
            ("0.00499999999999", Decimal("0.00")), ("5", Decimal("5.00")), ("1e5", None), (".5", None), ("5.", None),
            ("+3", None), ("1,000", None), ("12.5\n", None), ("1" * 20, None), (None, None),
        ],
    ),
    (
        parse.parse_order_ts,
        [
            ("2026-01-05 10:11:12", datetime(2026, 1, 5, 10, 11, 12)), (" 2026-01-05 10:11:12 ", datetime(2026, 1, 5, 10, 11, 12)),
            ("2024-02-29 00:00:00", datetime(2024, 2, 29)), ("2026-02-30 10:00:00", None), ("2026-13-01 99:99", None),
            ("2026-01-05", None), ("2026-01-05T10:11:12", None), ("1899-01-05 10:11:12", None),
            ("2026-01-05 24:00:00", None), ("2026-01-05 10:11:12.5", None), ("2026-01-05 10:11:12\n", None), ("", None),
        ],
    ),
    (parse.parse_float, [("1e5", 1e5), (".5", 0.5), ("+3", 3.0), ("5.", 5.0), ("1d", None), ("two", None), ("", None)]),
]


@pytest.mark.parametrize(("function", "cases"), TEXT_CASES, ids=[case[0].__name__ for case in TEXT_CASES])
def test_expression(spark, function, cases):
    df = spark.createDataFrame([(i, value) for i, (value, _) in enumerate(cases)], "i int, x string")
    got = {row.i: row.y for row in df.select("i", function(F.col("x")).alias("y")).collect()}
    assert [(value, got[i]) for i, (value, _) in enumerate(cases)] == cases


def test_date_attributes_mix_calendar_years_with_iso_weeks(spark):
    days = spark.createDataFrame([(date(2027, 1, 1),), (date(2026, 4, 20),)], "d date")
    friday, monday = days.select(*date_attributes(F.col("d"))).orderBy(F.desc("date_key")).collect()
    assert friday.asDict() == {
        "date_key": 20270101, "date_actual": date(2027, 1, 1), "week_start": date(2026, 12, 28),
        "month_start": date(2027, 1, 1), "year_num": 2027, "quarter_num": 1, "month_num": 1, "week_num": 53,
        "day_of_week_num": 5, "day_name": "Friday", "is_weekend": False,
    }
    assert (monday.week_start, monday.day_name, monday.week_num) == (date(2026, 4, 20), "Monday", 17)


def test_date_key_and_week_of_a_timestamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-04-26 23:59:59' AS t")
    row = df.select(date_key(F.col("t")).alias("k"), week_start(F.col("t")).alias("w")).first()
    assert (row.k, row.w) == (20260426, date(2026, 4, 20))


def test_draws_are_uniform_and_independent_of_partitioning(spark):
    def figures(partitions):
        ids = draws.scattered(spark.range(0, 50_000, 1, partitions), "id")
        u, z = draws.uniform("u", 1), draws.standard_normal("z", 1)
        below = draws.below("b", 1, F.lit(10))
        return ids.agg(
            F.round(F.avg(u), 9), F.min(u) >= 0, F.max(u) < 1, F.round(F.avg(z), 9), F.round(F.stddev_pop(z), 9),
            F.min(below), F.max(below), F.round(F.corr(u, z), 3),
        ).first()

    one = figures(1)
    assert one == figures(7)
    assert abs(one[0] - 0.5) < 0.01 and one[1] and one[2]
    assert abs(one[3]) < 0.02 and abs(one[4] - 1) < 0.02
    assert (one[5], one[6]) == (0, 9) and abs(one[7]) < 0.02
