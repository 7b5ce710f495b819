"""Expected range of daily volumes."""

from dataclasses import dataclass
from datetime import date, timedelta
from statistics import median

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.functions.calendar import date_attributes
from txnmart.operators.monitoring import volume_baseline


@dataclass
class Daily:
    """What the baseline reads of a mart."""

    fact: DataFrame
    dim_date: DataFrame


def test_days_outside_their_weekdays_history(spark):
    first = date(2024, 1, 1)
    counts = [100 + day % 7 * 10 + day % 3 for day in range(140)]
    counts[70], counts[80], counts[90] = 0, 400, 400
    days = spark.range(140).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"), "id")
    dim = days.select(*date_attributes(F.col("day")))
    rows = spark.createDataFrame(list(enumerate(counts)), "id long, n int").join(days, "id")
    fact = rows.filter("n > 0").select(F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"), F.explode(F.sequence(F.lit(1), "n")))
    found = {row.date_actual: row for row in volume_baseline(Daily(fact, dim)).collect()}
    assert len(found) == 140
    for at, count in enumerate(counts):
        row, before = found[first + timedelta(at)], [counts[i] for i in range(at % 7, at, 7)][-8:]
        assert (row.row_count, row.days_seen) == (count, len(before))
        if len(before) < 4:
            assert row.volume == "no history" and row.typical_rows is None and row.expected_low is None
            continue
        middle = median(before)
        spread = max(1.4826 * median(abs(n - middle) for n in before), middle**0.5)
        assert row.typical_rows == middle
        assert abs(row.expected_low - max(middle - 3 * spread, 0)) < 1e-5 and abs(row.expected_high - middle - 3 * spread) < 1e-5
        assert row.volume == {70: "low", 80: "high", 90: "high"}.get(at, "expected")
