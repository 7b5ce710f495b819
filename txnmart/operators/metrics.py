"""Reporting metrics over the mart.

Every metric first aggregates the fact by the key it needs, inside the scan stage,
and joins the dimension to the few resulting rows. Values count completed
transactions only; a group without any has count 0 and NULL sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnmart.plans.mart import Mart


def _completed(name: str) -> Column:
    return F.when(F.col("is_value_eligible"), F.col(name))


def completed_measures() -> list[Column]:
    return [
        F.count(F.when(F.col("is_value_eligible"), True)).alias("completed_transactions"),
        F.sum(_completed("quantity")).alias("completed_units"),
        F.sum(_completed("amount")).alias("completed_value"),
    ]


def summed_measures() -> list[Column]:
    """Combine rows of `completed_measures` into coarser groups."""
    return [
        F.sum("completed_transactions").alias("completed_transactions"),
        F.sum("completed_units").alias("completed_units"),
        F.sum("completed_value").cast("decimal(24,2)").alias("completed_value"),
    ]


def ratio_pct(part: Column, whole: Column) -> Column:
    """``round(100 * part / whole, 2)``, NULL for a zero whole. Multiplies first to keep the digits."""
    return F.round(100 * part / F.nullif(whole, F.lit(0)), 2).cast("decimal(18,2)")


def _average_order_value() -> Column:
    """Sum over count rather than ``avg``, whose six decimals would round twice."""
    eligible = F.count(F.when(F.col("is_value_eligible"), True))
    return F.round(F.sum(_completed("amount")) / F.nullif(eligible, F.lit(0)), 2).cast("decimal(18,2)")


# --- one-row figures ----------------------------------------------------------------


def totals(fact: DataFrame) -> DataFrame:
    count, units, value = completed_measures()
    return fact.agg(
        count.alias("completed_transaction_volume"),
        units,
        value.alias("completed_transaction_value"),
        _average_order_value().alias("avg_completed_order_value"),
    )


def executive_dashboard(fact: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1)).cast("decimal(20,0)")
    rest = F.count(F.when(~F.col("is_value_eligible"), True)).cast("decimal(20,0)")
    return fact.agg(
        *completed_measures(),
        _average_order_value().alias("avg_completed_order_value"),
        ratio_pct(rest, rows).alias("non_completed_transaction_rate_pct"),
    )


# --- by dimension -------------------------------------------------------------------


def status_distribution(mart: Mart) -> DataFrame:
    by_key = mart.fact.groupBy("status_key").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").alias("gross_amount_before_status_filter"),
    )
    return (
        by_key.join(mart.dim_status, "status_key")
        .select("status_name", "transactions", "gross_amount_before_status_filter")
        .orderBy(F.desc("transactions"), "status_name")
    )


def mix(mart: Mart, entity: str) -> DataFrame:
    """Completed figures and share of value by one name dimension.

    The total is a scalar subquery over the same aggregate. It sums all of the measures and drops
    rows without a key, of which the fact has none, as the join does: so both sides need the
    same columns and rows, and the planner scans the fact once and reuses the exchange. Unlike a window over all groups it has no single-task step that grows with them.
    """
    keyed = mart.fact.filter(F.col(f"{entity}_key").isNotNull())
    by_key = keyed.groupBy(f"{entity}_key").agg(*completed_measures())
    names = [name for name in by_key.columns if name != f"{entity}_key"]
    sums = F.struct(*(F.sum(name).alias(name) for name in names), F.max(f"{entity}_key").alias("last"))
    total = by_key.agg(sums).scalar().getField("completed_value")
    return (
        by_key.join(getattr(mart, f"dim_{entity}"), f"{entity}_key")
        .select(
            f"{entity}_name",
            "completed_transactions",
            "completed_units",
            "completed_value",
            ratio_pct(F.col("completed_value"), total).alias("value_share_pct"),
        )
        .orderBy(F.desc_nulls_first("completed_value"), f"{entity}_name")
    )


def channel_mix(mart: Mart) -> DataFrame:
    return mix(mart, "channel")


def product_category_mix(mart: Mart) -> DataFrame:
    return mix(mart, "product_category")


# --- by calendar --------------------------------------------------------------------


def by_calendar(mart: Mart, *columns: str) -> DataFrame:
    """Completed figures by columns of the date dimension, e.g. ``"week_start"``.

    Both join sides hold at most one row per day of the accepted date range, so the
    broadcast is bounded by the calendar, not by the data.
    """
    by_day = mart.fact.groupBy("date_key").agg(*completed_measures())
    days = mart.dim_date.select("date_key", *columns)
    return by_day.join(F.broadcast(days), "date_key").groupBy(*columns).agg(*summed_measures())


def weekly(mart: Mart) -> DataFrame:
    return by_calendar(mart, "week_start")


def monthly(mart: Mart) -> DataFrame:
    return by_calendar(mart, "month_start")


def day_of_week(mart: Mart) -> DataFrame:
    return (
        by_calendar(mart, "day_name", "day_of_week_num")
        .select("day_name", "day_of_week_num", "completed_transactions", "completed_value")
        .orderBy("day_of_week_num")
    )


# --- week over week -----------------------------------------------------------------
#
# These take a frame of (period, completed_*) rows, one per week or day of the
# calendar, so a window in one task is bounded.


def growth(periods: DataFrame, period: str = "week_start") -> DataFrame:
    """Change against the previous period present (not the previous calendar period)."""
    value, previous = F.col("completed_value"), F.col("previous_week_value")
    in_order = Window.orderBy(period)
    return (
        periods.withColumn("previous_week_value", F.lag("completed_value").over(in_order))
        .select(
            period,
            "completed_transactions",
            "completed_units",
            "completed_value",
            "previous_week_value",
            ratio_pct(value - previous, previous).alias("wow_value_growth_pct"),
        )
        .orderBy(period)
    )


def anomaly(periods: DataFrame, period: str = "week_start") -> DataFrame:
    """Deviation from the moving average of up to four periods, largest first."""
    last_four = Window.orderBy(period).rowsBetween(-3, 0)
    value, average = F.col("completed_value"), F.col("rolling_4wk_avg")
    deviation = value / F.nullif(average, F.lit(0)) - 1
    return (
        periods.withColumn("rolling_4wk_avg", F.avg("completed_value").over(last_four))
        .filter(average.isNotNull())
        .orderBy(F.abs(deviation).desc_nulls_first(), period)
        .select(
            period,
            "completed_transactions",
            "completed_value",
            F.round(100 * deviation, 2).cast("decimal(18,2)").alias("pct_vs_4wk_avg"),
        )
    )


def growth_report(periods: DataFrame, period: str = "week_start", min_periods: int = 4) -> DataFrame:
    """Unrounded report: growth, moving average over full four-period frames only, deviation."""
    in_order = Window.orderBy(period)
    last_four = in_order.rowsBetween(-3, 0)
    value = F.col("completed_value").cast("double")
    previous = F.lag(value).over(in_order)
    full = F.count(value).over(last_four) >= min_periods
    average = F.when(full, F.avg(value).over(last_four))
    return periods.select(
        period,
        F.col("completed_transactions").alias("transactions"),
        F.col("completed_value").alias("value"),
        F.col("completed_units").alias("units"),
        (100.0 * (value - previous) / F.nullif(previous, F.lit(0.0))).alias("wow_value_growth_pct"),
        average.alias("rolling_4wk_avg"),
        (100.0 * (value / F.nullif(average, F.lit(0.0)) - 1)).alias("vs_4wk_avg_pct"),
    ).orderBy(period)


def weekly_growth(mart: Mart) -> DataFrame:
    return growth(weekly(mart))


def weekly_anomaly(mart: Mart) -> DataFrame:
    return anomaly(weekly(mart))


def weekly_growth_report(mart: Mart, min_periods: int = 4) -> DataFrame:
    return growth_report(weekly(mart), min_periods=min_periods)
