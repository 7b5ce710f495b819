"""Freshness, business-metric monitoring and source reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnmart.operators.metrics import completed_measures, ratio_pct
from txnmart.operators.quality import STATUSES, latest_allowed
from txnmart.plans.mart import Mart


def freshness(
    fact: DataFrame,
    as_of: str | None,
    min_rows: int = 1,
    max_rows: int | None = None,
    max_age_hours: int = 24,
) -> DataFrame:
    """Row count against its expected range and age of the latest transaction, one row."""
    now = latest_allowed(as_of) - F.expr("INTERVAL 1 DAY")
    seen = fact.agg(F.count(F.lit(1)).alias("row_count"), F.max("order_timestamp").alias("latest_timestamp"))
    count_ok = F.col("row_count") >= min_rows
    if max_rows is not None:
        count_ok = count_ok & (F.col("row_count") <= max_rows)
    oldest_fresh = now - F.make_dt_interval(hours=F.lit(max_age_hours))
    recent = F.coalesce(F.col("latest_timestamp") >= oldest_fresh, F.lit(False))
    return seen.select("row_count", "latest_timestamp", count_ok.alias("row_count_ok"), recent.alias("is_fresh"))


def _median(values: Column) -> Column:
    """Median of an array of doubles; NULL if it is empty."""
    ordered, size = F.array_sort(values), F.size(values)
    return (F.get(ordered, F.floor((size - 1) / 2).cast("int")) + F.get(ordered, F.floor(size / 2).cast("int"))) / 2


def volume_baseline(mart: Mart, days: int = 8, least: int = 4, width: float = 3.0) -> DataFrame:
    """Transactions of each calendar day against the range that its weekday's history lets expect.

    The range is the median of the last ``days`` same weekdays, give or take ``width`` spreads. A spread is
    the scaled median absolute deviation, which single outliers don't move, and at least the square root of
    the median, as counts scatter that much by chance. Days without transactions count as zero; with
    fewer than ``least`` days of history nothing is expected. Windows are bounded by the calendar.
    """
    counts = mart.fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("row_count"))
    daily = mart.dim_date.select("date_key", "date_actual", "day_of_week_num").join(counts, "date_key", "left")
    daily = daily.withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    before = Window.partitionBy("day_of_week_num").orderBy("date_actual").rowsBetween(-days, -1)
    seen = daily.withColumn("_history", F.collect_list(F.col("row_count").cast("double")).over(before))
    rated = seen.withColumn("typical_rows", F.when(F.size("_history") >= least, _median(F.col("_history"))))
    apart = F.transform("_history", lambda n: F.abs(n - F.col("typical_rows")))
    spread = F.greatest(F.lit(1.4826) * _median(apart), F.sqrt("typical_rows"))
    rated = rated.withColumn("_spread", F.when(F.col("typical_rows").isNotNull(), spread))
    low = F.when(F.col("_spread").isNotNull(), F.greatest(F.col("typical_rows") - width * F.col("_spread"), F.lit(0.0)))
    high = F.col("typical_rows") + width * F.col("_spread")
    volume = F.when(F.col("row_count") < low, "low").when(F.col("row_count") > high, "high")
    return rated.select(
        "date_actual",
        "row_count",
        F.size("_history").cast("long").alias("days_seen"),
        "typical_rows",
        F.round(low, 6).alias("expected_low"),
        F.round(high, 6).alias("expected_high"),
        volume.when(F.col("typical_rows").isNotNull(), "expected").otherwise("no history").alias("volume"),
    )


def monitored_metrics(mart: Mart, period: str = "week_start") -> DataFrame:
    """Value, order value, refund rate and failure rate per day or week, each with its change.

    Changes are against the previous period present: in percent for value and order value, in
    percentage points for the rates.

    ``period`` is ``"date_actual"`` or ``"week_start"``. One row per calendar period, so
    the window over all periods is bounded.
    """
    by_day = mart.fact.groupBy("date_key", "status_key").agg(
        *completed_measures(), F.count(F.lit(1)).alias("transactions")
    )
    days = mart.dim_date.select("date_key", F.col(period).alias("period"))

    def of_status(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status_name") == status, F.col("transactions"))), F.lit(0))

    _completed, refunded, failed = STATUSES
    everything = F.sum("transactions").cast("decimal(20,0)")
    value, orders = F.sum("completed_value").cast("decimal(24,2)"), F.sum("completed_transactions")
    per_period = (
        by_day.join(F.broadcast(days), "date_key")
        .join(F.broadcast(mart.dim_status), "status_key")  # three rows
        .groupBy("period")
        .agg(
            F.sum("transactions").alias("transactions"),
            value.alias("completed_value"),
            F.round(value / F.nullif(orders, F.lit(0)), 2).cast("decimal(18,2)").alias("avg_order_value"),
            ratio_pct(of_status(refunded).cast("decimal(20,0)"), everything).alias("refund_rate_pct"),
            ratio_pct(of_status(failed).cast("decimal(20,0)"), everything).alias("failed_rate_pct"),
        )
    )
    def before(name: str) -> Column:
        return F.lag(name).over(Window.orderBy("period"))

    def change_pct(name: str) -> Column:
        return ratio_pct(F.col(name) - before(name), before(name))

    def points(name: str) -> Column:
        return F.round(F.col(name) - before(name), 2)

    return per_period.select(
        "*",
        change_pct("completed_value").alias("value_change_pct"),
        change_pct("avg_order_value").alias("order_value_change_pct"),
        points("refund_rate_pct").alias("refund_rate_change"),
        points("failed_rate_pct").alias("failed_rate_change"),
    ).orderBy("period")


def share_by_week(mart: Mart, entity: str) -> DataFrame:
    """Share of completed value of each channel or category within each week, and its change.

    The change is in percentage points against the label's previous week present; the window
    of a label is bounded by the calendar.

    Week totals come from a second, tiny aggregate rather than a window, so no task
    holds all labels of a week.
    """
    by_day = mart.fact.groupBy("date_key", f"{entity}_key").agg(*completed_measures())
    days = mart.dim_date.select("date_key", "week_start")
    by_week = (
        by_day.join(F.broadcast(days), "date_key")
        .groupBy("week_start", f"{entity}_key")
        .agg(F.sum("completed_value").cast("decimal(24,2)").alias("completed_value"))
    )
    weeks = by_week.groupBy("week_start").agg(F.sum("completed_value").alias("week_value"))
    shares = (
        by_week.join(F.broadcast(weeks), "week_start")  # one row per calendar week
        .join(getattr(mart, f"dim_{entity}"), f"{entity}_key")
        .select(
            "week_start",
            f"{entity}_name",
            "completed_value",
            ratio_pct(F.col("completed_value"), F.col("week_value")).alias("value_share_pct"),
        )
    )
    previous = F.lag("value_share_pct").over(Window.partitionBy(f"{entity}_name").orderBy("week_start"))
    return shares.withColumn("share_change", F.round(F.col("value_share_pct") - previous, 2))


def reconcile(fact: DataFrame, dim_status: DataFrame, source: DataFrame) -> DataFrame:
    """Compare the mart with another system's (transaction_id, status, amount).

    One row per id and outcome class: ``matched``, ``missing in mart``, ``missing in
    source``, ``status differs`` or ``amount differs``. Repeated source rows are
    combined first, so a heavily repeated id is one row before the join. Rows without an id
    match nothing; they skip the join, where they would all meet one task.
    """
    ours = fact.join(F.broadcast(dim_status), "status_key").select(
        "transaction_id", F.col("status_name").alias("mart_status"), F.col("amount").alias("mart_amount")
    )
    theirs = source.groupBy("transaction_id", "status", "amount").agg(F.count(F.lit(1)).alias("source_rows"))
    theirs = theirs.select(
        "transaction_id",
        F.col("status").alias("source_status"),
        F.col("amount").cast("decimal(14,2)").alias("source_amount"),
        "source_rows",
    )
    outcome = (
        F.when(F.col("mart_status").isNull(), "missing in mart")
        .when(F.col("source_rows").isNull(), "missing in source")
        .when(~F.col("mart_status").eqNullSafe(F.col("source_status")), "status differs")
        .when(~F.col("mart_amount").eqNullSafe(F.col("source_amount")), "amount differs")
        .otherwise("matched")
    )
    known = F.col("transaction_id").isNotNull()
    joined = ours.filter(known).join(theirs.filter(known), "transaction_id", "full_outer")
    unnamed = theirs.filter(~known).unionByName(ours.filter(~known), allowMissingColumns=True)
    return joined.unionByName(unnamed.select(joined.columns)).withColumn("outcome", outcome)
