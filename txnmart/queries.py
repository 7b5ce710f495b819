"""Named queries over a directory of parquet tables, one or more per operator.

Results are made portable for comparison with another engine: money as DOUBLE,
counts as BIGINT, dates and timestamps as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart.functions import parse, text
from txnmart.functions.calendar import date_key
from txnmart.operators import dims, extract, fact, metrics, monitoring, profile, quality, synth
from txnmart.operators.cleaning import typed
from txnmart.operators.dedup import dedup_exact, row_texts
from txnmart.plans.mart import Mart, build_mart, violations
from txnmart.plans.publish import ConstraintsViolated, open_published, publish
from txnmart.plans.reports import export_reports, reports
from txnmart.schemas import SOURCE_FIELDS
from txnmart.session import shared_dir, written
from txnmart.sources.raw import land, map_source, missing_as_null, read_raw, read_source, with_load_ts, write_csv, write_table
from txnmart.sources.sample import AS_OF, raw_transactions
from txnmart.streaming import snapshots
from txnmart.streaming.incremental import apply_batch, clean_table, load_new

Query = Callable[[SparkSession, str], DataFrame]

_landed: dict[tuple[str, str], DataFrame] = {}
_marts: dict[tuple[str, str], Mart] = {}
_snapshots: dict[tuple[str, str], snapshots.Snapshot] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared storage."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table of a directory, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        _landed[key] = write_table(raw_transactions(spark, sf_dir), scratch(spark, "raw"))
    return _landed[key]


def mart_for(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart of a directory, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        _marts[key] = build_mart(landed(spark, sf_dir), scratch(spark, "mart"), AS_OF, loaded_at=AS_OF)
    return _marts[key]


def portable(df: DataFrame) -> DataFrame:
    def cast(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[cast(field) for field in df.schema])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(build(landed(spark, sf_dir)))


def _profiled(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_raw(lambda raw: build(missing_as_null(raw)))


def _on_mart(build: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(build(mart_for(spark, sf_dir)))


# --- sources ------------------------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the source rows as CSV and read them back by position."""
    path = scratch(spark, "csv")
    write_csv(landed(spark, sf_dir).select(*SOURCE_FIELDS), path)
    return read_raw(spark, path)


def csv_round_trip_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a line break in a field of every row; records are cut by the parity of quotes."""
    path = scratch(spark, "csv")
    rows = landed(spark, sf_dir).select(*SOURCE_FIELDS)
    write_csv(rows.withColumn("customer_id", F.concat("customer_id", F.lit("\n"), "status")), path)
    return read_raw(spark, path, multiline=True)


def profiling_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source sample as a profile reads it: missing-value texts are NULL."""
    path = scratch(spark, "csv")
    write_csv(landed(spark, sf_dir).select(*SOURCE_FIELDS), path)
    return read_source(spark, path)


def landed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a small first and a large second folder of files, landed together."""
    raw, path = landed(spark, sf_dir), scratch(spark, "csv")
    few = F.col("raw_row_id") % 50 == 0
    for name, rows in (("a", raw.filter(few)), ("b", raw.filter(~few))):
        # Ranges in order: files follow one another by name, and rows within each file.
        in_order = rows.repartitionByRange("raw_row_id").sortWithinPartitions("raw_row_id")
        write_csv(in_order.select(*SOURCE_FIELDS), f"{path}/{name}")
    return land(read_raw(spark, f"{path}/*"), scratch(spark, "landed"), AS_OF).drop("loaded_at")


def load_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per load stamp of the landed table, the fact and the quarantine."""
    mart = mart_for(spark, sf_dir)
    again = land(landed(spark, sf_dir).select(*SOURCE_FIELDS), scratch(spark, "landed"), AS_OF)
    stamped = [("raw", again, "loaded_at"), ("fact", mart.fact, "loaded_at"), ("quarantine", mart.quarantine, "quarantined_at")]
    parts = [df.select(F.lit(table).alias("table_name"), F.col(name).cast("string").alias("stamp")) for table, df, name in stamped]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("table_name", "stamp").agg(F.count(F.lit(1)).alias("row_count"))


def second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as another source, mapped to the canonical fields and appended to the first."""
    c = F.col
    lines = map_source(
        _table(spark, sf_dir, "lineitem"),
        {
            "transaction_id": F.concat_ws("-", F.lit("L"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
            "order_timestamp": c("l_shipdate"),
            "channel": F.lit("Partner"),
            "product_category": "l_returnflag",
            "quantity": c("l_quantity").cast("int"),
            "amount": c("l_extendedprice").cast("decimal(14,2)"),
            "status": F.when(c("l_linestatus") == "F", "completed").otherwise("failed"),
        },
    )
    return lines.unionByName(landed(spark, sf_dir).select(*SOURCE_FIELDS))


def both_sources_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """A mart of both sources: order lines, with ids and customers of their own name space, landed after the first."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/both")
    if key not in _marts:
        c = F.col
        lines = map_source(
            _table(spark, sf_dir, "lineitem"),
            {
                "transaction_id": F.concat_ws("-", F.lit("L"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
                "order_timestamp": c("l_shipdate") + F.expr("INTERVAL 25 YEARS"),
                "channel": F.lit("Partner"),
                "product_category": "l_returnflag",
                "quantity": c("l_quantity").cast("int"),
                "amount": c("l_extendedprice").cast("decimal(14,2)"),
                "payment_method": F.lit("invoice"),
                "customer_id": F.concat(F.lit("S"), c("l_suppkey")),
                "status": F.when(c("l_linestatus") == "F", "completed").otherwise("failed"),
            },
        )
        path = scratch(spark, "raw")
        write_table(with_load_ts(landed(spark, sf_dir), AS_OF), path)
        _marts[key] = build_mart(land(lines, path, AS_OF, append=True), scratch(spark, "mart"), AS_OF, loaded_at=AS_OF)
    return _marts[key]


def second_source_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = both_sources_mart(spark, sf_dir)
    return quality.dq_summary(mart.accounting, mart.fact, mart.quarantine)


# --- cleaning -----------------------------------------------------------------------


def blank_to_null(raw: DataFrame) -> DataFrame:
    names = ["transaction_id", "payment_method", "customer_id"]
    return raw.select("raw_row_id", *[text.blank_to_null(F.col(name)).alias(name) for name in names])


def normalize_channel(raw: DataFrame) -> DataFrame:
    return raw.select("raw_row_id", text.normalize_channel(F.col("channel")).alias("channel_clean"))


def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", text.title_clean(F.col("o_orderpriority")).alias("title"))


def parse_numbers(raw: DataFrame) -> DataFrame:
    return portable(
        raw.select(
            "raw_row_id",
            parse.parse_int(F.col("quantity")).alias("quantity_int"),
            parse.parse_amount(F.col("amount")).alias("amount_num"),
        )
    )


def parse_timestamps(raw: DataFrame) -> DataFrame:
    order_ts = parse.parse_order_ts(F.col("order_timestamp"))
    return raw.select("raw_row_id", order_ts.alias("order_ts"), date_key(order_ts).alias("date_key"))


def normalize_status(raw: DataFrame) -> DataFrame:
    status = text.normalize_status(F.col("status"))
    return raw.select(
        "raw_row_id", status.alias("status_clean"), (status == quality.VALUE_STATUS).alias("is_value_eligible")
    )


# --- rules and deduplication ----------------------------------------------------------


def invalid_reasons(raw: DataFrame) -> DataFrame:
    return quality.validated(typed(raw), AS_OF).select("raw_row_id", "invalid_reason")


def strict_reasons(raw: DataFrame) -> DataFrame:
    checked = quality.validated(typed(raw), AS_OF, strict_status=True)
    return checked.groupBy("invalid_reason").agg(F.count(F.lit(1)).alias("row_count"))


def valid_rows(raw: DataFrame) -> DataFrame:
    return quality.valid(typed(raw), AS_OF).select("raw_row_id", *fact.CLEAN_COLUMNS[1:])


def quarantined(raw: DataFrame) -> DataFrame:
    return quality.quarantine(typed(raw), AS_OF).drop("quarantined_at")


def exact_dedup(raw: DataFrame) -> DataFrame:
    return dedup_exact(row_texts(raw))


def latest_versions(raw: DataFrame) -> DataFrame:
    return fact.clean_latest(typed(raw), AS_OF)


# --- dimensions and fact --------------------------------------------------------------


def dim_status_usage(mart: Mart) -> DataFrame:
    used = mart.fact.groupBy("status_key").agg(F.count(F.lit(1)).alias("fact_rows"))
    joined = mart.dim_status.join(used, "status_key", "left")
    return joined.select("status_key", "status_name", F.coalesce("fact_rows", F.lit(0)).alias("fact_rows"))


def merged_channels(mart: Mart) -> DataFrame:
    """Channel names of the raw rows added to a dimension that holds one of them."""
    labels = mart.raw.select(text.normalize_channel(F.col("channel")).alias("channel_name"))
    known = mart.dim_channel.filter(F.col("channel_name") == "Web")
    return dims.merge_dim(known, labels, "channel")


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders that a dimension without every seventh customer lacks."""
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return quality.orphan_keys(orders, _table(spark, sf_dir, "customer").filter("c_custkey % 7 <> 0"), "c_custkey")


def broken_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of a mart that lacks a channel, repeats facts and misses amounts."""
    mart = mart_for(spark, sf_dir)
    number = F.substring("transaction_id", 2, 20).cast("long")
    fact = mart.fact.withColumn("amount", F.when(number % 9 != 0, F.col("amount")))
    broken = replace(
        mart,
        fact=fact.unionByName(fact.filter(number % 11 == 0)),
        dim_channel=mart.dim_channel.filter("channel_name <> 'Web'"),
        dim_payment_method=mart.dim_payment_method.filter("payment_method_name <> 'card'"),
    )
    return violations(broken).filter("violations > 0")


def published_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact after a second version failed its checks and was refused."""
    raw, root = landed(spark, sf_dir), scratch(spark, "published")
    publish(raw, root, "v1", AS_OF)
    blank = raw.withColumn("amount", F.lit("1.00"))
    try:
        publish(blank, root, "v1", AS_OF, check=lambda mart: violations(replace(mart, dim_status=mart.dim_status.limit(0))))
    except ConstraintsViolated:
        pass
    return open_published(raw, root, AS_OF).fact.select("transaction_id", "order_timestamp", "amount", "is_value_eligible")


def named_fact(mart: Mart) -> DataFrame:
    """The fact with names for keys, comparable between marts that number names differently."""
    rows = mart.fact
    for entity in ("channel", "product_category", "payment_method", "status"):
        rows = rows.join(getattr(mart, f"dim_{entity}"), f"{entity}_key")
    days = mart.dim_date.select("date_key", "date_actual")
    names = ["transaction_id", "date_actual", "channel_name", "product_category_name", "payment_method_name", "status_name"]
    return rows.join(days, "date_key").select(*names, "customer_id", "quantity", "amount")


def _exported(report: str) -> Query:
    """A report as exported and read back by the names of its header."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, mart = scratch(spark, "reports"), mart_for(spark, sf_dir)
        export_reports(mart, path)
        columns = portable(reports(mart)[report]).schema
        return spark.read.schema(columns).option("header", True).option("enforceSchema", False).csv(f"{path}/{report}")

    return read


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def raw_nulls(raw: DataFrame) -> DataFrame:
    return quality.null_violations(raw, SOURCE_FIELDS)


# --- reports --------------------------------------------------------------------------


def filtered_extract(mart: Mart) -> DataFrame:
    rows = extract.apply_filters(
        extract.dashboard_extract(mart),
        start="2023-02-10",
        end="2025-09-20",
        channels=["Web", "Mobile App"],
        categories=["Machinery", "Building", "Furniture"],
        statuses=["completed", "refunded"],
    )
    return rows.groupBy("channel_name", "product_category_name", "status_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("gross_amount")
    )


def customer_extract(mart: Mart) -> DataFrame:
    """Rows of a few customers, chosen on the stored columns of the fact."""
    rows = extract.filtered(
        mart,
        start="2021-03-15",
        end="2025-10-20",
        channels=["Web", "Mobile App"],
        statuses=["completed", "failed"],
        customers=[f"C{number}" for number in range(1, 9)],
    )
    return rows.select("transaction_id", "date_actual", "channel_name", "status_name", "customer_id", "amount")


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome classes of the mart against order records taken as the source system."""
    mart = mart_for(spark, sf_dir)
    c = F.col
    source = _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), c("o_orderkey").cast("string")).alias("transaction_id"),
        F.when(c("o_orderstatus") == "P", "refunded").otherwise("completed").alias("status"),
        c("o_totalprice").cast("decimal(14,2)").alias("amount"),
    )
    matched = monitoring.reconcile(mart.fact, mart.dim_status, source)
    return matched.groupBy("outcome").agg(F.count(F.lit(1)).alias("transactions"))


# --- profile and generator ------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


def all_shares(raw: DataFrame) -> DataFrame:
    parts = [
        profile.value_shares(raw, column).select(
            F.lit(column).alias("attribute"), F.col("value").cast("string").alias("value"), "share"
        )
        for column in profile.PROFILED
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def raw_and_quarantined(mart: Mart) -> DataFrame:
    """Category shares of all source rows beside those of the quarantined rows."""
    return profile.compare_distribution(missing_as_null(mart.raw), missing_as_null(mart.quarantine), "product_category")


def day_weights(mart: Mart) -> DataFrame:
    return synth.weigh_days(mart.dim_date.select(F.col("date_actual").alias("day")))


def synth_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.synth_ids(spark, _table(spark, sf_dir, "orders").count())


def synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many synthetic rows as the source has, profiled from it, plus copies."""
    raw = landed(spark, sf_dir)
    return synth.generate(raw, n=raw.count())


def synth_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = synthetic(spark, sf_dir)
    per_row = rows.groupBy(*SOURCE_FIELDS).agg(F.count(F.lit(1)).alias("copies"))
    return per_row.agg(
        F.sum("copies").alias("rows_including_duplicates"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.max("copies").alias("most_copies"),
    )


def synth_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each label in the source and among the generated rows."""
    raw, rows = missing_as_null(landed(spark, sf_dir)), written(synthetic(spark, sf_dir))
    parts = [
        profile.compare_distribution(raw, rows, column).select(
            F.lit(column).alias("attribute"),
            "value",
            "source_share",
            "synthetic_share",
        )
        for column in ("channel", "product_category", "status", "payment_method")
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def synth_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-normal amount parameters of each category in the source and among the generated rows."""
    fitted = profile.fit_lognormal(missing_as_null(landed(spark, sf_dir)))
    again = profile.fit_lognormal(synthetic(spark, sf_dir)).select(
        "product_category", F.col("log_mean").alias("new_mean"), F.col("log_std").alias("new_std")
    )
    return _rounded(fitted.join(again, "product_category"), "log_mean", "log_std", "new_mean", "new_std")


def injected_issues(raw: DataFrame) -> DataFrame:
    """The raw rows with issues injected."""
    broken = synth.inject_issues(raw, "raw_row_id")
    return broken.select("raw_row_id", "order_timestamp", "channel", "product_category", "amount")


# --- incremental ----------------------------------------------------------------------


def incremental_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table after two batches."""
    root = scratch(spark, "incremental")
    for batch, rows in two_batches(landed(spark, sf_dir)).items():
        apply_batch(rows, batch, f"{root}/clean", f"{root}/quarantine", AS_OF)
    return clean_table(spark, f"{root}/clean").drop("month_start")


def two_batches(raw: DataFrame) -> dict[str, DataFrame]:
    """Raw rows in two parts. The second has new ids, versions that supersede those of the first,
    in other months too, and a category that the first lacks."""
    number = F.col("raw_row_id") % 1_000_000_000_000
    known = F.coalesce(F.col("product_category") != "MACHINERY", F.lit(True))
    first = (number % 13 != 5) & (number % 10 < 8) & known
    return {"first": raw.filter(first), "second": raw.filter(~first)}


def snapshot_for(spark: SparkSession, sf_dir: str) -> snapshots.Snapshot:
    """What is published after two batches, applied once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _snapshots:
        root = scratch(spark, "snapshots")
        for batch, rows in two_batches(landed(spark, sf_dir)).items():
            snapshots.apply(rows, batch, root, AS_OF, AS_OF)
        _snapshots[key] = snapshots.current(spark, root)
    return _snapshots[key]


def snapshot_mart(spark: SparkSession, sf_dir: str) -> Mart:
    return snapshots.open_snapshot(snapshot_for(spark, sf_dir), landed(spark, sf_dir), AS_OF)


def incremental_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = snapshot_mart(spark, sf_dir)
    return quality.row_accounting(mart.accounting, mart.fact)


def incremental_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = snapshot_mart(spark, sf_dir)
    return quality.dq_summary(mart.accounting, mart.fact, mart.quarantine)


def streamed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact after a stream has carried the landed files to the mart, in two runs."""
    root = scratch(spark, "stream")
    for rows in two_batches(landed(spark, sf_dir)).values():
        stamped = rows.withColumn("loaded_at", F.lit(AS_OF).cast("timestamp"))
        stamped.write.mode("append").parquet(f"{root}/landed")
        snapshots.stream(spark, f"{root}/landed", f"{root}/mart", f"{root}/progress", AS_OF, AS_OF)
    return named_fact(snapshots.open_snapshot(snapshots.current(spark, f"{root}/mart"), landed(spark, sf_dir), AS_OF))


def streamed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table after a stream has consumed the landed files, in two runs."""
    root = scratch(spark, "stream")
    for rows in two_batches(landed(spark, sf_dir)).values():
        stamped = rows.withColumn("loaded_at", F.lit(AS_OF).cast("timestamp"))
        stamped.write.mode("append").parquet(f"{root}/landed")
        load_new(spark, f"{root}/landed", f"{root}/clean", f"{root}/quarantine", f"{root}/progress", AS_OF)
    return clean_table(spark, f"{root}/clean").drop("month_start")


QUERIES: dict[str, Query] = {
    # sources
    "raw_transactions": raw_transactions,
    "csv_round_trip": csv_round_trip,
    "csv_round_trip_multiline": csv_round_trip_multiline,
    "profiling_read": profiling_read,
    "landed_ids": landed_ids,
    "load_stamps": load_stamps,
    "second_source": second_source,
    "second_source_fact": lambda spark, sf_dir: portable(named_fact(both_sources_mart(spark, sf_dir))),
    "second_source_dq_summary": lambda spark, sf_dir: portable(second_source_dq_summary(spark, sf_dir)),
    # cleaning
    "blank_to_null": _on_raw(blank_to_null),
    "normalize_channel": _on_raw(normalize_channel),
    "title_case": title_case,
    "parse_numbers": _on_raw(parse_numbers),
    "parse_timestamps": _on_raw(parse_timestamps),
    "normalize_status": _on_raw(normalize_status),
    # rules, deduplication
    "invalid_reasons": _on_raw(invalid_reasons),
    "strict_reasons": _on_raw(strict_reasons),
    "valid_rows": _on_raw(valid_rows),
    "quarantine": _on_raw(quarantined),
    "quarantine_reasons": _on_mart(lambda m: quality.quarantine_reasons(m.quarantine)),
    "dedup_exact": _on_raw(exact_dedup),
    "dedup_latest": _on_raw(latest_versions),
    # dimensions, fact, constraints
    "dim_date": _on_mart(lambda m: m.dim_date),
    "dim_channel": _on_mart(lambda m: m.dim_channel),
    "dim_product_category": _on_mart(lambda m: m.dim_product_category),
    "dim_payment_method": _on_mart(lambda m: m.dim_payment_method),
    "dim_status": _on_mart(dim_status_usage),
    "merge_dim": _on_mart(merged_channels),
    "fact": _on_mart(lambda m: m.fact.drop("loaded_at")),
    "violations": _on_mart(violations),
    "violations_found": broken_mart,
    "published_fact": lambda spark, sf_dir: portable(published_fact(spark, sf_dir)),
    "orphan_keys": orphans,
    "duplicate_keys": lambda spark, sf_dir: portable(duplicates(spark, sf_dir)),
    "null_violations": _on_raw(raw_nulls),
    # accounting
    "load_counts": _on_mart(lambda m: quality.load_counts(m.raw, m.fact, m.quarantine)),
    "dq_summary": _on_mart(lambda m: quality.dq_summary(m.accounting, m.fact, m.quarantine)),
    "row_accounting": _on_mart(lambda m: quality.row_accounting(m.accounting, m.fact)),
    "validate_raw": _on_raw(quality.validate_raw),
    # metrics
    "totals": _on_mart(lambda m: metrics.totals(m.fact)),
    "executive_dashboard": _on_mart(lambda m: metrics.executive_dashboard(m.fact)),
    "status_distribution": _on_mart(metrics.status_distribution),
    "weekly": _on_mart(metrics.weekly),
    "monthly": _on_mart(metrics.monthly),
    "weekly_growth": _on_mart(metrics.weekly_growth),
    "weekly_anomaly": _on_mart(metrics.weekly_anomaly),
    "weekly_growth_report": _on_mart(
        lambda m: _rounded(
            metrics.weekly_growth_report(m), "wow_value_growth_pct", "rolling_4wk_avg", "vs_4wk_avg_pct"
        )
    ),
    "channel_mix": _on_mart(metrics.channel_mix),
    "product_category_mix": _on_mart(metrics.product_category_mix),
    "day_of_week": _on_mart(metrics.day_of_week),
    # extract
    "exported_reports": _exported("channel_mix"),
    "exported_weekly": lambda spark, sf_dir: _rounded(
        _exported("weekly_growth")(spark, sf_dir), "wow_value_growth_pct", "rolling_4wk_avg", "vs_4wk_avg_pct"
    ),
    "exported_category_mix": _exported("product_category_mix"),
    "exported_dq_summary": _exported("dq_summary"),
    "dashboard_extract": _on_mart(extract.dashboard_extract),
    "filtered_extract": _on_mart(filtered_extract),
    "customer_extract": _on_mart(customer_extract),
    # monitoring
    "freshness": _on_mart(lambda m: monitoring.freshness(m.fact, AS_OF)),
    "volume_baseline": _on_mart(monitoring.volume_baseline),
    "daily_monitor": _on_mart(lambda m: monitoring.monitored_metrics(m, "date_actual")),
    "weekly_monitor": _on_mart(lambda m: monitoring.monitored_metrics(m, "week_start")),
    "channel_share_by_week": _on_mart(lambda m: monitoring.share_by_week(m, "channel")),
    "category_share_by_week": _on_mart(lambda m: monitoring.share_by_week(m, "product_category")),
    "reconciliation": reconciliation,
    # profile, generator
    "value_shares": _profiled(all_shares),
    "top_categories": _profiled(lambda raw: profile.top_shares(raw, "product_category")),
    "top_quantities": _profiled(lambda raw: profile.top_shares(raw, "quantity")),
    "fit_lognormal": _profiled(lambda raw: _rounded(profile.fit_lognormal(raw), "log_mean", "log_std")),
    "customer_pool": _profiled(profile.customer_pool),
    "compare_distribution": _on_mart(raw_and_quarantined),
    "day_weights": _on_mart(day_weights),
    "synth_ids": synth_ids,
    "synth_transactions": synthetic,
    "synth_copies": synth_copies,
    "synth_shares": synth_shares,
    "synth_amounts": synth_amounts,
    "inject_issues": _on_raw(injected_issues),
    # incremental
    "incremental_fact": lambda spark, sf_dir: portable(named_fact(snapshot_mart(spark, sf_dir))),
    "incremental_accounting": lambda spark, sf_dir: portable(incremental_accounting(spark, sf_dir)),
    "incremental_dq_summary": lambda spark, sf_dir: portable(incremental_dq_summary(spark, sf_dir)),
    "incremental_quarantine": lambda spark, sf_dir: portable(snapshot_mart(spark, sf_dir).quarantine.drop("quarantined_at")),
    "streamed_fact": lambda spark, sf_dir: portable(streamed_fact(spark, sf_dir)),
    "stored_weekly": lambda spark, sf_dir: portable(snapshots.totals(snapshot_for(spark, sf_dir), "week", "week_start")),
    "stored_monthly": lambda spark, sf_dir: portable(snapshots.totals(snapshot_for(spark, sf_dir), "month", "month_start")),
    "stored_channel_mix": lambda spark, sf_dir: portable(snapshots.stored_mix(snapshot_for(spark, sf_dir), "channel")),
    "stored_category_mix": lambda spark, sf_dir: portable(snapshots.stored_mix(snapshot_for(spark, sf_dir), "product_category")),
    "incremental_clean": lambda spark, sf_dir: portable(incremental_clean(spark, sf_dir)),
    "streamed_clean": lambda spark, sf_dir: portable(streamed_clean(spark, sf_dir)),
}
