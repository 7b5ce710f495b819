"""The whole build: accounting, constraints, scopes, repeatability, publishing, reports."""

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, SMALL, rows_of
from txnmart import schemas
from txnmart.operators import dims, extract, metrics, monitoring, quality
from txnmart.operators.cleaning import typed
from txnmart.plans.mart import TABLES, build_mart, violations
from txnmart.plans.publish import ConstraintsViolated, current_version, open_published, publish
from txnmart.plans.reports import export_extract, export_reports, materialize_aggregates
from txnmart.queries import scratch
from txnmart.sources.raw import write_table
from txnmart.sources.sample import raw_transactions


@pytest.fixture(scope="module")
def mart(spark):
    raw = write_table(raw_transactions(spark, str(SMALL)), scratch(spark, "raw"))
    return build_mart(raw, scratch(spark, "mart"), AS_OF, loaded_at=AS_OF)


def test_every_raw_row_is_accounted_for(mart):
    row = quality.row_accounting(mart.accounting, mart.fact).first()
    assert row.asDict() == {
        "raw_rows": 1512, "exact_duplicate_rows": 12, "quarantined_rows": 120, "rows_without_status": 3,
        "superseded_rows": 97, "fact_rows": 1280}
    assert row.raw_rows == sum(row[1:])
    assert mart.quarantine.count() == row.quarantined_rows


def test_declared_constraints_hold(mart):
    assert violations(mart).filter("violations <> 0").collect() == []


def test_tables_have_the_canonical_schemas(mart):
    def types(schema):
        return [(field.name, field.dataType) for field in schema]

    assert types(mart.fact.drop("month_start").schema) == types(schemas.FACT)
    assert types(mart.quarantine.schema) == types(schemas.QUARANTINE)
    assert types(mart.dim_date.schema) == types(schemas.DIM_DATE)
    mart.create_views()
    for name in TABLES:
        assert mart.spark.table(name).columns == getattr(mart, name).columns


def test_metrics_agree_with_each_other(mart):
    kpi = metrics.executive_dashboard(mart.fact).first()
    for report in (metrics.weekly(mart), metrics.monthly(mart), metrics.channel_mix(mart),
                   metrics.product_category_mix(mart)):
        total = report.agg(F.sum("completed_transactions"), F.sum("completed_units"), F.sum("completed_value")).first()
        assert tuple(total) == tuple(kpi[:3])
    shares = metrics.channel_mix(mart).agg(F.sum("value_share_pct")).first()[0]
    assert abs(shares - 100) <= Decimal("0.03")
    statuses = metrics.status_distribution(mart).agg(F.sum("transactions")).first()[0]
    assert statuses == mart.fact.count()
    assert [row.day_of_week_num for row in metrics.day_of_week(mart).collect()] == [1, 2, 3, 4, 5, 6, 7]


def test_dimension_scopes_differ(raw, spark):
    rows = raw(
        {"channel": "kiosk", "status": "odd", "product_category": "toys", "payment_method": "cash",
         "order_timestamp": "2026-01-01 00:00:00"},
        {"channel": "fax", "order_timestamp": "2026-01-05 00:00:00"},
        {"channel": "web", "order_timestamp": "2026-01-06 00:00:00"},
        {"transaction_id": "T9", "order_timestamp": "2030-01-01 00:00:00", "channel": "app"},
    )
    mart = build_mart(write_table(rows, scratch(spark, "raw")), scratch(spark, "mart"), AS_OF)
    assert rows_of(mart.dim_channel) == [(1, "Web")]  # the superseded and the invalid label get no key
    assert rows_of(mart.dim_product_category) == [(1, "Home"), (2, "Toys")]
    assert rows_of(mart.dim_payment_method) == [(1, "card"), (2, "cash")]
    assert rows_of(mart.dim_status) == [(1, "completed"), (2, "refunded"), (3, "failed")]
    days = mart.dim_date.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(days) == (20260101, 20260106, 6)
    assert rows_of(dims.dim_date(dims.date_span(typed(rows), AS_OF))) == rows_of(mart.dim_date)


def test_empty_input_gives_empty_tables(raw, spark):
    mart = build_mart(write_table(raw({}).limit(0), scratch(spark, "raw")), scratch(spark, "mart"), AS_OF)
    assert [getattr(mart, name).count() for name in TABLES] == [0, 0, 0, 0, 0, 0, 3]
    assert metrics.weekly_growth(mart).collect() == []


def test_rebuild_is_the_same_whatever_the_partitioning(mart, spark):
    again = build_mart(mart.raw.repartition(5), scratch(spark, "mart"), AS_OF, loaded_at=AS_OF)
    for name in TABLES:
        assert rows_of(getattr(again, name)) == rows_of(getattr(mart, name)), name


def test_extract_filters_prune_months(mart):
    wide = extract.dashboard_extract(mart)
    assert wide.count() == mart.fact.count()
    some = extract.apply_filters(wide, start="2024-02-10", end="2024-03-05", channels=["Web"], statuses=["completed"])
    expected = wide.filter("date_actual BETWEEN '2024-02-10' AND '2024-03-05' AND channel_name = 'Web' AND status_name = 'completed'")
    assert rows_of(some) == rows_of(expected) and some.count() > 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_start" in plan
    assert rows_of(extract.apply_filters(wide)) == rows_of(wide)


def scanned(df):
    """Rows that the scans of ``df`` hand on after skipping files, row groups and pages."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(at).metrics().apply("numOutputRows").value() for at in range(leaves.size()))


def test_lookups_skip_row_groups(mart):
    total = scanned(mart.fact.select("customer_id"))
    one = mart.fact.first()
    for column in ("customer_id", "transaction_id"):
        low, high = mart.fact.agg(F.min(column), F.max(column)).first()
        absent = low + "x"  # inside the range of values, so that only a filter of values can tell
        assert low < absent < high
        assert scanned(mart.fact.filter(F.col(column) == absent)) == 0
        found = mart.fact.filter(F.col(column) == one[column])
        assert 0 < scanned(found) < total / 2


def test_filters_on_stored_columns_find_the_same_rows(mart):
    wide = extract.dashboard_extract(mart)
    chosen = {"start": "2022-02-10", "end": "2025-03-05", "channels": ["Web"], "categories": ["Machinery", "none"], "statuses": ["completed"]}
    assert rows_of(extract.filtered(mart, **chosen)) == rows_of(extract.apply_filters(wide, **chosen)) != []
    assert extract.filtered(mart, channels=[]).count() == 0
    customer = mart.fact.first()["customer_id"]
    assert rows_of(extract.filtered(mart, customers=[customer])) == rows_of(wide.filter(F.col("customer_id") == customer))


def test_a_metric_reads_only_its_columns(mart):
    plan = metrics.channel_mix(mart)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<channel_key:bigint,quantity:int,amount:decimal(14,2),is_value_eligible:boolean>" in plan


def test_monitoring(mart):
    row = monitoring.freshness(mart.fact, AS_OF, min_rows=1, max_rows=10).first()
    assert (row.row_count, row.row_count_ok, row.is_fresh) == (1280, False, True)
    assert not monitoring.freshness(mart.fact, "2027-01-01 00:00:00").first().is_fresh
    weekly = monitoring.monitored_metrics(mart).agg(F.sum("completed_value"), F.sum("transactions")).first()
    assert tuple(weekly) == (metrics.totals(mart.fact).first().completed_transaction_value, 1280)


def test_reconciliation_classes(mart, spark):
    names = mart.fact.join(mart.dim_status, "status_key").select("transaction_id", F.col("status_name").alias("status"), "amount")
    same = monitoring.reconcile(mart.fact, mart.dim_status, names.unionByName(names))
    assert rows_of(same.groupBy("outcome").count()) == [("matched", 1280)]
    first, second, third = names.orderBy("transaction_id").limit(3).collect()
    c = F.col
    changed = names.filter(c("transaction_id") != first.transaction_id).select(
        "transaction_id",
        F.when(c("transaction_id") == second.transaction_id, "odd").otherwise(c("status")).alias("status"),
        F.when(c("transaction_id") == third.transaction_id, c("amount") + 1).otherwise(c("amount")).alias("amount"),
    ).unionByName(spark.createDataFrame([("ZZ", "failed", Decimal("1.00"))], "transaction_id string, status string, amount decimal(15,2)"))
    got = monitoring.reconcile(mart.fact, mart.dim_status, changed).groupBy("outcome").count()
    assert dict(rows_of(got)) == {
        "matched": 1277, "missing in source": 1, "status differs": 1, "amount differs": 1, "missing in mart": 1}


def test_publishing_moves_only_to_a_checked_version(spark, raw):
    root = scratch(spark, "published")
    one = write_table(raw({}), scratch(spark, "raw"))
    assert current_version(spark, root) is None
    with pytest.raises(LookupError):
        open_published(one, root, AS_OF)
    publish(one, root, "v1", AS_OF)
    two = write_table(raw({"transaction_id": "T1"}, {"transaction_id": "T2"}), scratch(spark, "raw"))

    def same_day(mart):
        return violations(replace(mart, dim_date=mart.dim_date.unionByName(mart.dim_date)))

    for version in ("v2", "v1"):
        with pytest.raises(ConstraintsViolated, match="duplicate dim_date.date_key: 1"):
            publish(two, root, version, AS_OF, check=same_day)
        assert current_version(spark, root) == "v1"
        assert open_published(one, root, AS_OF).fact.count() == 1
    publish(two, root, "v1", AS_OF)
    assert open_published(one, root, AS_OF).fact.count() == 2


def test_reconciliation_of_rows_without_id(mart, spark):
    """A third of the source has no id; those rows are missing in the mart, one per status and amount."""
    names = mart.fact.join(mart.dim_status, "status_key").select("transaction_id", F.col("status_name").alias("status"), "amount")
    lost = spark.range(640).select(F.lit(None).cast("string").alias("transaction_id"), F.lit("failed").alias("status"), (F.col("id") % 5).cast("decimal(14,2)").alias("amount"))
    got = monitoring.reconcile(mart.fact, mart.dim_status, names.unionByName(lost))
    assert dict(rows_of(got.groupBy("outcome").count())) == {"matched": 1280, "missing in mart": 5}
    assert rows_of(got.filter("transaction_id IS NULL").agg(F.sum("source_rows"))) == [(640,)]


def test_a_mix_scans_the_fact_once(mart, spark):
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    for found in (metrics.channel_mix(mart), metrics.product_category_mix(mart)):
        found.collect()
        plan = found._jdf.queryExecution().explainString(formatted).split("== Initial Plan ==")
        assert any("ReusedExchange" in line for line in "".join(plan).splitlines())


def test_report_files(mart, spark, tmp_path):
    export_reports(mart, str(tmp_path))
    summary = spark.read.csv(str(tmp_path / "dq_summary"), header=True)
    assert {row.metric: float(row.value) for row in summary.collect()}["clean_modeled_transactions"] == 1280
    mix = spark.read.csv(str(tmp_path / "channel_mix"), header=True)
    assert mix.columns == ["channel_name", "completed_transactions", "completed_units", "completed_value", "value_share_pct"]
    assert spark.read.csv(str(tmp_path / "weekly_growth"), header=True).count() == metrics.weekly(mart).count()
    export_extract(mart, str(tmp_path))
    assert spark.read.csv(str(tmp_path / "clean_transactions"), header=True).count() == 1280
    stored = materialize_aggregates(mart, str(tmp_path / "aggregates"))
    assert rows_of(stored["monthly"]) == rows_of(metrics.monthly(mart))
