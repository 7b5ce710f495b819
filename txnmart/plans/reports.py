"""Report bundles: the CSV outputs and the stored period aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnmart.operators import metrics, quality
from txnmart.operators.extract import dashboard_extract
from txnmart.plans.mart import Mart
from txnmart.sources.raw import write_csv, write_table


def reports(mart: Mart) -> dict[str, DataFrame]:
    return {
        "weekly_growth": metrics.weekly_growth_report(mart),
        "channel_mix": metrics.channel_mix(mart),
        "product_category_mix": metrics.product_category_mix(mart),
        "dq_summary": quality.dq_summary(mart.accounting, mart.fact, mart.quarantine),
    }


def export_reports(mart: Mart, path: str) -> None:
    """Write each report as CSV under ``path``; small results come out as one part file."""
    for name, report in reports(mart).items():
        write_csv(report, f"{path}/{name}")


def export_extract(mart: Mart, path: str) -> None:
    write_csv(dashboard_extract(mart), f"{path}/clean_transactions")


def materialize_aggregates(mart: Mart, path: str) -> dict[str, DataFrame]:
    """Store the rollups, mixes and key figures for dashboards."""
    aggregates = {
        "weekly": metrics.weekly(mart),
        "monthly": metrics.monthly(mart),
        "channel_mix": metrics.channel_mix(mart),
        "product_category_mix": metrics.product_category_mix(mart),
        "key_figures": metrics.executive_dashboard(mart.fact),
    }
    return {name: write_table(df, f"{path}/{name}") for name, df in aggregates.items()}
