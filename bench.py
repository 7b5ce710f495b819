"""Time the headline jobs and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) selects the tables, BENCH_CPUS the cores.
A run over a smaller directory first takes class loading and compilation out of the
figures. Results go to the no-op sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart import queries
from txnmart.operators import synth
from txnmart.operators.joins import lookup
from txnmart.plans.mart import build_mart
from txnmart.session import local_session, release
from txnmart.sources.raw import land as land_table
from txnmart.sources.sample import AS_OF

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
SYNTHETIC_ROWS = int(os.environ.get("BENCH_SYNTHETIC_ROWS", "1000000"))

HEADLINES = [
    "valid_rows",
    "quarantine",
    "dedup_exact",
    "dedup_latest",
    "quarantine_reasons",
    "load_counts",
    "dq_summary",
    "row_accounting",
    "validate_raw",
    "totals",
    "executive_dashboard",
    "status_distribution",
    "weekly_growth",
    "weekly_anomaly",
    "weekly_growth_report",
    "channel_mix",
    "product_category_mix",
    "day_of_week",
    "dashboard_extract",
    "filtered_extract",
    "value_shares",
    "fit_lognormal",
    "compare_distribution",
    "violations",
    "daily_monitor",
    "channel_share_by_week",
    "reconciliation",
    "incremental_fact",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(spark, sf_dir: str, synthetic_rows: int) -> dict[str, Callable[[], object]]:
    """The timed jobs in order; the mart is built by the second and read by the later ones."""

    def land() -> None:
        queries.landed(spark, sf_dir)

    def build() -> None:
        queries.mart_for(spark, sf_dir)

    generated = queries.scratch(spark, "generated")

    def generate() -> None:
        land_table(synth.generate(queries.landed(spark, sf_dir), n=synthetic_rows), generated)

    def load_generated() -> None:
        build_mart(spark.read.parquet(generated), queries.scratch(spark, "mart"), AS_OF)

    def skewed_lookup() -> None:
        # A third of the rows share a label; the dimension counts as too large for a broadcast.
        rows = spark.range(synthetic_rows).withColumn("label", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
        names = spark.range(synthetic_rows).select(F.col("id").cast("string").alias("name"), F.col("id").alias("key"))
        dim = names.unionByName(spark.sql("SELECT 'hot' AS name, -1L AS key"))
        run(lookup(rows, dim, {"label": "name"}, size=1, max_bytes=0))

    todo: dict[str, Callable[[], object]] = {"land_raw": land, "build_mart": build}
    for name in HEADLINES:
        todo[name] = lambda name=name: run(queries.QUERIES[name](spark, sf_dir))
    todo["skewed_lookup"] = skewed_lookup
    todo["generate"] = generate
    todo["load_generated"] = load_generated
    return todo


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS), memory=os.environ.get("BENCH_MEMORY", "8g"))
    if os.path.isdir(WARM_DIR):
        for job in jobs(spark, WARM_DIR, 1000).values():
            job()
    timings: dict[str, float] = {}
    for name, job in jobs(spark, SF_DIR, SYNTHETIC_ROWS).items():
        start = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "synthetic_rows": SYNTHETIC_ROWS,
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
