"""Validate, then publish: readers only ever see a version whose checks passed.

Each attempt builds in a folder of its own. A version becomes current when one row that names
the folder is appended to the publication log, after the declared constraints were found to
hold; so neither a failed nor a repeated attempt touches what readers see.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmart.plans.mart import Mart, build_mart, open_mart, violations

LOG_SCHEMA = "version string, folder string, number long, published_at timestamp"


class ConstraintsViolated(Exception):
    """A built version failed its checks and was not published."""


def publish(
    raw: DataFrame,
    root: str,
    version: str,
    as_of: str | None = None,
    check: Callable[[Mart], DataFrame] | None = None,
) -> Mart:
    """Build ``version`` under ``root``, check it, and make it the current one.

    ``check`` gives (check_name, violations) and defaults to the declared constraints.
    """
    folder = f"{version}-{uuid.uuid4().hex}"
    mart = build_mart(raw, f"{root}/{folder}", as_of)
    failed = (check or violations)(mart).filter("violations > 0").collect()  # at most one row per check
    if failed:
        raise ConstraintsViolated(", ".join(f"{row.check_name}: {row.violations}" for row in failed))
    last = _log(raw.sparkSession, root).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    entry = raw.sparkSession.range(1).select(
        F.lit(version).alias("version"),
        F.lit(folder).alias("folder"),
        F.lit(last + 1).cast("long").alias("number"),
        F.current_timestamp().alias("published_at"),
    )
    entry.write.mode("append").parquet(f"{root}/published")
    return mart


def _log(spark: SparkSession, root: str) -> DataFrame:
    # A first, empty entry lets readers open the log before the first publication.
    spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(f"{root}/published")
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/published")


def _current(spark: SparkSession, root: str, column: str) -> str | None:
    # Numbers follow the order of publication; of two at the same time, the later folder by name.
    order = F.struct("number", "published_at", "folder")
    return _log(spark, root).agg(F.max_by(column, order)).first()[0]


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers see; None before the first publication."""
    return _current(spark, root, "version")


def open_published(raw: DataFrame, root: str, as_of: str | None = None) -> Mart:
    folder = _current(raw.sparkSession, root, "folder")
    if folder is None:
        raise LookupError(f"nothing is published under {root}")
    return open_mart(raw, f"{root}/{folder}", as_of)
