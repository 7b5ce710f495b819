"""Build, store, check and publish the mart."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart import schemas
from txnmart.operators import dims as d
from txnmart.operators import quality
from txnmart.operators.cleaning import typed
from txnmart.operators.fact import Dims, clean_latest, dated, keyed, with_month
from txnmart.session import written
from txnmart.sources.raw import save_table, write_table

TABLES = [
    "fact",
    "quarantine",
    "dim_date",
    "dim_channel",
    "dim_product_category",
    "dim_payment_method",
    "dim_status",
]


@dataclass(frozen=True)
class Mart:
    """The raw rows and the tables modeled from them."""

    raw: DataFrame
    fact: DataFrame
    quarantine: DataFrame
    dim_date: DataFrame
    dim_channel: DataFrame
    dim_product_category: DataFrame
    dim_payment_method: DataFrame
    dim_status: DataFrame
    accounting: DataFrame
    as_of: str | None = None

    @property
    def spark(self) -> SparkSession:
        return self.raw.sparkSession

    def create_views(self) -> None:
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(name)


#: Files of the fact are sorted by the keys that dashboards filter by, fewest values first ...
CLUSTERED = ["status_key", "channel_key", "product_category_key", "date_key"]
#: ... and hold Bloom filters of the ids that single rows are sought by.
LOOKED_UP = ["transaction_id", "customer_id"]


def build_mart(
    raw: DataFrame,
    path: str,
    as_of: str | None = None,
    strict_status: bool = False,
    loaded_at: str | None = None,
    clean: DataFrame | None = None,
) -> Mart:
    """Full refresh of all tables under ``path`` from stored raw rows.

    The only shuffles over all rows are the business-key deduplication, the layout of the
    fact by month, and one of digests of distinct texts for the counts that reports show. Deduplicated
    rows are written once, without their ids, because both the channel dimension and the fact start from them;
    ``clean`` passes in those rows where an incremental load already keeps them.
    """
    spark = raw.sparkSession
    cleaned = typed(raw)

    spans = write_table(d.label_spans(raw, as_of), f"{path}/stage/label_spans")
    if clean is None:
        clean = write_table(clean_latest(cleaned, as_of).drop("raw_row_id"), f"{path}/stage/clean")
    named = d.name_dims(
        d.channel_names(clean)
        .unionByName(d.product_category_names(spans))
        .unionByName(d.payment_method_names(spans))
    )
    dims = Dims(
        date=write_table(d.dim_date(spans), f"{path}/dim_date"),
        status=write_table(d.dim_status(spark), f"{path}/dim_status"),
        **{entity: write_table(dim, f"{path}/dim_{entity}") for entity, dim in named.items()},
    )
    # Rebalancing puts a month's rows together, splits large months and merges small
    # ones, so files are few and of even size. Sorted files let readers skip pages by key.
    fact = dated(with_month(keyed(clean, dims)).hint("rebalance", F.col("month_start")), loaded_at)
    save_table(fact.sortWithinPartitions("month_start", *CLUSTERED), f"{path}/fact", ["month_start"], LOOKED_UP)
    save_table(quality.quarantine(cleaned, as_of, strict_status, loaded_at), f"{path}/quarantine")
    save_table(quality.classified(raw, as_of), f"{path}/accounting")
    return open_mart(raw, path, as_of)


def open_mart(raw: DataFrame, path: str, as_of: str | None = None) -> Mart:
    """The stored tables; nothing is computed."""
    spark = raw.sparkSession

    def table(name: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    return Mart(
        raw=raw,
        fact=table("fact", T.StructType(schemas.FACT.fields + [T.StructField("month_start", T.DateType())])),
        quarantine=table("quarantine", schemas.QUARANTINE),
        dim_date=table("dim_date", schemas.DIM_DATE),
        dim_channel=table("dim_channel", schemas.dim_schema("channel")),
        dim_product_category=table("dim_product_category", schemas.dim_schema("product_category")),
        dim_payment_method=table("dim_payment_method", schemas.dim_schema("payment_method")),
        dim_status=table("dim_status", schemas.dim_schema("status")),
        accounting=table("accounting", schemas.ACCOUNTING),
        as_of=as_of,
    )


def violations(mart: Mart) -> DataFrame:
    """All declared constraints in one frame of (check_name, violations); every count should be 0.

    The fact is read twice: for its unique id, and for one aggregate by all of its keys, which
    is written and serves the key and NULL checks.
    """
    keyed = [("channel", mart.dim_channel), ("product_category", mart.dim_product_category),
             ("payment_method", mart.dim_payment_method), ("status", mart.dim_status)]
    unique = [("fact", mart.fact, ["transaction_id"]), ("dim_date", mart.dim_date, ["date_key"]),
              ("dim_date", mart.dim_date, ["date_actual"])]
    for entity, dim in keyed:
        unique += [(f"dim_{entity}", dim, [f"{entity}_key"]), (f"dim_{entity}", dim, [f"{entity}_name"])]

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")

    parts = [
        counted(quality.duplicate_keys(df, keys), f"duplicate {table}.{','.join(keys)}")
        for table, df, keys in unique
    ]
    keys = [("date_key", mart.dim_date)] + [(f"{entity}_key", dim) for entity, dim in keyed]
    names = [key for key, _ in keys]
    others = [name for name in schemas.FACT.fieldNames() if name not in names]
    missing = [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in others]
    by_keys = written(mart.fact.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"), *missing))
    for key, dim in keys:
        parts.append(counted(quality.orphan_keys(by_keys, dim, key), f"orphan fact.{key}"))
    of_keys = [F.sum(F.when(F.col(name).isNull(), F.col("rows")).otherwise(0)).alias(name) for name in names]
    of_others = [F.sum(f"null_{name}").alias(name) for name in others]
    no_rows = [F.coalesce(name, F.lit(0)).alias(name) for name in schemas.FACT.fieldNames()]
    fact_nulls = by_keys.agg(*of_keys, *of_others).select(*no_rows)
    fact_nulls = fact_nulls.unpivot([], fact_nulls.columns, "column_name", "null_rows")
    date_nulls = quality.null_violations(mart.dim_date, schemas.DIM_DATE.fieldNames())
    for table, nulls in [("fact", fact_nulls), ("dim_date", date_nulls)]:
        parts.append(nulls.select(
            F.concat(F.lit(f"null {table}."), "column_name").alias("check_name"),
            F.col("null_rows").alias("violations"),
        ))
    return reduce(DataFrame.unionByName, parts)
