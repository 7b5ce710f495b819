"""Exact and business-key deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnmart.operators.cleaning import ROW_TEXTS
from txnmart.session import written

#: Keys are counted by so many hash buckets ...
BUCKETS = 1 << 16
#: ... and one with more rows than this, and than four times the mean, may hold a hot key.
CROWDED = 5_000


def dedup_exact(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per distinct source text, with the lowest ``raw_row_id`` and the number of copies.

    ``carry`` names columns that are functions of the row texts. A grouped minimum
    combines copies before the shuffle, so a huge group of copies costs one row per
    task; a ranking window would send them all to one.
    """
    return df.groupBy(*ROW_TEXTS, *carry).agg(
        F.min("raw_row_id").alias("raw_row_id"), F.count(F.lit(1)).alias("copies")
    )


def row_texts(raw: DataFrame) -> DataFrame:
    """The columns `dedup_exact` needs, straight from raw rows."""
    return raw.select(
        "raw_row_id",
        F.col("transaction_id").alias("transaction_id_raw"),
        *[name for name in ROW_TEXTS if name not in ("transaction_id_raw", "customer_id")],
        F.nullif(F.trim("customer_id"), F.lit("")).alias("customer_id"),
    )


def text_digest() -> Column:
    """16 bytes that stand for the source texts of a typed row: the first half of their SHA-256.

    Texts carry their lengths and NULL has a mark of its own, so only equal rows spell the same. Grouping by
    this moves and holds a fraction of what the texts take.
    """
    spelled = [F.coalesce(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name), F.lit("-")) for name in ROW_TEXTS]
    return F.substring(F.unhex(F.sha2(F.concat(*spelled), 256)), 1, 16)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    order: Sequence[str] = ("order_ts", "raw_row_id"),
    counted: DataFrame | None = None,
) -> DataFrame:
    """Keep the greatest row per key by ``order``.

    Rows are shuffled as they are and ranked after that, where partitions are small; ranking all rows of
    a scan task first would sort, and spill, as many rows as its split holds. Only the rows of hot keys are ranked within
    each task before the shuffle (WindowGroupLimit), so such a key sends at most one row per
    task. One narrow pass over ``df``, or over a cheaper ``counted`` that holds its keys, finds those.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(name) for name in order])

    def newest(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")

    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    counts = written((df if counted is None else counted).groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows")))
    least = max(CROWDED, 4 * (counts.agg(F.sum("_rows")).first()[0] or 0) // BUCKETS)
    # At most a quarter of the buckets.
    hot = counts.filter(F.col("_rows") > least).select("_bucket")
    if hot.isEmpty():
        return newest(df.repartition(*keys))
    marked, hot = df.withColumn("_bucket", bucket), F.broadcast(hot)
    crowded = marked.join(hot, "_bucket", "left_semi").drop("_bucket")
    others = marked.join(hot, "_bucket", "left_anti").drop("_bucket")
    return newest(crowded).unionByName(newest(others.repartition(*keys)))
