"""A mart that grows by batches, each published as one snapshot.

Tables are kept in parts: the fact by month, and three tables by hash bucket: the newest version of each
transaction id, the copies of each distinct source text, and the quarantined texts. A snapshot is one entry of a log that names
the folder of every part. A batch reads only the buckets its ids and texts fall into and only the months
that change, writes new folders for them, checks these, and appends one entry; so its cost follows the
batch, and a batch that fails at any point leaves all that readers see as it was. The entry
records the batch's name, by which a batch that is sent again is recognised.

Stored totals by week, month, channel and category are kept up by signed changes: rows that enter the fact count
once, versions they supersede count as minus one. Accounting is kept up likewise: a text already known from another batch is a copy.

One writer at a time is assumed. Folders that no entry names are left by failed attempts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart.functions.calendar import month_start
from txnmart.operators.cleaning import typed
from txnmart.operators.dedup import text_digest
from txnmart.operators.dims import (
    NAMED,
    channel_names,
    dim_date,
    dim_status,
    label_spans,
    merge_dim,
    payment_method_names,
    product_category_names,
)
from txnmart.operators.fact import Dims, build_fact, clean_latest
from txnmart.operators.metrics import ratio_pct
from txnmart.operators.quality import acceptable, invalid_reason, rules
from txnmart.plans.mart import Mart, violations
from txnmart.plans.publish import ConstraintsViolated
from txnmart.schemas import ACCOUNTING, DIM_DATE, FACT, QUARANTINE, RAW, dim_schema
from txnmart.session import written
from txnmart.sources.raw import instant

BUCKETS = 64
LOG = "number long, batch string, buckets int, published_at timestamp, parts map<string,string>"
VERSIONS = "transaction_id string, order_ts timestamp_ntz, raw_row_id long"
COPIES = "digest binary, copies long, kind byte"
#: Kinds of source texts in `COPIES`.
QUARANTINED, WITHOUT_STATUS, VALID = range(3)
TOTALS = "grain string, key string, rows long, completed long, units long, value decimal(38,2)"
WHOLE = "whole"
_SCHEMAS = {
    "fact": FACT,
    "versions": VERSIONS,
    "copies": COPIES,
    "quarantine": T.StructType([*QUARANTINE.fields, T.StructField("digest", T.BinaryType())]),
    "totals": TOTALS,
    "accounting": ACCOUNTING,
    "dim_date": DIM_DATE,
    "dim_status": dim_schema("status"),
    **{f"dim_{entity}": dim_schema(entity) for entity in NAMED},
}


@dataclass(frozen=True)
class Snapshot:
    """What one entry of the log names: for each part of each table, ``table/part``, its folder."""

    spark: SparkSession
    root: str
    number: int = 0
    buckets: int = BUCKETS
    parts: dict[str, str] = field(default_factory=dict)

    def keys(self, table: str) -> set[str]:
        return {name.split("/", 1)[1] for name in self.parts if name.startswith(f"{table}/")}

    def read(self, table: str, keys: Iterable[str] | None = None) -> DataFrame:
        """The table, or only its parts ``keys``: other folders are not opened."""
        wanted = self.keys(table) if keys is None else self.keys(table) & set(keys)
        folders = [f"{self.root}/{self.parts[f'{table}/{key}']}" for key in sorted(wanted)]
        if not folders:
            return _empty(self.spark, _SCHEMAS[table])
        return self.spark.read.schema(_SCHEMAS[table]).parquet(*folders)


def _empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows, known as such to the optimizer: joins and unions with it, and their shuffles, go."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [F.lit(None).cast(own.dataType).alias(own.name) for own in fields.fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


def _log(spark: SparkSession, root: str) -> DataFrame:
    # A first, empty entry lets readers open the log before the first batch.
    spark.createDataFrame([], LOG).write.mode("ignore").parquet(f"{root}/log")
    return spark.read.schema(LOG).parquet(f"{root}/log")


def current(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Snapshot:
    """The newest snapshot; an empty one before the first batch. The number of buckets stays that of the first batch."""
    entry = _log(spark, root).agg(F.max_by(F.struct("number", "buckets", "parts"), "number")).first()[0]
    return Snapshot(spark, root, entry["number"], entry["buckets"], entry["parts"]) if entry else Snapshot(spark, root, buckets=buckets)


def applied(spark: SparkSession, root: str, batch: str) -> bool:
    return not _log(spark, root).filter(F.col("batch") == batch).isEmpty()


def open_snapshot(snapshot: Snapshot, raw: DataFrame, as_of: str | None = None, months: Iterable[str] | None = None) -> Mart:
    """The tables of a snapshot as a mart; of the fact only ``months``, if given."""
    fact = snapshot.read("fact", months)
    return Mart(
        raw=raw,
        fact=fact.withColumn("month_start", month_start(F.col("order_timestamp"))),
        quarantine=snapshot.read("quarantine").drop("digest"),
        accounting=snapshot.read("accounting"),
        as_of=as_of,
        **{name: snapshot.read(name) for name in ("dim_date", "dim_status", *(f"dim_{entity}" for entity in NAMED))},
    )


class _Attempt:
    """New parts of one attempt at a batch, in folders of its own."""

    def __init__(self, base: Snapshot, batch: str):
        self.base, self.folder = base, f"data/{batch}-{uuid.uuid4().hex}"
        self.parts = dict(base.parts)

    def put(self, table: str, rows: DataFrame, part: Column | None = None, replaced: Iterable[str] = ()) -> DataFrame:
        """Write the parts of ``rows``, whole tables without ``part``; parts in ``replaced`` without rows go."""
        rows = rows.withColumn("part", F.lit(WHOLE) if part is None else part.cast("string"))
        if part is not None:
            rows = rows.hint("rebalance", F.col("part"))
        return self.put_parts(table, rows, [WHOLE] if part is None else replaced)

    def put_parts(self, table: str, rows: DataFrame, replaced: Iterable[str] = ()) -> DataFrame:
        """Write rows that name their ``part`` and lie together by it."""
        folder = f"{self.folder}/{table}"
        rows.write.partitionBy("part").parquet(f"{self.base.root}/{folder}")
        for key in replaced:
            self.parts.pop(f"{table}/{key}", None)
        # One row for each bucket or month.
        stored = self.base.spark.read.schema("part string").parquet(f"{self.base.root}/{folder}")
        for row in stored.distinct().collect():
            self.parts[f"{table}/{row['part']}"] = f"{folder}/part={row['part']}"
        return self.snapshot().read(table)

    def snapshot(self) -> Snapshot:
        return Snapshot(self.base.spark, self.base.root, self.base.number + 1, self.base.buckets, self.parts)


def _bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("string")


def _distinct(df: DataFrame, column: Column) -> list[str]:
    """Distinct values of a bucket or month: a bounded number."""
    return sorted(row[0] for row in df.select(column.cast("string")).distinct().collect() if row[0] is not None)


def _put_versions(attempt: _Attempt, incoming: DataFrame) -> DataFrame:
    """Incoming rows that are newer than the known version of their id, with that version's month.

    Only the buckets of the incoming ids are read, and only those with newer rows are written.
    """
    base = attempt.base
    bucket = _bucket("transaction_id", base.buckets)
    columns = ["transaction_id", "order_ts", "raw_row_id"]
    if not base.keys("versions"):
        attempt.put("versions", incoming.select(*columns), bucket)
        return incoming.withColumn("_old_month", F.lit(None).cast("date"))
    known = base.read("versions", _distinct(incoming, bucket))
    old = known.select("transaction_id", F.struct("order_ts", "raw_row_id").alias("_old"))
    both = incoming.join(old, "transaction_id", "left")
    newer = both.filter(F.col("_old").isNull() | (F.struct("order_ts", "raw_row_id") > F.col("_old")))
    winners = written(newer.withColumn("_old_month", month_start(F.col("_old.order_ts"))).drop("_old"))
    touched = _distinct(winners, bucket)
    kept = base.read("versions", touched).join(winners, "transaction_id", "left_anti")
    attempt.put("versions", kept.select(*columns).unionByName(winners.select(*columns)), bucket)
    return winners


def _put_dims(attempt: _Attempt, raw: DataFrame, winners: DataFrame, as_of: str | None) -> Dims:
    """Known names keep their keys, new ones get keys after them; the calendar grows to the batch's days."""
    base, spans = attempt.base, written(label_spans(raw, as_of))
    names = channel_names(winners).unionByName(product_category_names(spans)).unionByName(payment_method_names(spans))
    names, merged = written(names), {}
    for entity in NAMED:
        own = names.filter(F.col("entity") == entity).select(F.col("name").alias(f"{entity}_name"))
        merged[entity] = attempt.put(f"dim_{entity}", merge_dim(base.read(f"dim_{entity}"), own, entity))
    days = base.read("dim_date").agg(F.min("date_actual").alias("min_date"), F.max("date_actual").alias("max_date"))
    calendar = dim_date(days.unionByName(spans.select("min_date", "max_date")))
    return Dims(date=attempt.put("dim_date", calendar), status=attempt.put("dim_status", dim_status(base.spark)), **merged)


def _put_fact(attempt: _Attempt, winners: DataFrame, dims: Dims, loaded_at: str | None) -> list[str]:
    """Replace the months that winners enter or leave; stored totals follow. Returns those months."""
    base = attempt.base
    months = sorted({*_distinct(winners, month_start(F.col("order_ts"))), *_distinct(winners, F.col("_old_month"))})
    added = written(build_fact(winners, dims, loaded_at))
    before = base.read("fact", months)
    gone = winners.filter(F.col("_old_month").isNotNull()).select("transaction_id")
    stays = before.join(gone, "transaction_id", "left_anti")
    attempt.put("fact", stays.unionByName(added), month_start(F.col("order_timestamp")), months)
    left = before.join(gone, "transaction_id", "left_semi")
    changes = added.withColumn("_sign", F.lit(1)).unionByName(left.withColumn("_sign", F.lit(-1)))
    attempt.put("totals", _merged_totals(base.read("totals"), changes))
    return months


def _merged_totals(known: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored totals plus signed rows of the fact; a key whose rows are all gone has no total."""
    day = F.col("order_timestamp").cast("date")
    grains = {"week": F.trunc(day, "week"), "month": F.trunc(day, "month"), "channel": F.col("channel_key"), "product_category": F.col("product_category_key")}
    done = F.when(F.col("is_value_eligible"), F.col("_sign")).otherwise(0)
    each = changes.groupBy(*[key.alias(f"_{grain}") for grain, key in grains.items()]).agg(
        F.sum("_sign").alias("rows"),
        F.sum(done).alias("completed"),
        F.sum(done * F.col("quantity")).alias("units"),
        F.sum(done * F.col("amount")).cast("decimal(38,2)").alias("value"),
    )
    keys = F.inline(F.array(*[F.struct(F.lit(grain).alias("grain"), F.col(f"_{grain}").cast("string").alias("key")) for grain in grains]))
    signed = each.select(keys, "rows", "completed", "units", "value")
    sums = [F.sum(name).alias(name) for name in ("rows", "completed", "units")]
    both = known.unionByName(signed).groupBy("grain", "key").agg(*sums, F.sum("value").cast("decimal(38,2)").alias("value"))
    return both.filter("rows <> 0")


def totals(snapshot: Snapshot, grain: str, key: str) -> DataFrame:
    """Stored totals of one grain (``week``, ``month``, ``channel`` or ``product_category``): the key, count, units and value.

    As in the reports, units and value of a key without completed transactions are NULL.
    """
    some = F.col("completed") > 0
    return snapshot.read("totals").filter(F.col("grain") == grain).select(
        F.col("key").alias(key),
        F.col("completed").alias("completed_transactions"),
        F.when(some, F.col("units")).alias("completed_units"),
        F.when(some, F.col("value")).cast("decimal(24,2)").alias("completed_value"),
    )


def stored_mix(snapshot: Snapshot, entity: str) -> DataFrame:
    """Stored totals of ``channel`` or ``product_category`` by name, with shares of the value."""
    by_key = totals(snapshot, entity, f"{entity}_key").withColumn(f"{entity}_key", F.col(f"{entity}_key").cast("long"))
    total = by_key.agg(F.sum("completed_value")).scalar()
    named = by_key.join(snapshot.read(f"dim_{entity}"), f"{entity}_key")
    share = ratio_pct(F.col("completed_value"), total).alias("value_share_pct")
    columns = [f"{entity}_name", "completed_transactions", "completed_units", "completed_value"]
    return named.select(*columns, share).orderBy(F.desc_nulls_first("completed_value"), f"{entity}_name")


def _put_accounting(attempt: _Attempt, raw: DataFrame, as_of: str | None, loaded_at: str | None) -> None:
    """Merge the batch's distinct texts into the known ones, by their digests; quarantine and counts follow.

    Whole texts are moved of quarantined rows only.
    """
    base = attempt.base
    ok = F.coalesce(acceptable(as_of), F.lit(False))
    kind = F.when(~ok, QUARANTINED).when(F.col("status_clean").isNull(), WITHOUT_STATUS).otherwise(VALID).cast("byte")
    bucket = _bucket("digest", base.buckets)
    rows = typed(raw).select(text_digest().alias("digest"), kind.alias("kind"))
    batch = written(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("kind").alias("kind")))
    touched = _distinct(batch, bucket)
    known = base.read("copies", touched)
    both = known.withColumn("_known", F.lit(1)).unionByName(batch.withColumn("_known", F.lit(0)))
    # All of a bucket in one task: the digests are grouped where they are written.
    merged = both.withColumn("part", bucket).repartition("part").groupBy("part", "digest").agg(
        F.sum("copies").alias("copies"), F.coalesce(F.min(F.when(F.col("_known") == 1, F.col("kind"))), F.min("kind")).alias("kind")
    )
    attempt.put_parts("copies", merged, touched)

    # A known text keeps its kind, so the changed buckets' counts after and before differ by what the batch adds.
    after, before = (_counts(own.read("copies", touched)) for own in (attempt.snapshot(), base))
    change = after.unionByName(before.select(*[(-F.col(name)).alias(name) for name in ACCOUNTING.fieldNames()]))
    counts = base.read("accounting").unionByName(change).agg(*[F.sum(name).cast("long").alias(name) for name in ACCOUNTING.fieldNames()])
    attempt.put("accounting", counts)

    bad = typed(raw).filter(~ok).withColumn("digest", text_digest()).withColumn("invalid_reason", invalid_reason(rules(as_of)))
    bad = bad.withColumn("transaction_id", F.col("transaction_id_raw"))
    bad = bad.withColumn("quarantine_id", F.col("raw_row_id")).withColumn("quarantined_at", instant(loaded_at))
    columns = [*QUARANTINE.fieldNames(), "digest"]
    # Copies in the batch are combined before they meet the known rows.
    carried = [name for name in columns if name not in ("raw_row_id", "quarantine_id", "quarantined_at")]
    bad = written(bad.groupBy(*carried, "quarantined_at").agg(F.min("raw_row_id").alias("raw_row_id")).withColumn("quarantine_id", F.col("raw_row_id")).select(*columns))
    touched = _distinct(bad, bucket)
    either = base.read("quarantine", touched).unionByName(bad)
    lowest = either.groupBy("digest").agg(F.min_by(F.struct(*columns), "raw_row_id").alias("_row"))
    attempt.put("quarantine", lowest.select("_row.*"), bucket)


def _counts(copies: DataFrame) -> DataFrame:
    """Accounting of stored texts, one row."""
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("exact_duplicate_rows"),
        F.count_if(F.col("kind") == QUARANTINED).alias("quarantined_rows"),
        F.count_if(F.col("kind") == WITHOUT_STATUS).alias("rows_without_status"),
        F.count_if(F.col("kind") == VALID).alias("valid_rows"),
    )


def apply(
    raw: DataFrame,
    batch: str,
    root: str,
    as_of: str | None = None,
    loaded_at: str | None = None,
    check: Callable[[Mart], DataFrame] = violations,
    buckets: int = BUCKETS,
) -> Snapshot:
    """Carry one batch of raw rows to all tables under ``root`` and publish them as one snapshot.

    A batch that the log knows already changes nothing. ``check`` gives (check_name, violations) of a mart whose fact
    holds the changed months; any violation raises, and nothing is published.
    """
    spark = raw.sparkSession
    base = current(spark, root, buckets)
    if applied(spark, root, batch):
        return base
    attempt = _Attempt(base, batch)
    winners = _put_versions(attempt, written(clean_latest(typed(raw), as_of)))
    months = _put_fact(attempt, winners, _put_dims(attempt, raw, winners, as_of), loaded_at)
    _put_accounting(attempt, raw, as_of, loaded_at)
    result = attempt.snapshot()
    failed = check(open_snapshot(result, raw, as_of, months)).filter("violations > 0").collect()  # at most one row per check
    if failed:
        raise ConstraintsViolated(", ".join(f"{row.check_name}: {row.violations}" for row in failed))
    entry = (result.number, batch, result.buckets, None, result.parts)
    entry = spark.createDataFrame([entry], LOG).withColumn("published_at", F.current_timestamp())
    entry.coalesce(1).write.mode("append").parquet(f"{root}/log")
    return result


def stream(spark: SparkSession, landed_path: str, root: str, checkpoint: str, as_of: str | None = None, loaded_at: str | None = None, max_files: int | None = None) -> None:
    """Carry every landed raw file that wasn't before to the mart under ``root``, then stop.

    The stream's checkpoint remembers the files and numbers the batches; a batch that is replayed after a failure
    is known from the log, so each row reaches every table once.
    """

    def run(rows: DataFrame, number: int) -> None:
        apply(rows, f"stream-{number}", root, as_of, loaded_at)

    rows = spark.readStream.schema(RAW)
    rows = rows.option("maxFilesPerTrigger", max_files) if max_files else rows
    query = rows.parquet(landed_path).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
