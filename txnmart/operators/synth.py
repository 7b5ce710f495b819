"""Synthetic transactions at any size, with the distributions of a profiled source.

Rows are generated from their number alone (see `functions.draws`), so the job is a
range scan with narrow steps: no shuffle, the same output at any partitioning, and a
copy of a row is made by generating its number twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmart.functions.draws import BITS, below, permuted, scattered, standard_normal, uniform
from txnmart.operators import profile
from txnmart.operators.joins import lookup, measure
from txnmart.operators.numbering import running_total
from txnmart.schemas import SOURCE_FIELDS
from txnmart.session import written
from txnmart.sources.raw import missing_as_null

# Defaults of the generator.
SEED = 42
ROWS = 1_000_000
FIRST_ID = 1_000_000
ID_PREFIX = "SYN"
START_DATE = "2024-01-01"
END_DATE = "2026-12-31"
CHUNK_ROWS = 250_000
DEFAULT_LOG_MEAN = 4.0
DEFAULT_LOG_STD = 0.5
MALFORMED_TIMESTAMP = "2026-13-01 99:99"
ISSUE_RATES = {
    "null_timestamp": 0.0015,
    "malformed_timestamp": 0.0015,
    "null_channel": 0.0050,
    "null_product": 0.0035,
    "null_amount": 0.0100,
    "zero_amount": 0.0020,
    "negative_amount": 0.0020,
    "duplicate_rows": 0.0080,
}
# Seasonal day weights in percent of a plain day; they multiply.
WEEKEND_PCT = 125
YEAR_END_PCT = 125  # November and December
CAMPAIGN_PCT = 170  # 15 to 25 April

SECONDS_PER_DAY = 24 * 60 * 60


def day_weights(spark: SparkSession, start: str = START_DATE, end: str = END_DATE) -> DataFrame:
    """Every day of the range with its weight and its share of all weights.

    Weights are exact integers until the final division, so shares do not depend on
    the order of summation.
    """
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    days = spark.range(1).select(F.explode(span).alias("day"))
    return weigh_days(days)


def weigh_days(days: DataFrame) -> DataFrame:
    """Add seasonal ``weight`` and ``share`` to a frame of distinct days."""
    day = F.col("day")
    plain = F.lit(100)
    weekend = F.when(F.weekday(day) >= 5, WEEKEND_PCT).otherwise(plain)
    year_end = F.when(F.month(day).isin(11, 12), YEAR_END_PCT).otherwise(plain)
    in_campaign = (F.month(day) == 4) & F.dayofmonth(day).between(15, 25)
    campaign = F.when(in_campaign, CAMPAIGN_PCT).otherwise(plain)
    units = days.select("day", (weekend * year_end * campaign).cast("long").alias("weight_units"))
    total = units.agg(F.sum("weight_units")).scalar()
    return units.select(
        "day",
        "weight_units",
        (F.col("weight_units") / 1e6).alias("weight"),
        (F.col("weight_units") / total).alias("share"),
    )


def synth_ids(spark: SparkSession, n: int) -> DataFrame:
    """Row numbers 0..n-1 and their transaction ids."""
    return with_transaction_id(spark.range(n).withColumnRenamed("id", "row_number"))


def with_transaction_id(ids: DataFrame) -> DataFrame:
    number = (F.col("row_number") + FIRST_ID).cast("string")
    return ids.withColumn("transaction_id", F.concat(F.lit(ID_PREFIX), number))


def duplicate_ids(
    spark: SparkSession,
    n: int,
    rate: float = ISSUE_RATES["duplicate_rows"],
    chunk: int = CHUNK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Row numbers to emit a second time: exactly ``int(rate * size)`` different ones per chunk of rows.

    They are a simple random sample without replacement: the images of the first places under a
    random permutation of the chunk. That gives the exact count without ranking or shuffling any rows.
    """
    chunks = spark.range((n + chunk - 1) // chunk).withColumn("first", F.col("id") * chunk)
    chunks = chunks.withColumn("size", F.least(F.lit(chunk).cast("long"), F.lit(n) - F.col("first")))
    chunks = chunks.withColumn("copies", F.floor(F.col("size") * F.lit(float(rate))).cast("long"))
    picks = chunks.filter("copies > 0").withColumn("pick", F.explode(F.expr("sequence(0L, copies - 1)")))
    spot = permuted(F.col("pick"), F.col("size"), "duplicate", seed)
    return scattered(picks, "first").select((F.col("first") + spot).alias("row_number"))


# --- weighted draws -----------------------------------------------------------------


@dataclass(frozen=True)
class Draws:
    """What the generator draws from: a small table, and per attribute the length and bucket width of its line."""

    table: DataFrame
    size: int
    lines: dict[str, tuple[int, int]]


def draw_table(source: DataFrame, start: str = START_DATE, end: str = END_DATE) -> Draws:
    """Profile ``source`` into a table of intervals.

    Each value of an attribute owns an interval [low, high) as long as its weight. To
    draw, pick a whole number below the attribute's total and find its interval. The
    number line of an attribute is cut into about as many buckets as it has values,
    and an interval is listed under every bucket it touches, so that finding it is an
    equality join.
    """
    spark = source.sparkSession
    days = day_weights(spark, start, end).select(
        F.lit("day").alias("attribute"), F.col("day").cast("string").alias("value"), F.col("weight_units").alias("n")
    )
    weights = profile.all_value_counts(source).unionByName(days)
    placed = running_total(weights, ["attribute", "value"], "n", "start")
    # One row per attribute, of which there are six.
    lines = placed.groupBy("attribute").agg(
        F.min("start").alias("base"),
        F.sum("n").alias("total"),
        F.greatest(F.lit(1), F.expr("sum(n) div count(*)")).alias("width"),
    )
    amounts = profile.fit_lognormal(source).select(
        F.lit("product_category").alias("attribute"), F.col("product_category").alias("value"), "log_mean", "log_std"
    )
    intervals = (
        placed.join(F.broadcast(lines), "attribute")
        .join(amounts, ["attribute", "value"], "left")
        .select(
            "attribute",
            "value",
            "total",
            "width",
            (F.col("start") - F.col("base")).alias("low"),
            (F.col("start") - F.col("base") + F.col("n")).alias("high"),
            F.coalesce("log_mean", F.lit(DEFAULT_LOG_MEAN)).alias("log_mean"),
            F.coalesce("log_std", F.lit(DEFAULT_LOG_STD)).alias("log_std"),
        )
    )
    buckets = F.sequence(F.expr("low div width"), F.expr("(high - 1) div width"))
    table = written(intervals.withColumn("bucket", F.explode(buckets)))
    found = table.groupBy("attribute").agg(F.first("total").alias("total"), F.first("width").alias("width")).collect()
    return Draws(table, measure({"draws": table})["draws"], {r.attribute: (r.total, r.width) for r in found})


def draw(rows: DataFrame, draws: Draws, attribute: str, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add a column ``attribute`` drawn by weight to `scattered` rows, with further table columns ``keep``."""
    if attribute not in draws.lines:
        raise ValueError(f"the source has no values of {attribute} to draw from")
    total, width = draws.lines[attribute]
    own = draws.table.filter(F.col("attribute") == attribute)
    choices = own.select(F.col("value").alias(attribute), "low", "high", "bucket", *keep)
    numbered = rows.withColumn("_number", below(attribute, seed, F.lit(total)))
    numbered = numbered.withColumn("_bucket", F.expr(f"coalesce(_number div {width}L, 0L)"))
    # Numbers are spread evenly over the buckets, so there is no hot value to salt.
    found = lookup(numbered, choices, {"_bucket": "bucket"}, draws.size, salts=1)
    return found.filter("low <= _number AND _number < high").drop("low", "high", "_number", "_bucket")


def order_time(day: Column, seed: int) -> Column:
    """Text timestamp at a uniform second of the day."""
    second = below("second", seed, F.lit(SECONDS_PER_DAY))
    return (day.cast("timestamp_ntz") + F.make_dt_interval(secs=second)).cast("string")


def lognormal_amount(log_mean: Column, log_std: Column, seed: int) -> Column:
    """Text amount in cents precision."""
    amount = F.exp(log_mean + log_std * standard_normal("amount", seed))
    return amount.try_cast("decimal(14,2)").cast("string")


def inject_issues(
    df: DataFrame, row_id: str = "row_number", rates: Mapping[str, float] = ISSUE_RATES, seed: int = SEED
) -> DataFrame:
    """Blank or break fields at the given rates.

    Later steps win over earlier ones: a malformed timestamp replaces a missing one and
    a zero amount a missing one, while negating leaves a missing amount missing.
    """

    def hit(issue: str) -> Column:
        return uniform(f"issue/{issue}", seed) < rates[issue]

    c = F.col
    timestamp = F.when(hit("malformed_timestamp"), F.lit(MALFORMED_TIMESTAMP)).when(
        ~hit("null_timestamp"), c("order_timestamp")
    )
    amount = F.when(hit("zero_amount"), F.lit("0")).when(~hit("null_amount"), c("amount"))
    negated = (-F.abs(c("amount").try_cast("decimal(14,2)"))).cast("string")
    broken = scattered(df, row_id).withColumns(
        {
            "order_timestamp": timestamp,
            "channel": F.when(~hit("null_channel"), c("channel")),
            "product_category": F.when(~hit("null_product"), c("product_category")),
            "amount": amount,
        }
    )
    return broken.withColumn("amount", F.when(hit("negative_amount"), negated).otherwise(c("amount"))).drop(*BITS)


def synth_rows(ids: DataFrame, draws: Draws, pool: int, seed: int = SEED) -> DataFrame:
    """Clean generated rows for a frame of ``row_number``; a narrow stage."""
    rows = scattered(with_transaction_id(ids), "row_number")
    rows = draw(rows, draws, "day", seed)
    rows = draw(rows, draws, "product_category", seed, keep=("log_mean", "log_std"))
    for attribute in ("channel", "quantity", "payment_method", "status"):
        rows = draw(rows, draws, attribute, seed)
    customer = F.concat(F.lit("C"), (below("customer", seed, F.lit(pool)) + 1).cast("string"))
    return rows.select(
        "row_number",
        "transaction_id",
        order_time(F.col("day"), seed).alias("order_timestamp"),
        "channel",
        "product_category",
        "quantity",
        lognormal_amount(F.col("log_mean"), F.col("log_std"), seed).alias("amount"),
        "payment_method",
        customer.alias("customer_id"),
        "status",
    )


def generate(
    source: DataFrame,
    n: int = ROWS,
    start: str = START_DATE,
    end: str = END_DATE,
    chunk: int = CHUNK_ROWS,
    rates: Mapping[str, float] = ISSUE_RATES,
    seed: int = SEED,
) -> DataFrame:
    """``n`` synthetic rows profiled from ``source`` plus exact copies, as source text columns."""
    spark = source.sparkSession
    source = missing_as_null(source)
    draws = draw_table(source, start, end)
    pool = profile.customer_pool(source).first()["customer_pool"]
    base = spark.range(n).select(F.col("id").alias("row_number"))
    ids = base.unionByName(duplicate_ids(spark, n, rates["duplicate_rows"], chunk, seed))
    rows = inject_issues(synth_rows(ids, draws, pool, seed), rates=rates, seed=seed)
    return rows.select(*SOURCE_FIELDS)
