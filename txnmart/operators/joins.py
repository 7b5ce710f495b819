"""Lookup joins from many rows into a dimension whose size is not known in advance."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.session import written

BROADCAST_MAX_BYTES = 64 * 1024 * 1024
SALTS = 64


def measure(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes of each (written, narrow) table, from one job over all of them."""
    sizes = []
    for name, table in tables.items():
        row_bytes = F.lit(16 * len(table.columns))
        for column, kind in table.dtypes:
            if kind == "string":
                row_bytes = row_bytes + F.coalesce(F.octet_length(column), F.lit(0))
        sizes.append(table.agg(F.sum(row_bytes.cast("long")).alias("bytes")).select(F.lit(name).alias("name"), "bytes"))
    return {row["name"]: row["bytes"] or 0 for row in reduce(DataFrame.unionByName, sizes).collect()}


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    size: int,
    how: str = "inner",
    max_bytes: int = BROADCAST_MAX_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``df`` to ``dim`` on ``{df column: dim column}``; the dim's join columns are dropped.

    Lookup columns are skewed by nature: a handful of channels cover all rows. A dim
    whose measured ``size`` is within the bound is broadcast, so ``df`` is not shuffled.
    Beyond, one aggregate finds the hot values, those with over one in ``4 * salts`` rows. Only
    their rows are salted and only their dim rows repeated once per salt; all other values
    are joined as they are. There can't be more than ``4 * salts`` hot values.
    """
    if size <= max_bytes:
        condition = [df[left] == dim[right] for left, right in on.items()]
        return df.join(F.broadcast(dim), condition, how).drop(*[dim[right] for right in on.values()])
    keys = list(on)
    counts = written(df.groupBy(*keys).agg(F.count("*").alias("_n")))
    least = (counts.agg(F.sum("_n")).first()[0] or 0) / (4 * salts)
    hot = counts.filter(F.col("_n") > least).select(*keys, F.lit(salts).alias("_salts"))
    # At most 4 * salts rows are broadcast.
    marked = df.join(F.broadcast(hot), keys, "left")
    salt = F.pmod(F.xxhash64(*df.columns), F.coalesce("_salts", F.lit(1))).cast("int")
    salted = marked.select(*df.columns, salt.alias("_salt"))
    named = hot.select(*[F.col(left).alias(f"_{right}") for left, right in on.items()], "_salts")
    crowded = [dim[right] == named[f"_{right}"] for right in on.values()]
    repeated = dim.join(F.broadcast(named), crowded, "left").drop(*[f"_{right}" for right in on.values()])
    repeats = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = repeated.withColumn("_dim_salt", F.explode(repeats)).drop("_salts")
    condition = [salted[left] == repeated[right] for left, right in on.items()]
    condition.append(salted["_salt"] == repeated["_dim_salt"])
    joined = salted.join(repeated, condition, how)
    return joined.drop("_salt", "_dim_salt", *[repeated[right] for right in on.values()])
