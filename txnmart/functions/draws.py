"""Random draws that any SQL engine can repeat.

A row's number is scattered once, by MD5, into four whole numbers below 2^28. A draw is a weighted
sum of them modulo a prime, with weights by salt and seed, so it costs a few multiplications
below 2^63 and any four draws of a row are independent. Draws depend on (row number, salt, seed)
only: output is the same whatever the partitioning and however often a lost task is run again.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The two largest primes below 2^31, for the high and the low half of a draw.
PRIMES = (2147483647, 2147483629)
HALF_BITS = 31
BITS = ["_bits0", "_bits1", "_bits2", "_bits3"]
DIGITS = 7
RESOLUTION = 1 << 53
#: Rounds of a permutation, some four per bit of the ranges that are drawn from.
ROUNDS = 80


def scattered(df: DataFrame, row_id: str) -> DataFrame:
    """Add the columns `BITS` that draws are made of."""
    hashed = df.withColumn("_md5", F.md5(F.col(row_id).cast("string").cast("binary")))
    parts = {name: F.conv(F.substring("_md5", 1 + DIGITS * at, DIGITS), 16, 10).cast("long") for at, name in enumerate(BITS)}
    return hashed.withColumns(parts).drop("_md5")


def weights(salt: str, seed: int, half: int) -> list[int]:
    digest = hashlib.sha256(f"{salt}/{seed}/{half}".encode()).digest()
    return [int.from_bytes(digest[8 * at : 8 * at + 8], "big") % (PRIMES[half] - 1) + 1 for at in range(len(BITS))]


def number(salt: str, seed: int) -> Column:
    """Uniform long in [0, 2^62)."""
    high, low = (
        reduce(add, (F.col(name) * F.lit(weight) for name, weight in zip(BITS, weights(salt, seed, half), strict=True))) % F.lit(prime)
        for half, prime in enumerate(PRIMES)
    )
    return high * F.lit(1 << HALF_BITS) + low


def uniform(salt: str, seed: int) -> Column:
    """Uniform double in [0, 1)."""
    return F.shiftright(number(salt, seed), 2 * HALF_BITS - 53) / F.lit(float(RESOLUTION))


def below(salt: str, seed: int, bound: Column) -> Column:
    """Uniform long in [0, bound).

    Never NULL, which the planner can't tell of a remainder: it would push null checks, and with
    them the whole computation, below the columns of `scattered`.
    """
    return F.coalesce(number(salt, seed) % bound.cast("long"), F.lit(0).cast("long"))


def permuted(place: Column, size: Column, salt: str, seed: int) -> Column:
    """Image of the long ``place`` under a random permutation of [0, size), for sizes below 2^31.

    The permutation is that of the row's `BITS`: rows that share them share it, and get different
    images for different places. Each round mirrors the range around a random point and swaps a place
    with its mirror image or not, by a draw that is the same for both; no range needs padding or retries.
    """
    names = ["_s0", "_s1", "_s2", "_s3", "_w0", "_w1", "_w2", "_w3"]
    rounds = []
    for at in range(ROUNDS):
        values = [*weights(f"{salt}/{at}", seed, 0), *weights(f"{salt}/{at}", seed, 1)]
        rounds.append(F.struct(*[F.lit(value).cast("long").alias(name) for name, value in zip(names, values, strict=True)]))
    bits = [F.col(name) for name in BITS]

    def step(spot: Column, key: Column) -> Column:
        shift = reduce(add, (bit * key[f"_s{at}"] for at, bit in enumerate(bits))) % F.lit(PRIMES[0]) % size
        mirror = (shift - spot + size) % size
        toss = F.greatest(spot, mirror) * key["_w0"] + reduce(add, (bits[at] * key[f"_w{at}"] for at in (1, 2, 3)))
        return F.when(toss % F.lit(PRIMES[1]) % 2 == 1, mirror).otherwise(spot)

    return F.aggregate(F.array(*rounds), place, step)


def standard_normal(salt: str, seed: int) -> Column:
    """Standard normal double by the Box-Muller transform; 1 - u keeps the logarithm finite."""
    radius = F.sqrt(-2.0 * F.log(1.0 - uniform(salt + "/radius", seed)))
    return radius * F.cos(2.0 * math.pi * uniform(salt + "/angle", seed))
