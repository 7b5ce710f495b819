"""Pack documents into bins of equal capacity by best fit under conflicts.

Two documents of the same source, or of the same duplicate cluster, may not share a bin, so
every bin mixes sources and no bin shows a text twice. Documents longer than a bin are cut into
full bins and a rest; only the rest is packed with others, and a full piece has a bin to itself.

Items are dealt at random, by a hash of id and place, to shards of about ``SHARD_ITEMS`` items, so a
hot source or cluster is spread over all shards and no task grows with the input. Within a shard
items come in falling size. Open bins are ordered by residual; each carries a bitmap of its
sources and one of its clusters. The search starts at the smallest residual that holds the item
and goes on to the next larger one until a bin has no bit in common with the item; that bin is
the tightest compatible one. If there is none, a bin is opened.

Nulls: a NULL text has size 0 and is packed like any other item; documents of a NULL source count
as one source; a NULL cluster conflicts with nothing. Repeated rows are items of their own and
of one cluster, if their texts are equal. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, WORD, placed, text_of
from txnmart.session import written

CAPACITY = 2048
SHARD_ITEMS = 2000


def best_fit(items: Iterable[tuple[int, str | None, object]], capacity: int) -> list[int]:
    """Bin number of each item (size, source, cluster), in the order given; sizes don't exceed ``capacity``."""
    items = list(items)
    repeated = Counter(cluster for _, _, cluster in items if cluster is not None)
    source_bits: dict[str | None, int] = {}
    cluster_bits: dict[object, int] = {}
    order: list[tuple[int, int]] = []  # open bins as (residual, bin)
    sources: list[int] = []
    clusters: list[int] = []
    where = [0] * len(items)
    for at in sorted(range(len(items)), key=lambda i: -items[i][0]):
        size, source, cluster = items[at]
        source_bit = 1 << source_bits.setdefault(source, len(source_bits))
        cluster_bit = 0
        if cluster is not None and repeated[cluster] > 1:
            cluster_bit = 1 << cluster_bits.setdefault(cluster, len(cluster_bits))
        spot = bisect_left(order, (size, -1))
        while spot < len(order):
            residual, own = order[spot]
            if not (sources[own] & source_bit or clusters[own] & cluster_bit):
                break
            spot += 1
        if spot < len(order):
            del order[spot]
            residual -= size
        else:
            own, residual = len(sources), capacity - size
            sources.append(0)
            clusters.append(0)
        sources[own] |= source_bit
        clusters[own] |= cluster_bit
        insort(order, (residual, own))
        where[at] = own
    return where


def pieces(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Items (size, ...) cut at ``capacity``: piece, start and length, the rest last; one piece of 0 for size 0."""
    count = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("long")
    cut = items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    start = F.col("piece") * capacity
    return cut.withColumn("start", start).withColumn("length", F.least(F.col("size") - start, F.lit(capacity).cast("long")))


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per piece: doc_id, source, piece, start, length, bin, offset, and the document's place.

    ``start`` and ``length`` are in words of the text, ``offset`` in words of the bin. ``bin`` is
    ``shard-number``. Clusters are equal word sequences, regardless of case and white space.
    """
    folded = F.regexp_replace(F.trim(F.lower(text_of())), r"\s+", " ")
    items = placed(
        docs,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(folded).alias("cluster"),
    )
    cut = written(pieces(items, capacity))
    shards = max(1, -(-cut.count() // shard_items))
    shard = F.pmod(F.xxhash64("doc_id", "piece", *PLACE), F.lit(shards)).cast("long")
    names = ["doc_id", "source", "piece", "start", "length", *PLACE]

    def packed(table: pa.Table) -> pa.Table:
        # Full pieces fit nowhere but in a bin of their own, so best fit leaves them there.
        table = table.sort_by([("doc_id", "ascending"), ("_file", "ascending"), ("_row", "ascending"), ("piece", "ascending")])
        sizes = table["length"].to_pylist()
        where = best_fit(zip(sizes, table["source"].to_pylist(), table["cluster"].to_pylist(), strict=True), capacity)
        filled: Counter = Counter()
        offsets = []
        for own, size in zip(where, sizes, strict=True):
            offsets.append(filled[own])
            filled[own] += size
        shard = table["shard"][0].as_py()
        out = table.select(names).append_column("bin", pa.array([f"{shard}-{own}" for own in where], pa.string()))
        return out.append_column("offset", pa.array(offsets, pa.int64()))

    schema = "doc_id long, source string, piece long, start long, length long, _file string, _row long, bin string, offset long"
    return cut.withColumn("shard", shard).groupBy("shard").applyInArrow(packed, schema)
