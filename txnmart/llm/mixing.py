"""Mix sources to target weights by weighted fair queueing.

Each source has a virtual clock that runs at the rate of its target: after ``t`` the source
has sent ``t`` times its target words. Documents wait in a shuffled order that depends on
their ids only, and the queue of a source runs through its documents at most twice. A global
range sort by virtual time, cut where the running total of words meets the budget, then gives
every source its target, but for one document that the cut falls into. Such a document counts
if at least half of it lies before the cut, so a document's time here is that of its middle;
``finish`` keeps the finish time itself.

No source meets one task, nor do documents of one id: the running totals of all sources come from
one prefix sum over ranges of (source, shuffled id, size, place), less those of the sources before.

Nulls: a NULL text has size 0, a NULL source is a source of its own and sorts last, NULL ids are
shuffled like the others. Documents without words take nothing. Repeated rows are documents of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, WORD, placed
from txnmart.operators.numbering import running_total
from txnmart.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source of ``sizes`` (source, size, docs): rank, weight, source_size, docs, target.

    Sources in code point order, NULL last, weigh ``weights`` in turn. Words of ``share`` times
    all sizes are dealt by weight; what goes beyond ``most`` times a source's size is dealt anew
    among the others. Only sums over the sources reach the driver.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("docs").alias("docs"))
    ordered = by_source.withColumn("_null", F.col("source").isNull()).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_total(ordered, ["_null", "source"], "_one", "rank").drop("_null", "_one")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(ranked.withColumn("weight", turn))
    full = most * F.col("source_size")
    level, budget = 0.0, share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        above = full < level * F.col("weight")
        capped, rest = sources.agg(F.sum(F.when(above, full)), F.sum(F.when(~above, F.col("weight")))).first()
        raised = (budget - (capped or 0)) / rest if rest else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.lit(level) * F.col("weight"), full.cast("double"))
    return sources.withColumn("target", target)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, finish, source, and its place."""
    items = written(
        placed(
            docs,
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_key"),
        )
    )
    sizes = written(items.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")))
    sources = written(targets(sizes, weights, share, most))
    budget = sources.agg(F.sum("target")).first()[0]

    known = running_total(sources, ["rank"], "source_size", "_base").withColumnRenamed("source", "_source")
    timed = items.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "docs")
    totals = running_total(timed, ["rank", "_key", "size", *PLACE], "size", "_ahead")
    queued = written(totals.withColumn("_ahead", F.col("_ahead") - F.col("_base")).drop("_base", "weight"))

    def time_of(turn, part: float):
        words = turn * F.col("source_size") + F.col("_ahead") + part * F.col("size")
        return F.when(F.col("target") > 0, words / F.col("target")).otherwise(0.0)

    turns = queued.withColumn("_turn", F.explode(F.array(*map(F.lit, range(most)))))
    order = ["_time", "rank", "_turn", "_key", *PLACE]
    sent = running_total(turns.withColumn("_time", time_of(F.col("_turn"), 0.5)), order, "size", "_sent")
    late = sent.filter(F.col("_sent") + 0.5 * F.col("size") > budget)
    cut = late.agg(F.min(F.struct(*order)).alias("cut")).first()["cut"]
    kinds = [sent.schema[name].dataType for name in order]

    def admitted(turn: int):
        if cut is None:
            return F.lit(1).cast("long")
        own = [time_of(F.lit(turn), 0.5), F.col("rank"), F.lit(turn), *map(F.col, ["_key", *PLACE])]
        last = [F.lit(value).cast(kind) for value, kind in zip(cut, kinds, strict=True)]
        pair = [F.struct(*(c.alias(n) for c, n in zip(side, order, strict=True))) for side in (own, last)]
        return (pair[0] < pair[1]).cast("long")

    copies = sum((admitted(turn) for turn in range(1, most)), admitted(0))
    return queued.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
        time_of(F.lit(0), 1.0).alias("finish"),
        "source",
        *PLACE,
    )
