"""Exact deduplication over a stream with keyed state on disk.

The stream's state is keyed by the SHA-256 of the text and kept in RocksDB, without expiry. It
holds the stable identifier (the largest doc_id so far), the number of texts seen and the
content locator: the file and row of that document. Rows of one micro-batch are combined per
digest in their tasks before they meet the state, so a text that a third of all rows share
costs one row per task.

A digest that was met more than once is a hit. The whole texts behind it are compared byte by
byte with the text at the locator: within each task equal texts fold into one row, then each
different text of a digest meets the retained one. Texts that differ under one digest, if there
ever are any, become groups of their own.

Nulls: a NULL text counts as empty; NULL ids are smaller than any other and may stay if all ids
of a group are NULL. Of repeated rows (equal text and id) the last by place stays. An empty
table gives an empty result.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, placed, text_of
from txnmart.session import work_folder, written

STATE = "spark.sql.streaming.stateStore"
#: Stores are many and small, so their files aren't allocated ahead.
STATE_SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.allowFAllocate": "false",
}
#: Feed files per micro-batch; a batch of this size is what one restart repeats at most.
FILES_PER_BATCH = 256


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def retain(feed: str, schema, spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Run the stream over all files of ``feed`` that it has not seen, and return its state.

    ``feed`` holds digest, doc_id and the place of each document. ``folder`` keeps the state and
    the progress: started anew with the same folder, the stream goes on where it stopped, and
    files added to ``feed`` meet everything that was retained before.
    """
    places = F.max(F.struct("doc_id", *PLACE)).alias("kept")
    with _settings(spark, STATE_SETTINGS):
        stream = (
            spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(feed)
            .groupBy("digest")
            .agg(places, F.count("*").alias("n"))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", folder)
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
        state = spark.read.format("statestore").load(folder)
    kept, n = state.schema["value"].dataType.names
    return state.select("key.digest", F.col("value")[kept].alias("kept"), F.col("value")[n].alias("n"))


def groups(docs: DataFrame, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per document with its place: doc_id, digest, keep_id, group_size, kept.

    Only digests, ids and places are shuffled, and the texts behind hits.
    """
    spark = docs.sparkSession
    text = text_of()
    folder = work_folder(spark, "dedup")
    feed = written(placed(docs, "doc_id", F.sha2(text, 256).alias("digest")), f"{folder}/feed")
    if feed.isEmpty():
        return feed.select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(False).alias("kept"), *PLACE)
    state = written(retain(f"{folder}/feed", feed.schema, spark, f"{folder}/state", files_per_batch))

    hits = state.filter("n > 1").select("digest", F.struct(*(F.col("kept")[c] for c in PLACE)).alias("_at"))
    texts = placed(docs, "doc_id", F.sha2(text, 256).alias("digest"), text.alias("_text"))
    suspects = texts.join(hits.hint("shuffle_hash"), "digest")
    at_place = F.struct(*PLACE) == F.col("_at")
    # Grouped by a hash of the digest, so that the fold has a shuffle of its own: then the join
    # before it can split a hot digest, whose rows fold where they are.
    folded = written(
        suspects.groupBy(F.xxhash64("digest").alias("_h"), "_text").agg(
            F.first("digest").alias("digest"),
            F.max(F.struct("doc_id", *PLACE)).alias("kept"),
            F.count("*").alias("n"),
            F.max(at_place).alias("_retained"),
        )
    ).drop("_h")
    retained = folded.filter("_retained").select("digest", F.col("_text").alias("_same"))
    differing = written(
        folded.filter("NOT _retained")
        .join(retained, "digest")
        .filter(F.col("_text") != F.col("_same"))
        .select("digest", F.sha2(F.concat("_text", F.lit("\0")), 512).alias("_variant"), "kept", "n")
    )

    label = state.withColumn("_variant", F.lit(None).cast("string"))
    rows = feed.withColumn("_variant", F.lit(None).cast("string"))
    if not differing.isEmpty():
        own = differing.groupBy("digest").agg(F.sum("n").alias("_others"))
        label = label.join(own, "digest", "left").withColumn("n", F.col("n") - F.coalesce("_others", F.lit(0)))
        raise_kept = folded.filter("_retained").select("digest", F.col("kept").alias("_kept"))
        label = label.join(raise_kept, "digest", "left").withColumn("kept", F.coalesce("_kept", "kept"))
        label = label.select("digest", "_variant", "kept", "n").unionByName(differing)
        wrong = differing.select("digest", "_variant")
        marked = texts.select("digest", *PLACE, F.sha2(F.concat("_text", F.lit("\0")), 512).alias("_variant"))
        odd = marked.join(wrong, ["digest", "_variant"], "left_semi")
        rows = feed.join(odd, ["digest", *PLACE], "left")
    else:
        label = label.select("digest", "_variant", "kept", "n")
    kept = label.withColumnRenamed("digest", "_digest").withColumnRenamed("_variant", "_of")
    joined = rows.join(kept, (F.col("digest") == F.col("_digest")) & F.col("_variant").eqNullSafe(F.col("_of")))
    return joined.select(
        "doc_id",
        "digest",
        F.col("kept.doc_id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.struct(*PLACE) == F.struct(*(F.col("kept")[c] for c in PLACE))).alias("kept"),
        *PLACE,
    )
