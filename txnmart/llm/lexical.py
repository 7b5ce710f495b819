"""Ranked lexical search: documents grouped by the mask of query terms that they hold.

Terms are runs of letters and digits of ASCII and of any other characters beyond ASCII, with only A-Z lower-cased.
A first pass counts, for each document, its terms and how often it holds each term of the items; term weights
come from the number of documents that hold a term. A second pass ranks blocks of documents for every item. In
a block each term has a bitmap of the documents that hold it. The bitmaps of an item's terms give each document a
presence mask; documents with equal masks form a group, whose best possible score is
what its terms add in the shortest document that holds the term most often. Groups are scored in
descending order of that bound until the worst of the best scores found is above all bounds that are left. The
best of all blocks are ranked once more, so nothing is cut but the rest of each block's list.

Items are dealt to parts of about ``ITEM_BYTES`` bytes of text (a longer item is a part of its own), which go along with the
task's function; each part is one pass over the documents. So memory is bounded by the part and the block, and work
grows with items times documents.

Nulls: a NULL text has no terms. Rows of both tables are told apart by their place, so repeated rows and NULL ids are ranked
one by one; among equal scores a NULL doc_id comes last. An item without terms, or whose terms no document
holds, has no rows. Texts of any length are read whole. Extra columns are not read. An empty table of either kind gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmart.llm.common import placed, text_of
from txnmart.session import written

KEEP = 10
#: Documents in a block; a block is ranked by one call.
BLOCK = 8192
#: Text of the items of one part.
ITEM_BYTES = 4_000_000
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
COUNTED = "doc_id long, n long, term array<int>, tf array<long>"
RANKED = "item int, doc_id long, score long"
SCALE, LENGTH_SHARE = 1_000_000_000, 90


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text; bytes beyond ASCII are parts of terms, so characters stay whole."""
    return TERM.findall(text.lower())


def weight(holders: int, documents: int) -> int:
    """Weight of a term that ``holders`` of ``documents`` documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Of each document: its number of terms, and the terms of ``vocabulary`` in it with their counts."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {"doc_id": batch.column("doc_id"), "n": [], "term": [], "tf": []}
            for text in batch.column("_text").cast(pa.binary()):
                own = terms(text.as_py())
                counts = Counter(own)
                held = sorted((vocabulary[term], counts[term]) for term in counts.keys() & vocabulary.keys())
                found["n"].append(len(own))
                found["term"].append([term for term, _ in held])
                found["tf"].append([tf for _, tf in held])
            yield pa.RecordBatch.from_pydict(found, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    return rows.mapInArrow(mapped, COUNTED)


class Block:
    """Documents with their terms as bitmaps, ranked for one item after the other."""

    def __init__(self, ids: np.ndarray, length: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.ids, self.length = ids, length
        doc = np.repeat(np.arange(len(ids)), sizes)
        order = np.lexsort((doc, term))
        self.term, self.doc, self.tf = term[order], doc[order], tf[order]
        self.held, self.start = np.unique(self.term, return_index=True)
        self.stop = np.append(self.start[1:], len(self.term))
        self.bitmaps: dict[int, np.ndarray] = {}

    def span(self, term: int) -> slice:
        at = int(np.searchsorted(self.held, term))
        return slice(int(self.start[at]), int(self.stop[at]))

    def bitmap(self, term: int) -> np.ndarray:
        if term not in self.bitmaps:
            bits = np.zeros(len(self.ids), np.uint8)
            bits[self.doc[self.span(term)]] = 1
            self.bitmaps[term] = np.packbits(bits)
        return self.bitmaps[term]

    def rank(self, item: Sequence[tuple[int, int]], keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``keep`` best for an item of (term, weight)."""
        item = [(term, w) for term, w in item if w > 0 and self.held[np.searchsorted(self.held, term) % len(self.held)] == term]
        if not item:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maps = np.stack([self.bitmap(term) for term, _ in item])
        some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(maps, axis=0), count=len(self.ids)))
        present = np.unpackbits(maps, axis=1, count=len(self.ids))[:, some]
        masks = np.ascontiguousarray(np.packbits(present, axis=0).T)
        keys = masks.view(f"V{masks.shape[1]}").ravel()
        distinct, first, group = np.unique(keys, return_index=True, return_inverse=True)
        gains = [self.gain(term, w) for term, w in item]
        most = np.array([own.max() for own in gains])
        bound = present[:, first].T.astype(np.int64) @ most
        by_bound = np.argsort(-bound, kind="stable")
        members = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(distinct)))
        table = np.zeros((len(item), len(some)), np.int64)
        for row, ((term, _), own) in enumerate(zip(item, gains, strict=True)):
            table[row, np.searchsorted(some, self.doc[self.span(term)])] = own
        docs, scores, least, at = [], [], 0, 0
        while at < len(by_bound) and bound[by_bound[at]] > 0 and bound[by_bound[at]] >= least:
            # A few groups at once, ever more of them: as many documents as are kept, then twice as many.
            upto = at + max(1, min(len(by_bound) - at, max(keep, at)))
            own = np.concatenate([members[ends[g - 1] if g else 0 : ends[g]] for g in by_bound[at:upto]])
            docs.append(some[own])
            scores.append(table[:, own].sum(axis=0))
            every = np.concatenate(scores)
            least = int(np.partition(every, len(every) - keep)[len(every) - keep]) if len(every) >= keep else 0
            at = upto
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, score = np.concatenate(docs), np.concatenate(scores)
        inside = (score > 0) & (score >= least)
        found, score = found[inside], score[inside]
        # All of equal scores stay while ids have not decided between them; they are ordered by id here.
        order = np.lexsort((self.ids[found], -score))[:keep]
        return found[order], score[order]

    def gain(self, term: int, w: int) -> np.ndarray:
        """What a term adds to the score of each document that holds it."""
        own = self.span(term)
        return w * ((SCALE * self.tf[own]) // (1000 * self.tf[own] + 8 * self.length[self.doc[own]]))


def blocks_ranked(counted: DataFrame, items: list[list[tuple[int, int]]], documents: int, total: int, keep: int) -> DataFrame:
    """The best of each block of documents for each item."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranked(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(parts).combine_chunks()
            n, term, tf = (whole.column(name).combine_chunks() for name in ("n", "term", "tf"))
            # NULL ids come last.
            ids = whole.column("doc_id").combine_chunks()
            sortable = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            sizes = n.to_numpy()
            length = 100 - LENGTH_SHARE + (LENGTH_SHARE * sizes * documents) // max(1, total)
            block = Block(sortable, length, term.value_lengths().to_numpy(), term.flatten().to_numpy(), tf.flatten().to_numpy())
            numbers, docs, scores = [], [], []
            for number, item in enumerate(items if len(block.held) else []):
                found, score = block.rank(item, keep)
                numbers.append(np.full(len(found), number, np.int32))
                docs.append(found)
                scores.append(score)
            columns = [np.concatenate([np.zeros(0, np.int64), *own]) for own in (numbers, docs, scores)]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), ids.take(pa.array(columns[1], pa.int64())), pa.array(columns[2], pa.int64())],
                names=["item", "doc_id", "score"],
            )

        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                if rows and rows + part.num_rows > BLOCK:
                    yield ranked(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield ranked(held)

    return counted.mapInArrow(mapped, RANKED)


def search(docs: DataFrame, items: DataFrame, keep: int = KEEP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``keep`` best documents with a score above 0 of each item."""
    spark = docs.sparkSession
    asked = placed(items, F.col("item_id"), text_of().alias("_text"))
    count, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_text") + 64), F.lit(0))).first()
    parts = max(1, min(count, -(-size // item_bytes)))
    asked = written(asked.withColumn("_part", F.pmod(F.xxhash64("_file", "_row"), F.lit(parts))))
    found = None
    for part in range(parts):
        rows = asked.filter(F.col("_part") == part).select("item_id", "_text").collect()
        own = [sorted(set(terms(row["_text"].encode()))) for row in rows]
        vocabulary = {term: at for at, term in enumerate(sorted(set().union(*own)))}
        counted = written(count_terms(docs, vocabulary))
        documents, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        # At most as many rows as the part has terms.
        holders = dict(map(tuple, counted.select(F.explode("term").alias("term")).groupBy("term").count().collect()))
        queries = [[(vocabulary[t], weight(holders[vocabulary[t]], documents)) for t in each if vocabulary[t] in holders] for each in own]
        names = spark.createDataFrame([(at, row["item_id"]) for at, row in enumerate(rows)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = blocks_ranked(counted, queries, documents, total, keep).withColumn("rank", F.row_number().over(order))
        ranked = best.filter(F.col("rank") <= keep).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = ranked if found is None else found.unionByName(ranked)
    return found
