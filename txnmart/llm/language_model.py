"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and read by memory map.

Words enter as 64-bit hashes. Each task of the counting pass sorts the n-grams of some million
tokens, sums equal ones, and deals them by ranges of their hash to buckets; so a frequent word or
n-gram costs one entry per task, and buckets are even. Their number follows the bytes of text. One task merges a bucket, stores it as two
arrays (sorted hashes, counts) in the shared folder, and emits what the next lower order and the
contexts need: every different n-gram counts once for its last n-1 words (their continuation
count; n-grams that begin a text keep their own counts), and its context collects the total and
the numbers of n-grams with count 1, 2 and 3 or more. A round per order does this down to words.

Workers map the arrays of the folder into memory and look up sorted queries, so a model may be
larger than an executor. The shared folder must therefore be mounted on the executors. A task
that runs again replaces its files by equal ones.

A text is its words, lower-cased in A-Z, and one end; its first words are seen from a begin mark.
The lowest order interpolates with a uniform chance of 1 / (V + 1), so unknown words have one.

Nulls: a NULL text counts as empty and scores its end. NULL ids count as training rows. Repeated
rows count each time. Without training rows every token has chance 1 (there is no other word).
An empty table gives an empty result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, placed, text_of
from txnmart.session import work_folder, written

ORDER = 2
#: Bytes of text whose n-grams share a bucket, and the least number of buckets.
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 8
#: Buckets of one table that a worker keeps mapped.
MAPPED = 4096
#: Tokens that a task counts at once.
TOKENS = 3_000_000
#: Tokens that a task scores at once, and words whose hash it keeps.
SCORED = 400_000
KNOWN_WORDS = 300_000
BEGIN = xxhash.xxh64_intdigest(b"\t")
END = xxhash.xxh64_intdigest(b"\n")
ROWS = "kind string, level int, bucket int, keys binary, counts binary"


def training(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 1, F.lit(True))


class Words:
    """Hashes of the words of texts."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        """The text's words and its end."""
        words = text.encode().lower().split()
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        out = np.empty(len(words) + 1, np.uint64)
        out[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        out[-1] = END
        return out


def mixed(words: np.ndarray) -> np.ndarray:
    """One hash for each column of ``words`` (place in the n-gram, n-gram)."""
    with np.errstate(over="ignore"):
        out = words[0] * np.uint64(0x9E3779B97F4A7C15)
        for row in words[1:]:
            out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + row
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return out ^ (out >> np.uint64(32))


def windows(tokens: list[np.ndarray], level: int) -> np.ndarray:
    """n-grams of ``level`` words that lie in one text, each text after a begin mark: (place, n-gram)."""
    begin = np.array([BEGIN], np.uint64)
    flat = np.concatenate([part for own in tokens for part in (begin, own)])
    lengths = np.fromiter((len(own) + 1 for own in tokens), np.int64, len(tokens))
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(flat))
    starts = np.flatnonzero(left >= level)
    return np.stack([flat[starts + k] for k in range(level)])


def summed(keys: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal keys as one, sorted; ``words`` (place, item) of the first, sums of ``counts`` (item, column)."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts[order], first, axis=0) if len(keys) else counts
    return keys[first], words[:, order[first]], sums


def dealt(kind: str, level: int, buckets: int, keys: np.ndarray, words: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
    """Rows for what lies in each bucket's range of keys."""
    keys, words, counts = summed(keys, words, counts)
    edges = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(edges)):
        part = slice(edges[bucket], edges[bucket + 1])
        some, own = words[:, part], counts[part]
        # n-grams with the same first word side by side, as runs take little room.
        order = np.argsort(some[0]) if len(some) > 1 else slice(None)
        yield {
            "kind": kind,
            "level": level,
            "bucket": int(bucket),
            "keys": packed(some[:, order]),
            "counts": packed(own[order].T),
        }


def packed(array: np.ndarray) -> bytes:
    """Whole numbers of 8 bytes, compressed, after their number of bytes."""
    raw = np.ascontiguousarray(array).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    raw = pa.Codec("zstd", 1).decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    return np.frombuffer(raw, np.uint64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("kind", pa.string()), ("level", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def counted(docs: DataFrame, order: int, buckets: int) -> DataFrame:
    """n-grams of ``order`` words, those shorter ones that begin a text, and single words (kind ``word``)."""

    def rows(texts: list[np.ndarray]) -> Iterator[dict]:
        flat = np.concatenate(texts)
        yield from dealt("word", 1, buckets, flat, flat[None, :], np.ones((len(flat), 1), np.uint64))
        for level in range(1, order + 1):
            grams = windows(texts, level)
            if level < order:
                grams = grams[:, grams[0] == np.uint64(BEGIN)] if level > 1 else grams[:, :0]
            yield from dealt("gram", level, buckets, mixed(grams), grams, np.ones((grams.shape[1], 1), np.uint64))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words(), [], 0
        for batch in batches:
            for value in batch.column("_text"):
                own = words.hashes(value.as_py())
                held.append(own)
                size += len(own)
                if size >= TOKENS:
                    yield from (_batch([row]) for row in rows(held))
                    held, size = [], 0
        if held:
            yield from (_batch([row]) for row in rows(held))

    return docs.select(text_of().alias("_text")).mapInArrow(mapped, ROWS)


def store(folder: str, name: str, array: np.ndarray) -> None:
    draft = f"{folder}/{name}.{uuid.uuid4().hex}"
    with open(draft, "wb") as out:
        np.save(out, array)
    os.replace(draft, f"{folder}/{name}.npy")


def _tally(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3, 4, and 3 or more."""
    return np.array([*((counts == n).sum() for n in (1, 2, 3, 4)), (counts >= 3).sum()], np.uint64)


def merged(rows: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Store each bucket of ``rows``; return rows for the next lower order and the contexts, and tallies."""

    def merge(table: pa.Table) -> pa.Table:
        kind, level, bucket = (table[name][0].as_py() for name in ("kind", "level", "bucket"))
        width = 1 if kind == "context" else level
        columns = 4 if kind == "context" else 1
        words = np.concatenate([unpacked(blob.as_py()).reshape(width, -1) for blob in table["keys"]], axis=1)
        counts = np.concatenate([unpacked(blob.as_py()).reshape(columns, -1).T for blob in table["counts"]])
        keys, words, counts = summed(mixed(words) if kind == "gram" else words[0], words, counts)
        name = f"{kind}-{level}-{bucket}"
        store(folder, f"{name}-keys", keys)
        small = counts.max(initial=0) < 1 << 32
        store(folder, f"{name}-counts", counts.astype(np.uint32 if small else np.uint64))
        out: list[dict] = []
        if kind != "context":
            own = counts[:, 0]
            tally = np.concatenate([_tally(own), [np.uint64(len(own)), own.sum()]]).astype(np.uint64)
            out.append({"kind": f"tally-{kind}", "level": level, "bucket": bucket, "keys": b"", "counts": tally.tobytes()})
        if kind == "gram" and level > 1:
            context = mixed(words[:-1])
            parts = np.stack([own, own == 1, own == 2, own >= 3], axis=1).astype(np.uint64)
            out += dealt("context", level, buckets, context, context[None, :], parts)
            lower = words[1:]
            out += dealt("gram", level - 1, buckets, mixed(lower), lower, np.ones((lower.shape[1], 1), np.uint64))
        return pa.Table.from_batches([_batch(out)])

    groups = ["kind", "level", "bucket"]
    return rows.repartition(buckets, *groups).groupBy(*groups).applyInArrow(merge, ROWS)


@dataclass
class Stored:
    """A model in a shared folder: its orders, buckets, and what the driver knows of its counts."""

    folder: str
    order: int
    buckets: int
    tallies: dict[tuple[str, int], list[int]]

    @property
    def tokens(self) -> int:
        return self.tallies.get(("word", 1), [0] * 7)[6]

    @property
    def vocabulary(self) -> int:
        return self.tallies.get(("word", 1), [0] * 7)[5]

    def discounts(self, level: int) -> np.ndarray:
        """By count 0, 1, 2, 3 and more. Without enough counts of counts: 1/2, 1 and 3/2."""
        n1, n2, n3, n4 = self.tallies.get(("gram", level), [0] * 7)[:4]
        if min(n1, n2, n3, n4) == 0:
            return np.array([0, 0.5, 1.0, 1.5])
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return np.array([0, *(min(max(d, 0.0), k) for k, d in enumerate(found, 1))])


def local_path(folder: str) -> str:
    """The mounted path of a shared folder."""
    parsed = urlparse(folder)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"the model needs a shared folder that executors have mounted, not {folder}")
    return unquote(parsed.path)


def train(docs: DataFrame, order: int = ORDER, buckets: int | None = None) -> Stored:
    """Count the n-grams of ``docs`` (all of its rows) and store the model.

    The number of buckets follows the size of the texts, so that a task which merges one holds equally much at any size.
    """
    spark = docs.sparkSession
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    folder = local_path(work_folder(spark, "ngrams"))
    os.makedirs(folder)
    counts = counted(docs, order, buckets)
    tallies: dict[tuple[str, int], list[int]] = {}
    later = None  # shorter n-grams that begin a text
    for level in range(order, 0, -1):
        if level == order:
            # The shorter n-grams wait in the table for their turn.
            counts = written(counts) if order > 2 else counts
            later = counts.filter(f"kind = 'gram' AND level < {order}") if order > 2 else None
            now = counts if order == 2 else counts.filter(f"kind = 'word' OR level = {order}")
        else:
            own = later.filter(F.col("level") == level) if later is not None else None
            now = passed.unionByName(own) if own is not None else passed
        out = written(merged(now, folder, buckets))
        for row in out.filter("kind LIKE 'tally-%'").collect():
            known = tallies.setdefault((row["kind"].removeprefix("tally-"), row["level"]), [0] * 7)
            for at, n in enumerate(np.frombuffer(row["counts"], np.uint64)):
                known[at] += int(n)
        passed = out.filter("kind NOT LIKE 'tally-%'")
    return Stored(folder, order, buckets, tallies)


class Table:
    """Sorted hashes and counts of all buckets of one kind, mapped when first asked."""

    def __init__(self, model: Stored, kind: str, level: int, columns: int):
        self.model, self.name, self.columns, self.maps = model, f"{kind}-{level}", columns, {}

    def _bucket(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        if bucket not in self.maps:
            if len(self.maps) >= MAPPED:
                self.maps.clear()
            path = f"{self.model.folder}/{self.name}-{bucket}"
            if os.path.exists(f"{path}-keys.npy"):
                self.maps[bucket] = tuple(np.load(f"{path}-{part}.npy", mmap_mode="r") for part in ("keys", "counts"))
            else:
                self.maps[bucket] = np.zeros(0, np.uint64), np.zeros((0, self.columns), np.uint32)
        return self.maps[bucket]

    def find(self, asked: np.ndarray) -> np.ndarray:
        """Counts (item, column) of each hash, 0 where it is unknown."""
        keys, back = np.unique(asked, return_inverse=True)
        out = np.zeros((len(keys), self.columns))
        edges = np.searchsorted(bucket_of(keys, self.model.buckets), np.arange(self.model.buckets + 1))
        for bucket in np.flatnonzero(np.diff(edges)):
            known, counts = self._bucket(int(bucket))
            some = keys[edges[bucket] : edges[bucket + 1]]
            at = np.searchsorted(known, some)
            hit = np.flatnonzero(at < len(known))
            hit = hit[known[at[hit]] == some[hit]]
            out[edges[bucket] + hit] = counts[at[hit]]
        return out[back]


class Reader:
    """Chances of tokens under a stored model."""

    def __init__(self, model: Stored):
        self.model = model
        self.words = Table(model, "word", 1, 1)
        self.grams = {level: Table(model, "gram", level, 1) for level in range(1, model.order + 1)}
        self.contexts = {level: Table(model, "context", level, 4) for level in range(2, model.order + 1)}
        self.discounts = {level: model.discounts(level) for level in range(1, model.order + 1)}

    def known(self, tokens: np.ndarray) -> np.ndarray:
        return self.words.find(tokens)[:, 0]

    def chances(self, texts: list[np.ndarray]) -> np.ndarray:
        """Chance of each token of the texts, given the tokens before it in its text."""
        model = self.model
        flat = np.concatenate(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        n1, n2, _, _, n3, kinds, total = model.tallies.get(("gram", 1), [0] * 7)
        d = self.discounts[1]
        chance = np.full(len(flat), 1 / (model.vocabulary + 1))
        if total:
            count = self.grams[1].find(mixed(flat[None, :]))[:, 0]
            chance = np.maximum(count - d[np.minimum(count, 3).astype(int)], 0) / total + (d[1:] @ [n1, n2, n3]) / total * chance
        for level in range(2, model.order + 1):
            # A text's first tokens see the begin mark and no further.
            at = np.flatnonzero(place + 1 >= level - 1)
            rows = [np.where(place[at] >= back, flat[at - np.minimum(place[at], back)], np.uint64(BEGIN)) for back in range(level - 1, -1, -1)]
            grams = np.stack(rows)
            count = self.grams[level].find(mixed(grams))[:, 0]
            of, one, two, more = self.contexts[level].find(mixed(grams[:-1])).T
            d = self.discounts[level]
            seen = of > 0
            left = np.maximum(count - d[np.minimum(count, 3).astype(int)], 0)
            lower = chance[at]
            chance[at[seen]] = (left[seen] + (d[1] * one + d[2] * two + d[3] * more)[seen] * lower[seen]) / of[seen]
        return chance


def score(docs: DataFrame, model: Stored) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10 chance of the text), perplexity, and place."""
    names = ["n_tokens", "n_known", "base_score", "score"]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, reader = Words(), Reader(model)
        floor = model.tokens + 0.5 * (model.vocabulary + 1)
        for batch in batches:
            texts = [words.hashes(value.as_py()) for value in batch.column("_text")]
            ends = np.cumsum([len(own) for own in texts])
            out, at = {name: np.zeros(len(texts)) for name in names}, 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SCORED, "right")))
                some = texts[at:to]
                starts = np.cumsum([0, *map(len, some[:-1])])
                seen = reader.known(np.concatenate(some))
                out["n_tokens"][at:to] = [len(own) for own in some]
                out["n_known"][at:to] = np.add.reduceat((seen > 0).astype(float), starts)
                out["base_score"][at:to] = np.add.reduceat(np.log10((seen + 0.5) / floor), starts)
                out["score"][at:to] = np.add.reduceat(np.log10(reader.chances(some)), starts)
                at = to
            columns = [batch.column("doc_id"), *map(batch.column, PLACE)]
            columns += [pa.array(out[name].astype(np.int64) if name.startswith("n_") else out[name]) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *PLACE, *names])

    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    scored = rows.mapInArrow(mapped, "doc_id long, _file string, _row long, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
