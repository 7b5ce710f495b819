"""SimHash near-duplicates by the generalised pigeonhole principle.

Equal fingerprints fold into one class first. Their 64 bits are put into parts so that
correlated bits share a part. For each fingerprint, a dynamic programme then allots a distance
to every part so that the estimated work is least: the distances sum up to ``distance - parts + 1``
(-1 leaves a part out), so that any fingerprint within ``distance`` bits must lie within the
allotted distance in at least one part. Candidate counts are estimated from histograms of all
classes over blocks of up to eight bits, taken as independent within a part. Each fingerprint
probes the index of part values with every value in reach; candidates are verified on all bits.

Rows that meet under one part value are compared in blocks, and only a spanning forest of what
links is emitted. Part values with very many index rows are split into chunks that meet the
probes one by one, so no task holds more than a chunk, and no link is lost.

Nulls: a NULL text counts as empty, and texts without words have fingerprint zero, which links
like any other. A component whose ids are all NULL has a NULL id. Repeated rows share a class. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, placed, text_of
from txnmart.llm.components import roots
from txnmart.session import written

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Index rows of one part value that one task holds; more are split into chunks.
CHUNK = 4096
PAIRS = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text: bit i is set if over half of the shingles' hashes set it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    count = max(1, len(words) - shingle + 1)
    starts = (ends - lengths)[:count].tolist()
    stops = ends[-count:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        octets = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and place of each row."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary())
            found = np.fromiter((fingerprint(text.as_py(), shingle) for text in texts), np.uint64, len(texts))
            columns = [batch.column("doc_id"), *map(batch.column, PLACE), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *PLACE, "fp"])

    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    return rows.mapInArrow(mapped, "doc_id long, _file string, _row long, fp long")


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def co_occurrence(classes: DataFrame) -> np.ndarray:
    """How many fingerprints set both bit i and bit j; 64 x 64 sums, added up by Spark."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for batch in batches:
            bits = _bits(batch.column("fp").to_numpy()).astype(np.float32)
            total += bits.T @ bits
        at = np.arange(4096)
        yield pa.RecordBatch.from_pydict({"at": at, "n": total.ravel().astype(np.int64)})

    sums = classes.select("fp").mapInArrow(mapped, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(4096)
    for row in sums.collect():
        out[row["at"]] = row["n"]
    return out.reshape(64, 64)


def grouped_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of nearly equal size, correlated bits together.

    A group starts with the free bit that is most correlated with the other free bits, and takes
    the bit with the largest mean correlation to it until it is full.
    """
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(share * (1 - share))
    with np.errstate(divide="ignore", invalid="ignore"):
        related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    related = np.nan_to_num(related, nan=0.0, posinf=0.0)
    np.fill_diagonal(related, 0.0)
    free, groups = list(range(64)), []
    for part in range(parts):
        size = 64 // parts + (part < 64 % parts)
        group = [max(free, key=lambda bit: (related[bit, free].sum(), -bit))]
        free.remove(group[0])
        while len(group) < size:
            bit = max(free, key=lambda bit: (related[bit, group].mean(), -bit))
            group.append(bit)
            free.remove(bit)
        groups.append(sorted(group))
    return groups


def parts_for(n: int, distance: int) -> int:
    """Number of parts with the least work for n evenly spread fingerprints: probes, and candidates."""

    def work(parts: int) -> float:
        width, sum_of = 64 / parts, distance - parts + 1
        each = [sum_of // parts + (i < sum_of % parts) for i in range(parts)]
        probes = sum(sum(math.comb(round(width), k) for k in range(r + 1)) for r in each if r >= 0)
        return probes * (1 + n / 2**width)

    return min(range(1, min(distance + 1, 8) + 1), key=work) if distance else 1


class Plan:
    """Parts of bits, blocks of up to eight bits in them, and how many fingerprints have each block value."""

    def __init__(self, groups: list[list[int]], distance: int):
        self.groups, self.distance = groups, distance
        self.blocks = [[group[i : i + 8] for i in range(0, len(group), 8)] for group in groups]
        self.n, self.near = 0, []
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def values(self, fps: np.ndarray, bits: list[int]) -> np.ndarray:
        """The value of ``bits`` in each fingerprint, as a number of as many bits."""
        out = np.zeros(len(fps), np.uint64)
        fps = fps.view(np.uint64)
        for at, bit in enumerate(bits):
            out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(at)
        return out

    def count(self, classes: DataFrame) -> None:
        """Fill the histograms over all classes; at most 256 counts a block."""
        flat = [block for part in self.blocks for block in part]

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(flat), 256), np.int64)
            for batch in batches:
                fps = batch.column("fp").to_numpy()
                for at, block in enumerate(flat):
                    total[at] += np.bincount(self.values(fps, block).astype(np.int64), minlength=256)
            yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "n": total.ravel()})

        sums = classes.select("fp").mapInArrow(mapped, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
        counts = np.zeros(len(flat) * 256)
        for row in sums.collect():
            counts[row["at"]] = row["n"]
        self.n = int(counts[:256].sum())
        apart = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])
        near = iter(
            np.stack([(apart == d) @ (hist / max(self.n, 1)) for d in range(self.distance + 1)], axis=1)
            for hist in counts.reshape(-1, 256)
        )
        self.near = [[next(near) for _ in part] for part in self.blocks]

    def candidates(self, fps: np.ndarray) -> np.ndarray:
        """Estimated fingerprints within each distance 0.. in each part: (fingerprint, part, distance)."""
        out = np.empty((len(fps), len(self.groups), self.distance + 1))
        for part, blocks in enumerate(self.blocks):
            total = np.zeros((len(fps), self.distance + 1))
            total[:, 0] = 1.0
            for block, near in zip(blocks, self.near[part], strict=True):
                own = near[self.values(fps, block).astype(np.int64)]
                total = np.stack(
                    [sum(total[:, a] * own[:, d - a] for a in range(d + 1)) for d in range(self.distance + 1)], axis=1
                )
            out[:, part] = self.n * np.cumsum(total, axis=1)
        return out

    def allot(self, fps: np.ndarray) -> np.ndarray:
        """Distance of each part, -1 to leave it out, with the least estimated probes and candidates."""
        parts, top = len(self.groups), self.distance
        work = self.candidates(fps)
        for part, group in enumerate(self.groups):
            work[:, part] += np.cumsum([math.comb(len(group), k) for k in range(top + 1)])
        # A part takes 0 (left out) or 1 + its distance; together distance + 1.
        best = np.full((len(fps), top + 2), np.inf)
        best[:, 0] = 0.0
        choices = []
        for part in range(parts):
            cost = np.concatenate([np.zeros((len(fps), 1)), work[:, part]], axis=1)
            total = np.full_like(best, np.inf)
            choice = np.zeros(best.shape, np.int64)
            for units in range(top + 2):
                options = np.stack([best[:, units - own] + cost[:, own] for own in range(units + 1)], axis=1)
                choice[:, units] = options.argmin(axis=1)
                total[:, units] = options.min(axis=1)
            best = total
            choices.append(choice)
        left = np.full(len(fps), top + 1)
        out = np.empty((len(fps), parts), np.int64)
        for part in reversed(range(parts)):
            own = choices[part][np.arange(len(fps)), left]
            out[:, part] = own - 1
            left = left - own
        return out

    def reach(self, part: int, distance: int) -> np.ndarray:
        """All changes of a part's value by up to ``distance`` bits."""
        if (part, distance) not in self.masks:
            width = len(self.groups[part])
            changes = [sum(1 << bit for bit in c) for k in range(distance + 1) for c in combinations(range(width), k)]
            self.masks[part, distance] = np.array(changes, np.uint64)
        return self.masks[part, distance]

    def keys(self, part: int, values: np.ndarray) -> np.ndarray:
        """Part values of all parts as one number: mixed, so that nearby values spread over the tasks."""
        with np.errstate(over="ignore"):
            mixed = (values + np.uint64(part + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            return (mixed ^ (mixed >> np.uint64(29)) ^ np.uint64(part)).view(np.int64)


def indexed(classes: DataFrame, plan: Plan) -> DataFrame:
    """(key, fp) for each part of each class."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for part, group in enumerate(plan.groups):
                yield pa.RecordBatch.from_pydict({"key": plan.keys(part, plan.values(fps, group)), "fp": fps})

    return classes.select("fp").mapInArrow(mapped, "key long, fp long")


def probed(classes: DataFrame, plan: Plan) -> DataFrame:
    """(key, fp) for each part value in the reach that the plan allots to each class."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            allotted = plan.allot(fps)
            for part, group in enumerate(plan.groups):
                for distance in range(plan.distance + 1):
                    own = fps[allotted[:, part] == distance]
                    masks = plan.reach(part, distance) if len(own) else ()
                    step = max(1, (1 << 18) // max(1, len(masks)))
                    for at in range(0, len(own), step):
                        some = own[at : at + step]
                        values = plan.values(some, group)[:, None] ^ masks[None, :]
                        keys = plan.keys(part, values.ravel())
                        yield pa.RecordBatch.from_pydict({"key": keys, "fp": np.repeat(some, len(masks))})

    return classes.select("fp").mapInArrow(mapped, "key long, fp long")


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked nodes the same, smallest label."""
    while True:
        a, b = labels[a], labels[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def linked(units: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that span what lies within ``distance`` bits under each unit.

    ``units`` (unit, probe, fp) is dealt by unit and sorted by unit and probe, so the index rows of
    a unit come before its probes and are held while these stream by.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        held_unit = None
        for batch in batches:
            if not batch.num_rows:
                continue
            unit, fps = batch.column("unit").to_numpy(), batch.column("fp").to_numpy()
            probe = batch.column("probe").to_numpy(zero_copy_only=False).astype(bool)
            if held_unit != unit[0]:
                held = held[:0]
            index_units = np.concatenate([np.full(len(held), unit[0], np.int64), unit[~probe]])
            index = np.concatenate([held, fps[~probe]])
            asked = fps[probe]
            low = np.searchsorted(index_units, unit[probe], "left")
            many = np.searchsorted(index_units, unit[probe], "right") - low
            some = many > 0
            asked, low, many = asked[some], low[some], many[some]
            held_unit, held = unit[-1], index[index_units == unit[-1]]
            if not len(asked):
                continue
            nodes, places = np.unique(np.concatenate([asked, index]), return_inverse=True)
            of_asked, of_index = places[: len(asked)], places[len(asked) :]
            labels = np.arange(len(nodes))
            ends = np.cumsum(many)
            at = 0
            while at < len(asked):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
                counts = many[at:to]
                left = np.repeat(np.arange(at, to), counts)
                right = np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[at:to], counts)
                near = np.bitwise_count((asked[left] ^ index[right]).view(np.uint64)) <= distance
                _joined(labels, of_asked[left[near]], of_index[right[near]])
                at = to
            child = np.flatnonzero(labels != np.arange(len(nodes)))
            yield pa.RecordBatch.from_pydict({"a": nodes[child], "b": nodes[labels[child]]})

    return units.mapInArrow(mapped, "a long, b long")


def links(classes: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between the different fingerprints of ``classes`` (fp) that span every near pair."""
    n = classes.count()
    plan = Plan(grouped_bits(co_occurrence(classes), n, parts_for(n, distance)), distance)
    plan.count(classes)
    index = indexed(classes, plan).withColumn("probe", F.lit(False))
    probes = probed(classes, plan).withColumn("probe", F.lit(True))
    crowded = written(
        index.groupBy("key").agg(F.count("*").alias("_n")).filter(F.col("_n") > chunk)
        .select("key", F.ceil(F.col("_n") / chunk).alias("_chunks"))
    )
    if not crowded.isEmpty():
        any_chunk = F.array(F.pmod(F.xxhash64("fp"), F.col("_chunks")))
        every = F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)

        def dealt(rows: DataFrame, chunks) -> DataFrame:
            known = rows.join(crowded, "key", "left")
            known = known.withColumn("_chunk", F.explode(F.when(F.col("_chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(chunks)))
            unit = F.when(F.col("_chunk") == 0, F.col("key")).otherwise(F.xxhash64("key", "_chunk"))
            return known.select(unit.alias("unit"), "probe", "fp")

        units = dealt(index, any_chunk).unionByName(dealt(probes, every))
    else:
        units = index.unionByName(probes).withColumnRenamed("key", "unit")
    return linked(units.repartition("unit").sortWithinPartitions("unit", "probe"), distance)


def components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """One row per document with its place: doc_id, fp, component_id, kept (the first of its component).

    The first is the row with the smallest id, NULL last, then the smallest place.
    """
    rows = written(fingerprints(docs, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *PLACE)).alias("first")
    classes = written(rows.groupBy("fp").agg(first))
    tree = roots(links(classes, distance, chunk))
    rooted = classes.join(tree, classes["fp"] == tree["node"], "left")
    rooted = written(rooted.select("fp", F.coalesce("root", "fp").alias("root"), "first"))
    heads = written(rooted.groupBy("root").agg(F.min("first").alias("head")))
    labels = written(rooted.select("fp", "root").join(heads, "root").select("fp", "head"))
    return rows.join(labels, "fp").select(
        "doc_id",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        (F.struct(*PLACE) == F.struct(*(F.col("head")[c] for c in PLACE))).alias("kept"),
        *PLACE,
    )
