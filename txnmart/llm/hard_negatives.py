"""Hard negatives by a vertical scan: dimensions one after the other, with bounds on what is left.

Vectors are held in columns, by blocks of ``ROWS`` rows, with the least and the largest component of every dimension of the
block. For an anchor, a block's dimensions are read in descending magnitude of the anchor's components. After each few
dimensions, the partial product plus the least and the largest that the remaining dimensions can still add bounds every
row's score, and a bitmap keeps the candidates whose bounds still allow them into the result. Twice so: at
first among rows of the anchor's label for the ``POSITIVES`` best, then among rows of other labels for each positive's window
of scores, until scores are exact. The best of all blocks are ranked once more.

Anchors are a stated set of queries, compared with all rows in blocks: chunks of ``ANCHORS`` anchors meet blocks of rows
by an equi-join on both numbers, so a task holds one pair of them at a time, and no label, however common, meets one task.

Nulls: rows with a NULL id, label or vector, or with any NULL or non-finite component, take no part, nor do empty vectors. Vectors
are compared with vectors of their own length. Scores are exact in 64 bits, so rows with a scaled component of 2^24 or more
in magnitude, or with over 2^14 components, take no part either. Repeated rows are told apart: a copy of an anchor is
another row, of equal scores and ids the earlier row comes first, and anchors with one
id answer one by one. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmart.session import written

POSITIVES = 5
NEGATIVES = 10
#: Least and largest negative score, in hundredths of the positive's.
LEAST, MOST = 30, 90
SCALE = 256
ROWS = 4_096
ANCHORS = 1_024
#: Dimensions read between two looks at the bounds.
STEP = 8
LARGEST, LONGEST = 1 << 24, 1 << 14
PACKED = "width int, n int, ids binary, places binary, labels binary, known binary, x binary"
FOUND = "anchor_id long, anchor long, number int, positive_id long, positive_score long, id long, place long, score long"


def vectors(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: id, label, a unique number ``place``, the scaled components x and their number ``width``."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("raw"),
    )
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < LARGEST))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.size("raw").between(1, LONGEST) & finite)
    x = F.transform("raw", lambda x: F.floor(x * SCALE).cast("int"))
    return rows.select("id", "label", F.monotonically_increasing_id().alias("place"), x.alias("x"), F.size("raw").alias("width"))


class Columns:
    """A block of rows of one width: their ids, places, labels and components by dimension."""

    def __init__(self, row: dict):
        n = row["n"]
        self.ids, self.places, self.labels = (np.frombuffer(row[name], np.int64) for name in ("ids", "places", "labels"))
        self.x = np.ascontiguousarray(np.frombuffer(row["x"], np.int32).reshape(n, -1).T)
        self.least, self.most = self.x.min(axis=1).astype(np.int64), self.x.max(axis=1).astype(np.int64)
        self.of_label = {int(label): self.labels == label for label in np.unique(self.labels)}

    def labelled(self, label: int) -> np.ndarray:
        return self.of_label.get(label, np.zeros(len(self.ids), bool))

    def scan(self, anchor: np.ndarray, some: np.ndarray, prune: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap ``some`` that stay, and their scores.

        ``prune`` gets the least and the largest possible scores of the rows still in, and tells which stay.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        weight = anchor[order].astype(np.int64)
        ends = np.sort(np.stack([weight * self.least[order], weight * self.most[order]]), axis=0)
        left = np.zeros((2, len(order) + 1), np.int64)
        left[:, :-1] = ends[:, ::-1].cumsum(axis=1)[:, ::-1]
        rows = np.flatnonzero(some)
        score = np.zeros(len(rows), np.int64)
        for at in range(0, len(order), STEP):
            upto = min(at + STEP, len(order))
            for k in range(at, upto):
                column = self.x[order[k]]
                score += weight[k] * (column if len(rows) == len(column) else column[rows])
            stay = prune(score + left[0, upto], score + left[1, upto])
            rows, score = rows[stay], score[stay]
            if not len(rows):
                break
        return rows, score

    def best(self, rows: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.lexsort((self.places[rows], self.ids[rows], -score))[:keep]
        return rows[at], score[at]


def _kth(values: np.ndarray, k: int) -> int:
    """The k-th largest value; the least integer if there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else np.iinfo(np.int64).min


def positives_in(block: Columns, anchor: np.ndarray, label: int, place: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the ``keep`` best rows of the anchor's label but itself."""
    some = block.labelled(label) & (block.places != place)
    return block.best(*block.scan(anchor, some, lambda least, most: most >= _kth(least, keep)), keep)


def negatives_in(
    block: Columns, anchor: np.ndarray, label: int, windows: Sequence[tuple[int, int]], keep: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and scores of the ``keep`` best rows of other labels in each window (least, largest score)."""

    def prune(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(least), bool)
        for low, high in windows:
            sure = least[(least >= low) & (most <= high)]
            stay |= (most >= max(low, _kth(sure, keep))) & (least <= high)
        return stay

    rows, score = block.scan(anchor, ~block.labelled(label), prune)
    inside = [(score >= low) & (score <= high) for low, high in windows]
    return [block.best(rows[own], score[own], keep) for own in inside]


def _packed(rows: DataFrame, size: int, number: str) -> DataFrame:
    """Rows of equal width in blocks of at most ``size`` rows, one row for each block, with a number."""

    def packed(width: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts)
        own = {name: whole.column(name).to_numpy().astype(np.int64).tobytes() for name in ("id", "place", "label")}
        lists = {name: whole.column(name).combine_chunks().flatten().to_numpy() for name in ("known", "x")}
        known, x = lists["known"].astype(np.int64).tobytes(), lists["x"].astype(np.int32).tobytes()
        values = [width, whole.num_rows, own["id"], own["place"], own["label"], known, x]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        arrays = [pa.array([value], kind) for value, kind in zip(values, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["width", "n", "ids", "places", "labels", "known", "x"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                own = batch.filter(pa.array(widths == width))
                while own.num_rows:
                    parts = held.setdefault(width, [])
                    parts.append(own.slice(0, size - sum(part.num_rows for part in parts)))
                    own = own.slice(parts[-1].num_rows)
                    if sum(part.num_rows for part in parts) == size:
                        yield packed(width, held.pop(width))
        for width, parts in held.items():
            yield packed(width, parts)

    blocks = rows.select("width", "id", "place", "label", "known", "x").mapInArrow(pack, PACKED)
    return written(blocks.withColumn(number, F.monotonically_increasing_id()))


def _pairs(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Each chunk of anchors beside each block of rows of its width, joined on both numbers."""
    numbers = written(blocks.select("width", "block").join(chunks.select("width", "chunk"), "width"))
    count = max(1, min(numbers.count(), 100_000))

    def side(df: DataFrame, number: str, name: str) -> DataFrame:
        own = df.select(number, F.struct("n", "ids", "places", "labels", "known", "x").alias(name))
        return numbers.select("block", "chunk").join(own, number).repartition(count, "block", "chunk")

    # Merge join: neither side is ever broadcast, whatever its size.
    return side(blocks, "block", "rows").hint("merge").join(side(chunks, "chunk", "anchors"), ["block", "chunk"]).select("rows", "anchors")


def _scanned(pairs: DataFrame, find: Callable) -> DataFrame:
    """What ``find`` finds in each block for each anchor: positive's number, id and score, rows, scores."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows, anchors = batch.column("rows")[at].as_py(), batch.column("anchors")[at].as_py()
                block = Columns(rows)
                n = anchors["n"]
                ids, places, labels = (np.frombuffer(anchors[name], np.int64) for name in ("ids", "places", "labels"))
                known = np.frombuffer(anchors["known"], np.int64).reshape(n, -1)
                x = np.frombuffer(anchors["x"], np.int32).reshape(n, -1)
                for a in range(n):
                    for number, positive, score, own, scores in find(block, x[a], int(labels[a]), int(places[a]), known[a]):
                        fixed = [ids[a], places[a], number, positive, score]
                        columns = [pa.array(np.full(len(own), value), field.type) for value, field in zip(fixed, schema, strict=False)]
                        columns += [pa.array(column) for column in (block.ids[own], block.places[own], scores)]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    kinds = [pa.int32() if name == "number int" else pa.int64() for name in FOUND.split(", ")]
    schema = pa.schema([(name.split()[0], kind) for name, kind in zip(FOUND.split(", "), kinds, strict=True)])
    return pairs.mapInArrow(mapped, FOUND)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """Of each anchor and each of its positives the best negatives.

    ``rows`` come from `vectors`, written; ``anchors`` are some of them. A negative scores from ``least`` to ``most``
    hundredths of the positive's score.
    """

    def best(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "place")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)

    def find_positives(block, x, label, place, known):
        yield (0, 0, 0, *positives_in(block, x, label, place, positives))

    def find_negatives(block, x, label, place, known):
        pairs = known.reshape(-1, 2)[: int(known[-2])].tolist()
        windows = [(-(-least * score // 100), most * score // 100) for _, score in pairs]
        for number, (own, scores) in enumerate(negatives_in(block, x, label, windows, negatives)):
            yield (number, *pairs[number], own, scores)

    none = F.array().cast("array<bigint>").alias("known")
    blocks = _packed(rows.select("*", none), ROWS, "block")
    chunks = _packed(anchors.select("*", none), ANCHORS, "chunk")
    nearest = best(_scanned(_pairs(blocks, chunks), find_positives), ["anchor"], positives)
    # Each anchor's list has ids and scores of its positives, at most `positives`, room for the rest, and their number.
    own = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))), lambda p: F.array(p["id"], p["score"])))
    room = F.array_repeat(F.lit(0).cast("bigint"), F.lit(2 * positives) - 2 * F.count("*").cast("int"))
    known = F.concat(own, room, F.array(F.count("*"), F.lit(0).cast("bigint"))).alias("known")
    asked = anchors.join(nearest.groupBy("anchor").agg(known), F.col("place") == F.col("anchor"))
    found = best(_scanned(_pairs(blocks, _packed(asked, ANCHORS, "chunk")), find_negatives), ["anchor", "number"], negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def prepared(rows: DataFrame) -> DataFrame:
    """`vectors` as a table, so that their places stay."""
    return written(vectors(rows))
