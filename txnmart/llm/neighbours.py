"""Approximate nearest neighbours by cosine: NN-descent builds a graph, greedy search walks it.

Equal vectors fold into one node, so copies cost nothing; a node keeps its smallest ids, as many
as a result can hold. The graph starts from brute force inside small buckets of several random
hyperplane hashes. Then each round joins every node's best neighbours and the nodes that have it
among theirs, with their vectors, and compares them with each other: neighbours of neighbours.
What beats the worst entry of a node's list enters it, until few lists change. A node with very
many reverse neighbours is split into chunks, other ones in each round, each with the whole forward list.
The start is small: a bucket of over ``LARGEST`` is dealt at random into blocks, other ones in each hash
table, and only members of a block are compared. So a dense group of any size costs the start and each
round in proportion to its size, and the rounds find the pairs that no block held.

Queries start from their own lists, or from pivots, and walk the graph: each round joins
the best unvisited nodes of each query's beam with their neighbours, until a beam has no unvisited
node left. Scores of results are cosines of the original vectors in double precision.

Vectors of different lengths have no cosine: those of each length are searched among themselves.

Nulls: vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do rows
with NULL ids. Ties go to the smaller id. A row repeated with its
id is one vector. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmart.session import written

NEAREST = 5
DEGREE = 20
#: Best neighbours of a node that take part in a round.
JOINED = 20
CHUNK = 64
TABLES = 12
BUCKET = 256
LARGEST = 1024
#: Nearest of a bucket that a node's list starts from.
STARTS = 8
#: A round that changes less than this share of all list entries is the last.
CHANGE = 0.01
#: Rounds after which the lists are taken as they are.
ROUNDS = 20
BEAM = 400
EXPANDED = 48
PIVOTS = 16
SPREAD = 48
SEED = 11

EDGES = "id long, other long, sim float"


def _vectors(column: pa.ChunkedArray | pa.Array, kind: type = np.float32) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float32, copy=False)


def halved(nodes: DataFrame) -> DataFrame:
    """The nodes' vectors in 2-byte floats, which is enough to find neighbours; search scores anew."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("vec")).astype(np.float16) if batch.num_rows else ()
            blobs = pa.array([row.tobytes() for row in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), blobs], names=["node", "vec"])

    return nodes.select("node", "vec").mapInArrow(mapped, "node long, vec binary")


def _best(ids: np.ndarray, others: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` nearest different others of each id; ties to the smaller other."""
    order = np.lexsort((others, -sims, ids))
    ids, others = ids[order], others[order]
    # Equal pairs have equal scores but for rounding; the better of them comes first.
    pair = np.lexsort((np.arange(len(ids)), others, ids))
    again = np.zeros(len(ids), bool)
    again[pair[1:]] = (ids[pair[1:]] == ids[pair[:-1]]) & (others[pair[1:]] == others[pair[:-1]])
    order, ids = order[~again], ids[~again]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    rank = np.arange(len(ids)) - np.repeat(first, np.diff(np.concatenate([first, [len(ids)]])))
    return order[rank < keep]


def _pairs(ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Of all pairs in a group: those that beat the first one's floor, the best ``keep`` of each."""
    sims = vectors @ vectors.T
    sims[ids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > keep:
        floors = np.maximum(floors, np.partition(sims, len(ids) - keep, axis=1)[:, len(ids) - keep])
        a, b = np.nonzero(sims >= floors[:, None])
    else:
        a, b = np.nonzero(sims > floors[:, None])
    return ids[a], ids[b], sims[a, b]


def _edges(ids: np.ndarray, others: np.ndarray, sims: np.ndarray) -> pa.Table:
    return pa.table({"id": ids, "other": others, "sim": pa.array(sims.astype(np.float32))})


def nodes_of(embeddings: DataFrame, nearest: int = NEAREST) -> tuple[DataFrame, DataFrame]:
    """Members (node, vec_id; the smallest ids of each) and nodes (node, vec: unit vector in 4-byte floats, raw: doubles)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("raw"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("raw").isNotNull() & finite & F.exists("raw", lambda x: x != 0))
    rows = rows.withColumn("node", F.xxhash64("raw")).dropDuplicates(["node", "vec_id"])
    order = Window.partitionBy("node").orderBy("vec_id")
    members = written(rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= nearest + 1))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw")
            if not len(raw):
                continue
            values = np.array(raw.flatten().to_numpy(), np.float64).reshape(len(raw), -1)
            unit = values / np.abs(values).max(axis=1, keepdims=True)
            unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)
            columns = [pa.array([row.tobytes() for row in own], pa.binary()) for own in (unit, values)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], names=["node", "vec", "raw"])

    nodes = members.filter("_n = 1").select("node", "raw").mapInArrow(mapped, "node long, vec binary, raw binary")
    return members.select("node", "vec_id"), written(nodes)


def _groups(n: int) -> int:
    return max(1, n // SPREAD)


def nearest_lists(edges: DataFrame, groups: int, keep: int = DEGREE) -> DataFrame:
    """The ``keep`` nearest of each id."""

    def merge(table: pa.Table) -> pa.Table:
        ids, others, sims = (table[name].to_numpy() for name in ("id", "other", "sim"))
        at = _best(ids, others, sims, keep)
        return _edges(ids[at], others[at], sims[at])

    keyed = edges.withColumn("_g", F.pmod(F.xxhash64("id"), F.lit(groups)))
    return keyed.groupBy("_g").applyInArrow(merge, EDGES)


def hashed(nodes: DataFrame, n: int, tables: int = TABLES, keep: int = STARTS) -> DataFrame:
    """Edges from brute force in the buckets of random hyperplane hashes, and in random blocks of large buckets."""
    bits = max(0, int(np.ceil(np.log2(max(1, n / BUCKET)))))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column("vec"), np.float16)
            planes = np.random.default_rng(SEED).standard_normal((vectors.shape[1], tables * bits)).astype(np.float32)
            signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
            code = signs @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros((len(vectors), tables), np.int64)
            for table in range(tables if bits else 1):
                names = ["node", "vec", "code"]
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("vec"), pa.array(code[:, table] * tables + table)], names=names)

    coded = halved(nodes).mapInArrow(codes, "node long, vec binary, code long")
    sizes = written(coded.groupBy("code").agg(F.ceil(F.count("*") / LARGEST).alias("_parts")))
    # The code holds the table number, so a node's block differs from table to table.
    blocks = coded.join(sizes, "code").withColumn("_part", F.pmod(F.xxhash64("node", "code"), F.col("_parts")))
    groups = _groups(n * tables)
    blocks = blocks.select("node", "vec", "code", "_part", F.pmod(F.xxhash64("code", "_part"), F.lit(groups)).alias("_g"))

    def brute(table: pa.Table) -> pa.Table:
        codes, part, ids = (table[name].to_numpy() for name in ("code", "_part", "node"))
        vectors = _vectors(table["vec"], np.float16)
        order = np.lexsort((part, codes))
        cut = np.flatnonzero(np.diff(codes[order]) | np.diff(part[order])) + 1
        found = [_pairs(ids[own], vectors[own], np.full(len(own), -2.0, np.float32), keep) for own in np.split(order, cut)]
        return _edges(*(np.concatenate(column) for column in zip(*found, strict=True)))

    return blocks.groupBy("_g").applyInArrow(brute, EDGES)


def descended(nodes: DataFrame, edges: DataFrame, n: int, keep: int = DEGREE, joined: int = JOINED, turn: int = 0) -> DataFrame:
    """Edges found by one round: each list's best, and their reverse, compared with each other.

    ``turn`` deals the reverse neighbours of a hub to other chunks in each round.
    """
    groups = _groups(n)
    best = written(nearest_lists(edges, groups, joined).select("id", "other"))
    counts = written(best.groupBy("other").agg(F.ceil(F.count("*") / CHUNK).alias("_parts")).withColumnRenamed("other", "center"))
    back = best.select(F.col("other").alias("center"), F.col("id").alias("member")).join(counts, "center")
    back = back.select("center", F.pmod(F.xxhash64("member", "center", F.lit(turn)), F.col("_parts")).alias("_part"), "member")
    ahead = best.select(F.col("id").alias("center"), F.col("other").alias("member")).join(counts, "center", "left")
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1).cast("long")) - 1)
    ahead = ahead.select("center", F.explode(parts).alias("_part"), "member")
    floors = edges.groupBy("id").agg(F.when(F.count("*") >= keep, F.min("sim")).otherwise(F.lit(-2.0).cast("float")).alias("floor"))
    known = halved(nodes).join(floors, F.col("node") == F.col("id"), "left")
    known = written(known.select(F.col("node").alias("member"), "vec", F.coalesce("floor", F.lit(-2.0).cast("float")).alias("floor")))
    members = ahead.unionByName(back).join(known, "member")
    members = members.withColumn("_g", F.pmod(F.xxhash64("center", "_part"), F.lit(groups)))

    def compare(table: pa.Table) -> pa.Table:
        centers, part, ids = (table[name].to_numpy() for name in ("center", "_part", "member"))
        vectors, floor = _vectors(table["vec"], np.float16), table["floor"].to_numpy()
        order = np.lexsort((part, centers))
        cut = np.flatnonzero(np.diff(centers[order]) | np.diff(part[order])) + 1
        found = []
        for own in np.split(order, cut):
            some, first = np.unique(ids[own], return_index=True)
            at = own[first]
            found.append(_pairs(some, vectors[at], floor[at], keep))
        a, b, sims = (np.concatenate(column) for column in zip(*found, strict=True))
        at = _best(a, b, sims, keep)
        return _edges(a[at], b[at], sims[at])

    return members.groupBy("_g").applyInArrow(compare, EDGES)


def graph(nodes: DataFrame, rounds: int = ROUNDS, keep: int = DEGREE) -> DataFrame:
    """(id, other, sim): the neighbour lists of all nodes."""
    n = nodes.count()
    groups = _groups(n)
    edges = written(nearest_lists(hashed(nodes, n), groups, keep))
    for turn in range(rounds):
        found = descended(nodes, edges, n, keep, turn=turn)
        after = written(nearest_lists(edges.unionByName(found), groups, keep))
        changed = after.join(edges, ["id", "other"], "left_anti").count()
        edges = after
        if changed <= CHANGE * n * keep:
            break
    return edges


def search(nodes: DataFrame, edges: DataFrame, queries: DataFrame, seeds: DataFrame, beam: int = BEAM) -> DataFrame:
    """(query, id, sim): the beam of each query after greedy search from ``seeds`` (query, id).

    ``queries`` (query, qvec) hold unit vectors like those of the nodes.
    """
    groups = max(1, queries.count() // SPREAD)
    both = edges.unionByName(nearest_lists(edges.select(F.col("other").alias("id"), F.col("id").alias("other"), "sim"), _groups(nodes.count())))
    steps = written(both.select("id", "other").distinct())
    vectors = nodes.select(F.col("node").alias("id"), "vec")
    schema = "query long, id long, sim float, visited boolean, next boolean"

    def advance(table: pa.Table) -> pa.Table:
        kept = table.filter(pc.is_valid(table["sim"]))
        fresh = table.filter(pc.is_valid(table["vec"]))
        asking = table.filter(pc.is_valid(table["qvec"]))
        query, ids, sims = (kept[name].to_numpy() for name in ("query", "id", "sim"))
        visited = kept["visited"].to_numpy() | kept["next"].to_numpy()
        if len(fresh):
            own = asking["query"].to_numpy()
            order = np.argsort(own)
            which = order[np.searchsorted(own[order], fresh["query"].to_numpy())]
            found = np.einsum("ij,ij->i", _vectors(asking["qvec"])[which], _vectors(fresh["vec"]))
            query, ids = np.concatenate([query, fresh["query"].to_numpy()]), np.concatenate([ids, fresh["id"].to_numpy()])
            sims = np.concatenate([sims, found.astype(np.float32)])
            visited = np.concatenate([visited, np.zeros(len(found), bool)])
        # A pair that is known already counts as it is known.
        first = np.lexsort((~visited, ids, query))
        query, ids, sims, visited = query[first], ids[first], sims[first], visited[first]
        new = np.concatenate([[True], (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])]) if len(ids) else np.zeros(0, bool)
        query, ids, sims, visited = query[new], ids[new], sims[new], visited[new]
        at = _best(query, ids, sims, beam)
        query, ids, sims, visited = query[at], ids[at], sims[at], visited[at]
        ahead = np.flatnonzero(~visited)
        chosen = np.zeros(len(ids), bool)
        chosen[ahead[_best(query[ahead], ids[ahead], sims[ahead], EXPANDED)]] = True
        return pa.table({"query": query, "id": ids, "sim": sims, "visited": visited, "next": chosen})

    asking = queries.select("query", "qvec")

    def advanced(state: DataFrame | None, reached: DataFrame) -> DataFrame:
        rows = reached.join(vectors, "id").select("query", "id", "vec").unionByName(asking, allowMissingColumns=True)
        if state is None:
            state = reached.limit(0).select("query", "id", *(F.lit(None).cast(k).alias(c) for c, k in (("sim", "float"), ("visited", "boolean"), ("next", "boolean"))))
        rows = rows.unionByName(state, allowMissingColumns=True)
        keyed = rows.withColumn("_g", F.pmod(F.xxhash64("query"), F.lit(groups)))
        return written(keyed.groupBy("_g").applyInArrow(advance, schema))

    state = advanced(None, seeds.distinct())
    while not state.filter("next").isEmpty():
        reached = state.filter("next").join(steps, "id").select("query", F.col("other").alias("id")).distinct()
        state = advanced(state, reached.join(state.select("query", "id"), ["query", "id"], "left_anti"))
    return state.select("query", "id", "sim")


def nearest(embeddings: DataFrame, every: int = 50, count: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``count`` nearest of each row whose id is divisible by ``every``."""
    length = F.size("embedding")
    lengths = [row["n"] for row in embeddings.filter(length > 0).select(length.alias("n")).distinct().orderBy("n").collect()]
    if len(lengths) < 2:
        return _nearest(embeddings, every, count)
    return reduce(DataFrame.unionByName, (_nearest(embeddings.filter(length == n), every, count) for n in lengths))


def _nearest(embeddings: DataFrame, every: int, count: int) -> DataFrame:
    """`nearest` among vectors of one length."""
    members, nodes = nodes_of(embeddings, count)
    edges = graph(nodes)
    asked = embeddings.select(F.col("vec_id").cast("long").alias("query_id"), F.xxhash64(F.col("embedding").cast("array<double>")).alias("query"))
    asked = asked.filter(F.col("query_id") % every == 0).dropDuplicates(["query_id", "query"])
    asked = written(asked.join(nodes.select(F.col("node").alias("query")), "query"))
    queries = written(nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node").select(F.col("node").alias("query"), F.col("vec").alias("qvec")))
    own = queries.select("query", F.col("query").alias("id"))
    lists = edges.join(own, "id").select("query", F.col("other").alias("id"))
    pivots = nodes.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(PIVOTS).select(F.col("node").alias("id"))
    # A query set against a fixed number of pivots, for nodes whose own list leads nowhere.
    far = queries.select("query").join(F.broadcast(pivots)).select("query", "id")
    found = search(nodes, edges, queries, own.unionByName(lists).unionByName(far))
    found = found.unionByName(own.withColumn("sim", F.lit(1.0).cast("float"))).dropDuplicates(["query", "id"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64).reshape(batch.num_rows, -1) for c in ("qraw", "raw"))
            a, b = (x / np.abs(x).max(axis=1, keepdims=True) if np.abs(x).max() > 1e100 or np.abs(x).max(axis=1).min() < 1e-100 else x for x in (a, b))
            score = np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("id"), pa.array(score)], names=["query", "id", "score"])

    # Ranked by float first, so that few pairs need their original vectors.
    order = Window.partitionBy("query").orderBy(F.desc("sim"), "id")
    top = found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= 2 * count + 2).select("query", "id")
    raws = nodes.select(F.col("node").alias("id"), "raw")
    pairs = top.join(raws, "id").join(raws.select(F.col("id").alias("query"), F.col("raw").alias("qraw")), "query")
    scored = pairs.select("query", "id", "qraw", "raw").mapInArrow(exact, "query long, id long, score double")
    of = scored.join(members.withColumnRenamed("node", "id"), "id")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    of = written(of.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= count + 1).select("query", "vec_id", "score"))
    answers = asked.join(of, "query").filter(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
