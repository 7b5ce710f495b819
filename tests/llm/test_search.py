"""Nearest neighbours and the pipeline."""

import math

import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.conftest import DOCUMENTS, sentence
from txnmart.llm import exact, neighbours, packing, simhash

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_nearest(rows, every, count=5):
    valid = {}
    for vec_id, vector, *_ in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        valid[vec_id] = np.array(vector, np.float32).astype(np.float64)
    out = {}
    for query in [v for v in valid if v % every == 0]:
        a = valid[query]
        scores = [(-(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), v) for v, b in valid.items() if v != query]
        out[query] = [(v, -s) for s, v in sorted(scores)[:count]]
    return out


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(4)
    centers = draw.standard_normal((12, 24)) * 1.5
    return [(i, (centers[i % 12] + draw.standard_normal(24)).astype(np.float32).tolist(), 0) for i in range(3000)]


def answers(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(out[row["query_id"]])
    return out


def test_recall(table, points, monkeypatch):
    """Small buckets and few tables, so that the rounds and the search have to find most."""
    monkeypatch.setattr(neighbours, "BUCKET", 60)
    monkeypatch.setattr(neighbours, "LARGEST", 100)
    found = answers(neighbours.nearest(table(points, VECTORS, 3)))
    expected = plain_nearest(points, 50)
    assert set(found) == set(expected)
    hits = [len({v for v, _ in found[q]} & {v for v, _ in expected[q]}) for q in expected]
    assert sum(hits) >= 0.9 * 5 * len(expected)
    for query, own in found.items():
        scores = dict(plain_nearest(points, 50, 3000)[query]) if query == 0 else None
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        assert scores is None or all(scores[v] == pytest.approx(s, abs=1e-12) for v, s in own)


def test_dense_group(table, monkeypatch):
    """A dense group without clusters, far larger than a block: the start compares few pairs, the rounds find the true nearest."""
    monkeypatch.setattr(neighbours, "LARGEST", 50)
    draw = np.random.default_rng(7)
    dense = draw.standard_normal(16) * 4 + draw.standard_normal((900, 16))
    rows = [(i, vector.astype(np.float32).tolist(), 0) for i, vector in enumerate(dense)]
    members, nodes = neighbours.nodes_of(table(rows, VECTORS))
    name = {r["node"]: r["vec_id"] for r in members.collect()}
    expected = plain_nearest(rows, 1)

    def recall(lists):
        found = {}
        for r in lists:
            found.setdefault(name[r["id"]], set()).add(name[r["other"]])
        return sum(len(found.get(q, set()) & {v for v, _ in own}) for q, own in expected.items()) / (5 * len(expected))

    assert recall(neighbours.hashed(nodes, 900).collect()) < 0.8
    assert recall(neighbours.graph(nodes).collect()) >= 0.95


def test_block_sizes(table, monkeypatch):
    """Pairs of the start grow with the group, not with its square."""
    monkeypatch.setattr(neighbours, "BUCKET", 10**9)
    monkeypatch.setattr(neighbours, "LARGEST", 40)
    draw = np.random.default_rng(3)
    count = {}
    for size in (400, 1600):
        rows = [(i, (draw.standard_normal(8) * 0.01 + 1).astype(np.float32).tolist(), 0) for i in range(size)]
        _, nodes = neighbours.nodes_of(table(rows, VECTORS))
        count[size] = neighbours.hashed(nodes, size, keep=1000).count()
    assert count[1600] < 5 * count[400]


def test_vectors_of_several_lengths(table):
    draw = np.random.default_rng(5)
    rows = [(i, draw.standard_normal(8).tolist(), 0) for i in range(1, 30)] + [(50 * i, draw.standard_normal(3 + i % 2).tolist(), 0) for i in range(12)]
    expected = {}
    for length in (3, 4, 8):
        expected |= plain_nearest([row for row in rows if len(row[1]) == length], 50)
    found = answers(neighbours.nearest(table(rows, VECTORS)))
    assert {q: [v for v, _ in own] for q, own in found.items()} == {q: [v for v, _ in own] for q, own in expected.items()}


def test_odd_vectors(table):
    draw = np.random.default_rng(1)
    same = [1.0, 2.0, 3.0]
    rows = [(i, same, 0) for i in range(0, 60)] + [(100 + i, draw.standard_normal(3).tolist(), 0) for i in range(30)]
    rows += [(200, None, 0), (250, [0.0, 0.0, 0.0], 0), (300, [1.0, None, 2.0], 0), (350, [math.nan, 1.0, 1.0], None), (400, [math.inf, 1.0, 1.0], 0)]
    rows += [(None, same, 0), (450, [], 0), (500, [1.0, 2.0], 0), (50, same, 0)]
    extra = ", node long, sim float, query long"
    found = answers(neighbours.nearest(table([(*row, 1, 1.0, 2) for row in rows], VECTORS + extra)))
    kept = [row for row in rows if row[1] is not None and len(row[1]) == 3]
    expected = plain_nearest(kept, 50)
    assert {q: [v for v, _ in own] for q, own in found.items()} == {q: [v for v, _ in own] for q, own in expected.items()}


def test_few_and_none(table):
    assert neighbours.nearest(table([], VECTORS)).collect() == []
    assert answers(neighbours.nearest(table([(0, [1.0, 0.0], 0)], VECTORS))) == {}
    found = answers(neighbours.nearest(table([(0, [1.0, 0.0], 0), (7, [0.5, 0.5], 0)], VECTORS)))
    assert found == {0: [(7, pytest.approx(2**-0.5))]}


def test_pipeline_stages(spark, table, tmp_path):
    """Every stage against what it should keep, on documents with planted cases."""
    clean = [(i, sentence(i, 60 + i), "en", "ab"[i % 2], 1) for i in range(1, 41)]
    copies = [(100 + i, clean[i][1], "en", "a", 1) for i in range(5)]
    near = [(200 + i, clean[10 + i][1] + " end", "en", "b", 1) for i in range(5)]
    bad = [(300 + i, sentence(i, 30) + " vileword vilething vilest" * 3, "en", "a", 1) for i in range(40)]
    rows = clean + copies + near + bad
    sf_dir = f"{tmp_path}/sf"
    spark.createDataFrame(rows, DOCUMENTS).repartition(2).write.parquet(f"{sf_dir}/documents.parquet")
    marks = [(row[0], 1, int(row[0] >= 300)) for row in rows]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if name != "pack":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/stage{at}")
        docs = spark.read.parquet(f"{tmp_path}/stage{at}")
        kept.append({row["doc_id"] for row in docs.collect()})
    assert kept[0] == {row[0] for row in clean + copies + near}
    assert kept[1] == kept[0] - {row[0] for row in clean[:5]}
    left = spark.createDataFrame([row for row in rows if row[0] in kept[1]], DOCUMENTS)
    groups = {}
    for row in left.collect():
        groups.setdefault(simhash.fingerprint(row["text"].encode()), []).append(row["doc_id"])
    assert len(kept[2]) <= len(groups) and kept[2] <= kept[1]
    assert kept[3] <= kept[2] and kept[4] == kept[3]
    words = {row[0]: len(row[1].split()) for row in rows}
    bins = {}
    for row in docs.collect():
        bins.setdefault(row["bin"], []).append(row)
    assert all(sum(r["length"] for r in own) <= packing.CAPACITY for own in bins.values())
    assert all(sum(r["length"] for r in docs.collect() if r["doc_id"] == i) % words[i] == 0 for i in kept[4])


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, str(SMALL)).collect()
    assert rows and {"doc_id", "bin", "piece", "offset"} <= set(rows[0].asDict())


def test_rows_keep_their_columns(tricky):
    """Clashing names survive a stage unchanged."""
    kept = corpus_pipeline.keep_distinct(tricky.sparkSession, tricky, "")
    assert kept.columns == tricky.columns and kept.schema == tricky.schema
    assert kept.count() == exact.groups(tricky).filter("kept").count()
