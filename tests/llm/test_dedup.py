"""Exact and near-duplicates against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import DOCUMENTS, sentence, tricky_rows
from txnmart.llm import exact, simhash
from txnmart.llm.components import roots


def test_exact_groups(tricky):
    found = exact.groups(tricky, files_per_batch=1).collect()
    texts = [(row[0], row[1] or "") for row in tricky_rows()]
    assert len(found) == len(texts)
    sizes = Counter(text for _, text in texts)
    keep = {}
    for doc_id, text in texts:
        keep[text] = max(keep.get(text, -1), -1 if doc_id is None else doc_id)
    by_digest = {hashlib.sha256(text.encode()).hexdigest(): text for _, text in texts}
    for row in found:
        text = by_digest[row["digest"]]
        assert row["group_size"] == sizes[text]
        assert row["keep_id"] == (None if keep[text] == -1 else keep[text])
    assert Counter(row["digest"] for row in found if row["kept"]) == Counter(list(by_digest))


def test_exact_state_goes_on(spark, table, tmp_path):
    """New files meet what earlier runs of the stream have retained."""
    columns = "doc_id long, digest string, _file string, _row long"
    feed, folder = f"{tmp_path}/feed", f"{tmp_path}/state"
    first = spark.createDataFrame([(1, "x", "f", 0), (5, "y", "f", 1)], columns)
    first.write.parquet(feed)
    exact.retain(feed, first.schema, spark, folder)
    spark.createDataFrame([(9, "x", "g", 0), (2, "y", "g", 1), (3, "z", "g", 2)], columns).write.mode("append").parquet(feed)
    state = exact.retain(feed, first.schema, spark, folder)
    assert {(r["digest"], r["kept"]["doc_id"], r["kept"]["_file"], r["n"]) for r in state.collect()} == {
        ("x", 9, "g", 2),
        ("y", 5, "f", 2),
        ("z", 3, "g", 1),
    }


def test_exact_compares_bytes(monkeypatch, table):
    """Texts that share a digest are told apart: here every digest is the same."""
    docs = table([(i, f"text {i % 3}", None, None, None) for i in range(9)], DOCUMENTS)
    monkeypatch.setattr(exact.F, "sha2", _one_digest(exact.F.sha2))
    rows = exact.groups(docs).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows} == {
        (i, 6 + i % 3, 3, i >= 6) for i in range(9)
    }


def _one_digest(real):
    return lambda column, bits: exact.F.lit("same") if bits == 256 else real(column, bits)


def test_exact_empty(table):
    docs = table([], DOCUMENTS)
    assert exact.groups(docs).collect() == []


def plain_fingerprint(text: str, shingle: int = 4) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int], distance: int) -> list[int]:
    label = list(range(len(fps)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_simhash_components(tricky):
    rows = tricky_rows()
    fps = [plain_fingerprint(row[1] or "") for row in rows]
    labels = plain_components(fps, 4)
    smallest = {}
    for label, row in zip(labels, rows, strict=True):
        ids = [i for i in (smallest.get(label), row[0]) if i is not None]
        smallest[label] = min(ids, default=None)
    expected = Counter((row[0], fp, smallest[label]) for row, fp, label in zip(rows, fps, labels, strict=True))
    found = simhash.components(tricky).collect()
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == len(set(labels))


@pytest.mark.parametrize("chunk", [4096, 16])
def test_simhash_links(spark, chunk):
    """Dense balls, chains and lone fingerprints, with and without crowded part values."""
    draw = np.random.default_rng(5)
    fps = set()
    for center in draw.integers(0, 1 << 63, 12):
        for _ in range(60):
            fps.add(int(center) ^ sum(1 << int(b) for b in draw.choice(63, draw.integers(0, 7), replace=False)))
    fps |= {int(x) for x in draw.integers(0, 1 << 63, 300)}
    fps = sorted(fps)
    classes = spark.createDataFrame([(fp,) for fp in fps], "fp long").repartition(3).cache()
    links = simhash.links(classes, 4, chunk)
    near = [(r["a"], r["b"]) for r in links.collect()]
    assert all((a ^ b).bit_count() > 0 for a, b in near)
    found = {r["node"]: r["root"] for r in roots(links).collect()}
    expected = plain_components(fps, 4)
    assert [found.get(fp, fp) for fp in fps] == [fps[label] for label in expected]
    assert len(set(near)) < 12 * len(fps)


def test_simhash_plan_is_complete():
    draw = np.random.default_rng(3)
    plan = simhash.Plan([list(range(0, 22)), list(range(22, 43)), list(range(43, 64))], 4)
    plan.n = 1000
    plan.near = [[np.abs(draw.random((256, 5))) for _ in part] for part in plan.blocks]
    allotted = plan.allot(draw.integers(0, 1 << 62, 50))
    assert (allotted.sum(axis=1) == 4 - 3 + 1).all() and allotted.min() >= -1


def test_simhash_empty(table):
    assert simhash.components(table([], DOCUMENTS)).collect() == []


def test_long_shingles():
    for text in ["", "a", "a b c", "A b c d", sentence(2, 500), "z " * 70_000]:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
