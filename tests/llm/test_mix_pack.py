"""Mixing and packing."""

import math
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DOCUMENTS, sentence, tricky_rows
from txnmart.llm import mixing, packing


def plain_targets(sizes: dict, share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    capped, budget = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        level = (budget - sum(most * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in rest))
        above = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= above


def test_mix(tricky):
    rows = mixing.mix(tricky).collect()
    assert len(rows) == len(tricky_rows())
    sizes, taken, longest = Counter(), Counter(), Counter()
    for row in rows:
        sizes[row["source"]] += row["size"]
        taken[row["source"]] += row["taken"]
        longest[row["source"]] = max(longest[row["source"]], row["size"])
        assert 0 <= row["taken"] <= 2 * row["size"]
    assert Counter(r["size"] for r in rows) == Counter(len((r[1] or "").split()) for r in tricky_rows())
    target = plain_targets(sizes)
    for row in rows:
        assert math.isclose(row["target"], target[row["source"]], rel_tol=1e-12) and row["source_size"] == sizes[row["source"]]
    for source in sizes:
        assert abs(taken[source] - target[source]) <= longest[source] + 0.01 * target[source], source
    conf, partitions = tricky.sparkSession.conf, tricky.sparkSession.conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = mixing.mix(tricky).collect()
    finally:
        conf.set("spark.sql.shuffle.partitions", partitions)
    key = lambda r: (r["_file"], r["_row"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_empty(table):
    assert mixing.mix(table([], DOCUMENTS)).collect() == []
    only = mixing.mix(table([(1, None, None, None, None), (2, "", None, "a", 0)], DOCUMENTS)).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in only] == [(0, 0, 0.0)] * 2


items = st.lists(st.tuples(st.integers(0, 20), st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, 3, 4, 5, None])), max_size=40)


@settings(max_examples=200, deadline=None)
@given(items)
def test_best_fit_is_tightest(rows):
    """Replays the placements: each item went to the tightest compatible bin, or to a new one."""
    capacity = 20
    where = packing.best_fit(rows, capacity)
    bins = defaultdict(list)
    for at in sorted(range(len(rows)), key=lambda i: -rows[i][0]):
        size, source, cluster = rows[at]
        fitting = {}
        for number, content in bins.items():
            residual = capacity - sum(rows[i][0] for i in content)
            clash = any(rows[i][1] == source or (cluster is not None and rows[i][2] == cluster) for i in content)
            if residual >= size and not clash:
                fitting[number] = residual
        if fitting:
            assert fitting.get(where[at]) == min(fitting.values())
        else:
            assert where[at] not in bins
        bins[where[at]].append(at)


def test_pack(tricky):
    rows = packing.pack(tricky, capacity=256, shard_items=40).collect()
    per_row, bins = defaultdict(list), defaultdict(list)
    for row in rows:
        per_row[row["_file"], row["_row"]].append((row["start"], row["length"]))
        bins[row["bin"]].append(row)
    assert len(per_row) == len(tricky_rows())
    covered = Counter()
    for spans in per_row.values():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0
        covered[sum(n for _, n in spans)] += 1
    assert covered == Counter(len((r[1] or "").split()) for r in tricky_rows())
    for content in bins.values():
        content.sort(key=lambda r: r["offset"])
        assert sum(r["length"] for r in content) <= 256
        assert len({r["source"] for r in content}) == len(content)
        at = 0
        for row in content:
            assert row["offset"] == at
            at += row["length"]


def test_pack_keeps_copies_apart(table):
    copies = [(i, sentence(1, 10), None, f"s{i}", 1) for i in range(50)]
    rows = packing.pack(table(copies, DOCUMENTS), capacity=1000).collect()
    assert len({r["bin"] for r in rows}) == 50


def test_pack_empty(table):
    assert packing.pack(table([], DOCUMENTS)).collect() == []
