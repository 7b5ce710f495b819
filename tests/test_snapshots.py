"""Batches published as snapshots against one full build."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, SMALL, rows_of
from txnmart.operators import metrics, quality
from txnmart.plans.mart import build_mart, violations
from txnmart.plans.publish import ConstraintsViolated
from txnmart.queries import named_fact, scratch, two_batches
from txnmart.sources.raw import write_table
from txnmart.sources.sample import raw_transactions
from txnmart.streaming import snapshots

QUARANTINED = ["raw_row_id", "transaction_id", "order_timestamp", "amount", "invalid_reason"]


@pytest.fixture(scope="module")
def source(spark):
    return write_table(raw_transactions(spark, str(SMALL)), scratch(spark, "raw"))


@pytest.fixture(scope="module")
def whole(spark, source):
    return build_mart(source, scratch(spark, "mart"), AS_OF, loaded_at=AS_OF)


@pytest.fixture(scope="module")
def grown(spark, source):
    """The snapshots after each of two batches, the second of which was sent twice."""
    root = scratch(spark, "snapshots")
    first, second = two_batches(source).values()
    one = snapshots.apply(first, "a", root, AS_OF, AS_OF, buckets=8)
    two = snapshots.apply(second, "b", root, AS_OF, AS_OF)
    again = snapshots.apply(second, "b", root, AS_OF, AS_OF)
    assert (one.number, two.number, again) == (1, 2, snapshots.current(spark, root)) and two.buckets == 8
    return one, two


def opened(snapshot, source):
    return snapshots.open_snapshot(snapshot, source, AS_OF)


def test_batches_end_where_a_full_build_does(source, whole, grown):
    mart = opened(grown[1], source)
    assert rows_of(named_fact(mart)) == rows_of(named_fact(whole))
    assert rows_of(mart.accounting) == rows_of(whole.accounting)
    assert rows_of(mart.quarantine.select(*QUARANTINED)) == rows_of(whole.quarantine.select(*QUARANTINED))
    summary = [rows_of(quality.dq_summary(m.accounting, m.fact, m.quarantine)) for m in (mart, whole)]
    assert summary[0] == summary[1]
    assert violations(mart).filter("violations > 0").count() == 0


def test_stored_totals_follow_superseded_versions(spark, source, whole, grown):
    for grain, key, live in (("week", "week_start", metrics.weekly), ("month", "month_start", metrics.monthly)):
        names = [key, "completed_transactions", "completed_units", "completed_value"]
        expected = live(whole).select(F.col(key).cast("string"), *names[1:])
        assert rows_of(snapshots.totals(grown[1], grain, key).select(*names)) == rows_of(expected)
        after_one = live(opened(grown[0], source)).select(F.col(key).cast("string"), *names[1:])
        assert rows_of(snapshots.totals(grown[0], grain, key).select(*names)) == rows_of(after_one)
    for entity, live in (("channel", metrics.channel_mix), ("product_category", metrics.product_category_mix)):
        assert rows_of(snapshots.stored_mix(grown[1], entity)) == rows_of(live(whole))


def test_known_names_keep_their_keys(source, grown):
    before, after = (opened(snapshot, source) for snapshot in grown)
    for name in ("dim_channel", "dim_product_category", "dim_date"):
        assert set(rows_of(getattr(before, name))) <= set(rows_of(getattr(after, name))), name
    names = {row.product_category_name for row in before.dim_product_category.collect()}
    assert "Machinery" not in names
    assert "Machinery" in {row.product_category_name for row in after.dim_product_category.collect()}


def test_a_failed_batch_changes_nothing(spark, source, grown):
    one, two = grown
    extra = source.limit(50).withColumn("raw_row_id", F.col("raw_row_id") + 10**13)

    def refuse(mart):
        assert mart.fact.count() >= 0
        return spark.range(1).select(F.lit("refused").alias("check_name"), F.lit(3).alias("violations"))

    before = rows_of(named_fact(opened(two, source)))
    with pytest.raises(ConstraintsViolated, match="refused: 3"):
        snapshots.apply(extra, "c", two.root, AS_OF, AS_OF, check=refuse)
    assert snapshots.current(spark, two.root) == two and not snapshots.applied(spark, two.root, "c")
    assert rows_of(named_fact(opened(two, source))) == before


def test_a_batch_opens_what_it_touches(spark, raw, source, grown):
    """One new version: one bucket of versions, its two months, and no other part of the fact is replaced."""
    two = grown[1]
    row = opened(two, source).fact.filter("is_value_eligible").orderBy("transaction_id").first()
    new = raw({"transaction_id": row.transaction_id, "order_timestamp": "2026-05-30 10:00:00"})
    new = new.withColumn("raw_row_id", F.lit(10**14))
    three = snapshots.apply(new, "one", two.root, AS_OF, AS_OF)
    changed = {name for name in three.parts.keys() | two.parts.keys() if three.parts.get(name) != two.parts.get(name)}
    assert sum(name.startswith("versions/") for name in changed) == 1
    assert sum(name.startswith("copies/") for name in changed) == 1
    assert {name for name in changed if name.startswith("fact/")} <= {f"fact/{row.order_timestamp:%Y-%m}-01", "fact/2026-05-01"}
    assert not any(name.startswith("quarantine/") for name in changed)
    kept = three.read("versions", ["3"]).inputFiles()
    assert kept and all("/versions/part=3/" in path for path in kept)
    found = three.read("fact").filter(F.col("transaction_id") == row.transaction_id).collect()
    assert [str(own.order_timestamp) for own in found] == ["2026-05-30 10:00:00"]
    older = new.withColumn("order_timestamp", F.lit("2026-04-01 00:00:00")).withColumn("raw_row_id", F.lit(10**14 + 1))
    four = snapshots.apply(older, "late", two.root, AS_OF, AS_OF)
    assert {k: v for k, v in four.parts.items() if "fact/" in k or "versions/" in k} == {k: v for k, v in three.parts.items() if "fact/" in k or "versions/" in k}


def test_a_month_may_become_empty_and_a_batch_too(spark, raw):
    root = scratch(spark, "snapshots")
    rows = raw({"order_timestamp": "2026-01-05 10:00:00"}, {"order_timestamp": "2026-03-05 10:00:00"}, {"order_timestamp": None})
    for number in (1, 2, 3):
        snapshots.apply(rows.filter(F.col("raw_row_id") == number), str(number), root, AS_OF, AS_OF, buckets=4)
    last = snapshots.apply(rows.limit(0), "none", root, AS_OF, AS_OF)
    assert last.keys("fact") == {"2026-03-01"} and last.number == 4
    assert rows_of(snapshots.totals(last, "month", "month_start").select("month_start")) == [("2026-03-01",)]
    assert rows_of(last.read("accounting")) == [(3, 0, 1, 0, 2)]
    assert last.read("quarantine").count() == 1


def test_a_stream_replays_without_effect(spark, source, whole):
    root = scratch(spark, "stream")
    stamped = source.withColumn("loaded_at", F.lit(AS_OF).cast("timestamp"))
    for part in two_batches(stamped).values():
        part.coalesce(2).write.mode("append").parquet(f"{root}/landed")
        snapshots.stream(spark, f"{root}/landed", f"{root}/mart", f"{root}/progress", AS_OF, AS_OF)
    reached = snapshots.current(spark, f"{root}/mart")
    # Another checkpoint numbers its batches from 0 again: the log knows them.
    snapshots.stream(spark, f"{root}/landed", f"{root}/mart", f"{root}/progress2", AS_OF, AS_OF)
    assert snapshots.current(spark, f"{root}/mart") == reached
    assert rows_of(named_fact(opened(reached, source))) == rows_of(named_fact(whole))


def test_tables_without_parts_cost_no_shuffle(spark):
    rows = spark.range(9).select(F.col("id").cast("string").alias("transaction_id"))
    known = snapshots.Snapshot(spark, "/nowhere").read("versions")
    for kind in ("left", "left_anti"):
        plan = rows.join(known, "transaction_id", kind)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_copies_hold_short_digests_and_accounting_follows_them(spark, raw, tmp_path):
    root, bad = str(tmp_path / "mart"), {"amount": "x"}
    snapshots.apply(raw({}, {}, bad, {"transaction_id": "T2", "status": None}), "a", root, AS_OF, AS_OF)
    after = snapshots.apply(raw({}, bad, bad, {"transaction_id": "T3"}, {"transaction_id": "T4", "amount": "0"}), "b", root, AS_OF, AS_OF)
    copies = after.read("copies")
    assert {len(row.digest) for row in copies.collect()} == {16}
    assert rows_of(copies.select("kind", "copies")) == [(0, 1), (0, 3), (1, 1), (2, 1), (2, 3)]
    assert rows_of(after.read("accounting")) == [(9, 4, 2, 1, 2)]
    assert after.read("quarantine").count() == 2
