"""CSV reading and writing, landing, mapping."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, GOOD, rows_of
from txnmart.operators.profile import value_shares
from txnmart.schemas import RAW, SOURCE_FIELDS
from txnmart.session import release, written
from txnmart.sources.raw import land, map_source, read_raw, read_source, with_row_id, write_csv
from txnmart.streaming.incremental import past_mark

HEADER = "a,b,c,d,e,f,g,h,i\n"


def csv(tmp_path, *lines):
    path = tmp_path / "in.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return str(path)


def test_fields_map_by_position_and_empty_differs_from_quoted_empty(spark, tmp_path):
    path = csv(tmp_path, 'T1,2026-01-05 10:00:00, web ,"Home ""x"", y","",,card,C1,"line\nbreak"')
    row = read_raw(spark, path, multiline=True).first()
    assert row.asDict() == dict(zip(SOURCE_FIELDS, (
        "T1", "2026-01-05 10:00:00", " web ", 'Home "x", y', "", None, "card", "C1", "line\nbreak")))


READS = {
    "all": lambda df: df.collect(),
    "count": lambda df: df.count(),
    "one column": lambda df: df.select("channel").collect(),
    "shares": lambda df: value_shares(df, "channel").collect(),
}


@pytest.mark.parametrize("read", sorted(READS))
@pytest.mark.parametrize("multiline", [False, True])
@pytest.mark.parametrize("line", ["1,2", "1,2,3,4,5,6,7,8,9,10"])
def test_a_row_of_another_width_fails_every_read(spark, tmp_path, line, multiline, read):
    with pytest.raises(Exception, match="(?i)malformed"):
        READS[read](read_raw(spark, csv(tmp_path, "T1,t,c,p,1,2,m,C,s", line), multiline))


@pytest.mark.parametrize("read", sorted(READS))
def test_a_line_break_in_a_field_needs_whole_files(spark, tmp_path, read):
    path = csv(tmp_path, 'T1,t,c,p,1,2,m,C,"a\nb"')
    with pytest.raises(Exception, match="(?i)malformed"):
        READS[read](read_raw(spark, path))
    assert read_raw(spark, path, multiline=True).count() == 1


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    path = csv(tmp_path, *[f"T{i},t,c,p,1,2,m,C,s" for i in range(2000)])
    rows = read_raw(spark, path)
    assert rows.rdd.getNumPartitions() > 4 and rows.count() == 2000


def test_ids_follow_the_files(spark, tmp_path, small_splits):
    """A small first file and a large second one, which the planner would read the other way round."""
    for name, count in (("a", 3), ("b", 1500), ("c", 40)):
        (tmp_path / f"{name}.csv").write_text(HEADER + "".join(f"{name}{i},t,c,p,1,2,m,C,s\n" for i in range(count)))
    landed = land(read_raw(spark, str(tmp_path)), str(tmp_path / "raw"), AS_OF)
    found = [row.transaction_id for row in landed.orderBy("raw_row_id").collect()]
    assert found == [f"{name}{i}" for name, count in (("a", 3), ("b", 1500), ("c", 40)) for i in range(count)]
    assert landed.agg(F.max("raw_row_id")).first()[0] == 1542


def test_records_cross_splits(spark, tmp_path, small_splits):
    """Doubled quotes, line breaks and blank lines inside fields, some longer than several splits, in one file by many tasks."""
    draw = random.Random(7)
    pieces = ["\n", '"', ",", "a", "b\n\n", '""', "\r\n", "long word ", "é"]
    rows = []
    for at in range(600):
        texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 9))) for _ in range(2)]
        texts[0] += "x\n" * (3000 if at % 150 == 3 else 0) + ('"\n' * 2000 if at % 200 == 9 else "")
        rows.append((f"T{at}", "t", *texts, "1", None, "", "C", "s"))

    def field(text):
        return "" if text is None else '"' + text.replace('"', '""') + '"'

    for name, own in (("a", rows[:5]), ("b", rows[5:590]), ("c", rows[590:])):
        body = "\n".join(",".join(map(field, row)) for row in own)
        (tmp_path / f"{name}.csv").write_text(HEADER + body + "\n\n", newline="")
    found = read_raw(spark, str(tmp_path), multiline=True, placed=True)
    assert found.select("_order").distinct().count() > 10
    landed = land(found, str(tmp_path / "raw"), AS_OF)
    assert [tuple(row[1:10]) for row in landed.orderBy("raw_row_id").collect()] == rows
    assert landed.agg(F.min("raw_row_id"), F.max("raw_row_id"), F.count_distinct("raw_row_id")).first()[:] == (0, 599, 600)


def test_an_unclosed_quote_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed|not closed"):
        read_raw(spark, csv(tmp_path, 'T1,t,c,p,1,2,m,C,"a', "T2,t,c,p,1,2,m,C,s"), multiline=True).collect()


def test_windows_line_ends_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\r\nT1,t,c,p,1,2,m,C,"a\r\nb"\r\nT2,t,c,p,1,2,m,C,s\r\n', newline="")
    (tmp_path / "b.csv").write_text("")
    found = read_raw(spark, str(tmp_path), multiline=True)
    assert rows_of(found.select("transaction_id", "status")) == [("T1", "a\r\nb"), ("T2", "s")]


def test_ids_without_a_shuffle_of_rows(spark, tmp_path):
    plan = with_row_id(read_raw(spark, csv(tmp_path, "T1,t,c,p,1,2,m,C,s")))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_profiling_read_treats_missing_value_texts_as_null(spark, tmp_path):
    row = read_source(spark, csv(tmp_path, 'T1,NaN,None,NA,1,null,card,N/A,ok')).first()
    assert [row[name] for name in SOURCE_FIELDS] == ["T1", None, None, None, "1", None, "card", None, "ok"]


def test_csv_round_trip_keeps_texts(spark, tmp_path):
    fields = ", ".join(f"{name} string" for name in SOURCE_FIELDS)
    rows = [(" a ", 'q"q', "", None, "x,y", "l\nb", "\\", "", None), tuple(GOOD.values())]
    df = spark.createDataFrame(rows, fields)
    write_csv(df, str(tmp_path / "out"))
    assert rows_of(read_raw(spark, str(tmp_path / "out"), multiline=True)) == rows_of(df)


def test_landing_fixes_ids_and_load_time(spark, tmp_path):
    source = spark.range(100).select(*[F.col("id").cast("string").alias(name) for name in SOURCE_FIELDS])
    landed = land(source, str(tmp_path / "raw"), "2026-06-01 00:00:00")
    assert landed.columns == RAW.fieldNames()
    assert landed.select("raw_row_id").distinct().count() == 100
    assert rows_of(landed) == rows_of(landed)
    ordered = with_row_id(source.coalesce(1)).orderBy("raw_row_id").collect()
    assert [int(row.transaction_id) for row in ordered] == list(range(100))


def test_a_second_landing_continues_the_ids(spark, tmp_path):
    source = spark.range(10).select(*[F.col("id").cast("string").alias(name) for name in SOURCE_FIELDS])
    path = str(tmp_path / "raw")
    mark = land(source, path).agg(F.max("raw_row_id")).first()[0]
    both = land(source, path, append=True)
    assert both.select("raw_row_id").distinct().count() == 20
    assert past_mark(both, mark).count() == 10


def test_mapping_fills_missing_fields_with_null(spark):
    other = spark.createDataFrame([(7, "x")], "id int, kind string")
    mapped = map_source(other, {"transaction_id": F.concat(F.lit("N"), "id"), "channel": "kind"})
    assert mapped.columns == SOURCE_FIELDS
    assert mapped.first()[:3] == ("N7", None, "x")
    with pytest.raises(ValueError, match="colour"):
        map_source(other, {"colour": "kind"})


def test_release_removes_intermediate_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("txnmart.session.shared_dir", lambda _: str(tmp_path / "shared"))
    stored = written(spark.range(5))
    assert stored.count() == 5 and list((tmp_path / "shared/tables").iterdir())
    release(spark)
    assert not list((tmp_path / "shared/tables").iterdir())
