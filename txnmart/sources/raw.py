"""Reading source files and writing tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnmart.operators.numbering import running_total
from txnmart.schemas import RAW, SOURCE, SOURCE_FIELDS
from txnmart.session import written

# Texts a profiling read treats as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# An unquoted empty field is NULL while a quoted one is the empty string. The reader
# tells them apart only if its null marker differs from "", so use a control character.
_NULL_MARK = "\u0001"


_FORM = {"mode": "FAILFAST", "quote": '"', "escape": '"', "nullValue": _NULL_MARK, "emptyValue": ""}

#: Offsets of splits are broadcast up to this many, at about 16 bytes each.
SPLITS = 4_000_000
#: What a split holds: whole records, the end of one begun before, the start of an unfinished one, or the middle of one.
WHOLE, TAIL, HEAD, MIDDLE = range(4)


def read_raw(spark: SparkSession, path: str, multiline: bool = False, placed: bool = False) -> DataFrame:
    """Nine text columns by position, header skipped; a row of any other width fails the read.

    Files are split, so that one large extract is parsed by many tasks. A line break inside a
    quoted field makes two short rows of one, which fails the read as well; files with such
    fields need ``multiline=True``, see `read_records`. Rows are parsed whole
    even if few columns are asked for: pruned columns would not be counted for the width.
    """
    if multiline:
        return read_records(spark, path, placed)
    reader = spark.read.schema(SOURCE).options(header=True, enforceSchema=True, columnPruning=False, **_FORM)
    return reader.csv(path)


def read_records(spark: SparkSession, path: str, placed: bool = False) -> DataFrame:
    """Like `read_raw`, for files with line breaks inside quoted fields, which are split all the same.

    One scan counts the quotes of each split; with an odd number before it in its file, a split begins
    inside quotes. A second scan cuts records at the line ends outside quotes. A record that crosses
    splits is put together from its pieces, of which a split has two at most. Rows are parsed and stored in
    the shared folder at once, so a malformed row fails this call. Quotes belong around fields or doubled inside;
    a quote that a file never closes fails as well. The header is in the first split.

    ``placed`` adds ``_order``, the number of the split by path and offset, and ``_at``, that of the row in it.
    """
    lines = spark.read.text(path, lineSep="\n")
    meta = lines.metadataColumn("_metadata")
    start = meta["file_block_start"]
    lines = lines.select("value", meta["file_path"].alias("_path"), start.alias("_start"), F.xxhash64(meta["file_path"], start).alias("_split"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy("_split", "_path", "_start").agg((F.sum(quotes) % 2).alias("_odd"), F.lit(1).cast("long").alias("_one"))
    numbered = running_total(written(splits), ["_path", "_start"], "_one", "_order")
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_odd").over(earlier) % 2 == 1, F.lit(False))
    offsets = written(numbered.select("_split", "_order", inside.alias("_inside")))
    if offsets.count() > SPLITS:
        raise ValueError(f"more than {SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    # The broadcast keeps the lines of a split together and in order.
    marked = lines.join(F.broadcast(offsets), "_split").select("_order", "_inside", (F.col("_start") == 0).alias("_top"), "value")
    pieces = marked.mapInArrow(_cutter(), "_order long, _at long, _kind int, value string")
    whole, text = F.col("_kind") == WHOLE, F.regexp_replace("value", "\r$", "")
    fields = ", ".join(f"{name} string" for name in SOURCE_FIELDS)

    def parsed(record: Column) -> Column:
        return F.from_csv(record, fields, {**_FORM, "multiLine": "true"})

    stored = written(pieces.select("_order", "_at", "_kind", parsed(F.when(whole, text)).alias("row"), F.when(~whole, F.col("value")).alias("value")))
    torn = stored.filter(~whole).select("_order", "_at", "_kind", "value", (F.col("_kind") == HEAD).cast("long").alias("_head"))
    torn = running_total(written(torn), ["_order", "_head"], "_head", "_record")
    joined = torn.groupBy((F.col("_record") + F.col("_head")).alias("_record")).agg(
        F.min("_order").alias("_order"),
        F.max_by("_at", "_head").alias("_at"),
        F.max("_head").alias("_head"),
        F.max((F.col("_kind") == TAIL).cast("int")).alias("_closed"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_order", "_head", "value"))), lambda p: p["value"]), "\n").alias("value"),
    )
    closed = (F.col("_head") == 1) & (F.col("_closed") == 1)
    joined = joined.withColumn("value", F.when(closed, text).otherwise(F.raise_error(F.lit("malformed CSV: a quote is not closed"))))
    crossing = written(joined.select("_order", "_at", parsed(F.col("value")).alias("row")))
    rows = stored.filter(whole).select("_order", "_at", "row").unionByName(crossing)
    return rows.select(*(["_order", "_at"] if placed else []), "row.*")


def _cutter():
    """A function that cuts the lines of splits, in order, into records and the pieces of records at both ends."""
    whole, tail, head, middle = WHOLE, TAIL, HEAD, MIDDLE

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, str]] = []
        held: list[str] = []
        order, at, begun, inside, top = None, 0, False, False, False

        def batch() -> pa.RecordBatch:
            names = [("_order", pa.int64()), ("_at", pa.int64()), ("_kind", pa.int32()), ("value", pa.string())]
            columns = list(zip(*out, strict=True)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(own, kind) for own, (_, kind) in zip(columns, names, strict=True)], [name for name, _ in names]
            )

        for rows in batches:
            odd = pc.bit_wise_and(pc.count_substring(rows.column("value"), '"'), 1).to_pylist()
            columns = [rows.column(name).to_pylist() for name in ("_order", "_inside", "_top", "value")]
            for own, within, first, line, flips in zip(*columns, odd, strict=True):
                if own != order:
                    if held:
                        out.append((order, at, middle if begun else head, "\n".join(held)))
                        held = []
                    order, at, begun, inside, top = own, 0, within, within, first
                if inside or flips:
                    held.append(line)
                    inside ^= bool(flips)
                    if inside:
                        continue
                    line, held = "\n".join(held), []
                if top:
                    top = False  # the header
                elif begun:
                    out.append((order, 0, tail, line))
                elif line not in ("", "\r"):
                    out.append((order, at, whole, line))
                    at += 1
                begun = False
            yield batch()
        if held:
            out.append((order, at, middle if begun else head, "\n".join(held)))
            yield batch()

    return cut


def missing_as_null(df: DataFrame) -> DataFrame:
    """What a profile sees of source rows: the usual missing-value texts as NULL. Other columns stay."""
    seen = {name: F.when(~F.col(name).isin(MISSING_TEXTS), F.col(name)) for name in SOURCE_FIELDS if name in df.columns}
    return df.withColumns(seen)


def read_source(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Source sample for profiling: like `read_raw`, with the usual missing-value texts as NULL."""
    return missing_as_null(read_raw(spark, path, multiline))


def with_row_id(df: DataFrame, first: int = 0) -> DataFrame:
    """Add ``raw_row_id`` from ``first`` upwards: by file path, and in each file by row.

    Tasks read splits in an order of their own, so rows are numbered within their split and
    splits by path and offset; frames that `read_raw` has ``placed`` know both. Another frame that
    doesn't come from files is numbered by its partitions; write that result before using it twice.
    """
    if {"_order", "_at"} <= set(df.columns):
        rows, columns = df, [name for name in df.columns if name not in ("_order", "_at")]
        splits = rows.groupBy("_order").agg(F.count("*").alias("_rows"))
        offsets = running_total(splits, ["_order"], "_rows", "_before").select("_order", F.col("_before").alias("_shift"))
        return _numbered(rows, offsets, "_order", columns, first)
    try:
        meta = df.metadataColumn("_metadata")
        placed = df.select(
            "*",
            meta["file_path"].alias("_path"),
            meta["file_block_start"].alias("_start"),
            F.monotonically_increasing_id().alias("_at"),
        )
    except AnalysisException:
        return df.select((F.monotonically_increasing_id() + first).alias("raw_row_id"), "*")
    rows = written(placed.withColumn("_split", F.xxhash64("_path", "_start")))
    splits = rows.groupBy("_split", "_path", "_start").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    totals = running_total(splits, ["_path", "_start"], "_rows", "_before")
    offsets = totals.select("_split", (F.col("_before") - F.col("_first")).alias("_shift"))
    return _numbered(rows, offsets, "_split", df.columns, first)


def _numbered(rows: DataFrame, offsets: DataFrame, key: str, columns: list[str], first: int) -> DataFrame:
    """Number rows by their split's shift; the shifts, two longs a split, are broadcast unless there are too many."""
    stored = written(offsets)
    found = rows.join(F.broadcast(stored) if stored.count() <= SPLITS else stored, key)
    return found.select((F.col("_at") + F.col("_shift") + first).alias("raw_row_id"), *columns)


def instant(as_of: str | None) -> Column:
    """``as_of`` as a zoned timestamp; the current time when it is None."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def with_load_ts(df: DataFrame, as_of: str | None = None, name: str = "loaded_at") -> DataFrame:
    return df.withColumn(name, instant(as_of))


def land(df: DataFrame, path: str, as_of: str | None = None, append: bool = False) -> DataFrame:
    """Write source rows as the raw table, ids and load time fixed at this point, and read it back.

    ``append`` adds to the rows already there, with ids above theirs.
    """
    spark = df.sparkSession
    first = 0
    if append:
        first = spark.read.schema(RAW).parquet(path).agg(F.coalesce(F.max("raw_row_id") + 1, F.lit(0))).first()[0]
    rows = with_load_ts(with_row_id(df, first), as_of)
    rows.write.mode("append" if append else "overwrite").parquet(path)
    return spark.read.schema(RAW).parquet(path)


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), looked_up: Sequence[str] = ()) -> None:
    """Full refresh: replace the table at ``path``; single values of ``looked_up`` columns are sought by Bloom filters."""
    blooms = {f"parquet.bloom.filter.enabled#{name}": True for name in looked_up}
    # Filters are sized by the values of a row group, not at their largest.
    df.write.mode("overwrite").partitionBy(*partition_by).options(**{"parquet.bloom.filter.adaptive.enabled": True}, **blooms).parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as read from storage."""
    save_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header each; texts come back from `read_raw` unchanged.

    Quotes are doubled, and outer spaces, which the writer would strip by default, are kept.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def map_source(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """Bring another source into the canonical shape.

    ``mapping`` gives, per canonical field, a source column name or an expression;
    fields left out become NULL.
    """
    unknown = set(mapping) - set(SOURCE_FIELDS)
    if unknown:
        raise ValueError(f"not canonical fields: {sorted(unknown)}")

    def field(name: str) -> Column:
        source = mapping.get(name)
        column = F.lit(None) if source is None else F.col(source) if isinstance(source, str) else source
        return column.cast("string").alias(name)

    return df.select(*[field(name) for name in SOURCE_FIELDS])
