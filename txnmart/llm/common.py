"""Helpers of the operators: tables, the place of a row, and picking rows by place."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmart.session import written

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
PLACE = ["_file", "_row"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``df`` with ``_file`` and ``_row``, the place of each row in its files.

    The place tells repeated rows and NULL ids apart, and stays the same when a task is
    run again. A frame that isn't read from files directly is written first.
    """

    def located(frame: DataFrame) -> DataFrame:
        meta = frame.metadataColumn("_metadata")
        return frame.select(*columns, meta["file_path"].alias("_file"), meta["row_index"].alias("_row"))

    try:
        return located(df)
    except AnalysisException:
        return located(written(df))


def rows_at(df: DataFrame, places: DataFrame, copies: str | None = None) -> DataFrame:
    """The rows of ``df`` (as read from files) at ``places``, whose places are unique.

    With ``copies``, a column of ``places``, each row comes that many times.
    """
    meta = df.metadataColumn("_metadata")
    rows = df.select(F.struct("*").alias("_doc"), meta["file_path"].alias("_file"), meta["row_index"].alias("_row"))
    found = rows.join(places.hint("shuffle_hash"), PLACE, "inner" if copies else "left_semi")
    if copies:
        found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies).cast("long"))))
    return found.select("_doc.*")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
