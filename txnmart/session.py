"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches. On a cluster, bring your own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txnmart")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only in local mode, where driver and
    executors are one process; on a cluster an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txnmart-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables of this application, under the shared folder."""
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut the lineage of ``df`` by writing it as a table and reading that back.

    Unlike ``checkpoint()`` this computes ``df`` once, and the planner sees the
    true size of the result. Tables stay until `release`, as frames read them lazily.
    """
    spark = df.sparkSession
    target = path or work_folder(spark, "table")
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application. Results that read them must be stored before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
