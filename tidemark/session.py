"""Session for local runs and the shared folder; a cluster's submitted configuration is used as it is."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows of a file of a small table, and the number of files it has at least.
FILE_ROWS, FEW = 1 << 18, 8

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; local sessions without one get a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if "folder" not in _LOCAL:
            _LOCAL["folder"] = tempfile.mkdtemp(prefix="run-")
            atexit.register(shutil.rmtree, _LOCAL["folder"], ignore_errors=True)
        folder = _LOCAL["folder"]
    return folder


def settled(df: DataFrame, rows: int | None = None, file_rows: int | None = None) -> DataFrame:
    """The rows written once to a table in the shared folder, so several uses do not compute them again.

    With `rows`, a bound of their number, a small table is written in few files in place of one for each task of a
    shuffle: one for FILE_ROWS rows, and at least FEW. With `file_rows`, no file has more rows: writers and readers hold
    up to thousands of rows at a time, which is too much where a row has megabytes. The table outlives lost executors; like checkpoint files it stays until
    the folder is cleaned, or in a local session without such a folder until the session's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    files = None if rows is None else max(FEW, -(-rows // FILE_ROWS))
    if files is not None and files < int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.coalesce(files)
    df.write.option("maxRecordsPerFile", file_rows or 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cpus: int | None = None, app: str = "tidemark") -> SparkSession:
    """Local-mode session with the settings the tests and the bench share."""
    cpus = cpus or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
