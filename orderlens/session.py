"""Session helpers: local sessions for tests, and a checkpoint folder that survives executors."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderlens")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ORDERLENS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, else the one set on the context.

    A temporary folder stands in only where driver and executors are one machine.
    """
    global _own_folder
    context = spark.sparkContext
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir())
    if folder:
        return folder
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="orderlens-")
        atexit.register(shutil.rmtree, _own_folder, True)
    return _own_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def staged(df: DataFrame) -> DataFrame:
    """Write a frame that several jobs will read to the shared folder, and read it back.

    Later jobs scan only the columns they need and never repeat the joins behind the frame;
    a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_kept: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, folder: str, name: str, make):
    """What ``make`` writes for an input folder, made once per application and then read as
    written. ``forget_kept`` makes later calls build anew, for a folder that has changed."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def forget_kept() -> None:
    _kept.clear()


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table that is small by construction, and fail if it is not.

    At most ``limit + 1`` rows ever reach the driver.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows, not a small table")
    return rows


def small_table(df: DataFrame, limit: int, what: str) -> DataFrame:
    """A checked-size table as a local relation, safe to broadcast."""
    return df.sparkSession.createDataFrame(bounded_rows(df, limit, what), df.schema)
