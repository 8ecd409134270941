"""Session settings and stored intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reelrank")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs rely on to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def _folder(spark: SparkSession) -> str | None:
    """Folder every executor can reach: ``spark.checkpoint.dir``; a temporary one only for a local session."""
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        return None
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelrank-"))
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """The folder, for files that must outlive the job's executors."""
    folder = _folder(spark)
    if folder is None:
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    return folder


_PREFIX = "reelrank-"
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A row group may be a few values; by default the writer holds a hundred before it looks at their size.
_LARGE_VALUES = {"parquet.block.size": str(2 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "8",
                 "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "8"}
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def stored_path(spark: SparkSession) -> str:
    """A new path in the shared folder, removed with the application's stored tables."""
    return f"{shared_folder(spark)}/{_PREFIX}{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


_VIEW = "_reelrank_view"


def as_view(df: DataFrame, source: object) -> DataFrame:
    """Mark ``df`` as rows read from tables that are stored already, which ``source`` names."""
    setattr(df, _VIEW, source)
    return df


def view_source(df: DataFrame) -> object | None:
    return vars(df).get(_VIEW)


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Cut lineage at a table several later steps read: write it to the shared folder and scan it.

    The rows outlive the executors that wrote them. Parquet rather than a row checkpoint, so later
    steps read only their columns and joins know the size of the table. Where a cluster names no shared folder the
    rows are kept by the executors, with their lineage. What is a view of stored tables is not written again. ``by`` makes a
    folder for each value of a column, for packed values that are read by folder.
    """
    if view_source(df) is not None:
        return df
    spark = df.sparkSession
    if _folder(spark) is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = stored_path(spark)
    # The write's shuffles are read by nothing else; their files go when it is done.
    settings = {_CLEAN_UP: "true"}
    writer = df.write
    if by:
        # A task keeps the files of its folders open in place of sorting large values.
        settings[_OPEN_FILES] = "64"
        writer = writer.partitionBy(by).option("compression", "zstd").options(**_LARGE_VALUES)
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        writer.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``materialize`` made and nothing reads any more."""
    spark = df.sparkSession
    if _folder(spark) is None:
        df.unpersist()
        return
    for path in {name.rpartition("/")[0] for name in df.inputFiles() if f"/{_PREFIX}{spark.sparkContext.applicationId}/" in name}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard_stored(spark: SparkSession) -> None:
    """Remove the tables this application has stored; call it when the results of a job are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{_PREFIX}{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
