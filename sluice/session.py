"""Session helpers shared by queries, jobs and tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables and folders that this process made in the shared folder and hasn't deleted yet.
_MADE: list[str] = []


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, which a cluster names in ``spark.checkpoint.dir``.

    Only in local mode, as in tests on one machine, a fresh local folder is made and set where that is unset. A
    cluster without the setting is an error: a folder of one machine would lose data with its executor.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        at = "file://" + tempfile.mkdtemp(prefix="sluice-shared-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder; nothing is made there yet."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def stored(df: DataFrame, label: str, *partition_by: str, row_group_bytes: int | None = None) -> DataFrame:
    """``df`` written once to a table in the shared folder and read back: cuts lineage and survives lost executors.

    row_group_bytes: smaller row groups for tables of large rows, as a reader holds up to 4,096 rows of a group at once.
    """
    path = fresh(df.sparkSession, label)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *labels: str) -> int:
    """Deletes what ``fresh`` and ``stored`` made under these labels (all of it without labels), and returns how many places there
    were. For tables that no frame will be read from any more: a long-running session calls it between jobs."""
    gone = [p for p in _MADE if not labels or p.rsplit("/", 1)[-1].rpartition("-")[0] in labels]
    for path in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _MADE.remove(path)
    return len(gone)
