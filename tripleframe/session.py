"""Session settings, durable lineage cuts and size checks shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the split costs a shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows may be long; what goes to Python at once is held by both processes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the operators rely on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts: ``spark.checkpoint.dir``, a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tripleframe-")
    return _local_dirs[app]


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tripleframe/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{_folder(spark)}/{uuid.uuid4().hex}"


def cut(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back.

    Cuts the lineage of iterative operators; the table outlives lost executors, is written once,
    and gives the next plan real file statistics. ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict[str, int]]:
    """``cut`` together with aggregates of the written rows, taken in the same job."""
    seen = Observation()
    table = cut(df.observe(seen, *[m.alias(name) for name, m in measures.items()]))
    return table, seen.get


def discard(table: DataFrame) -> None:
    """Delete a table that ``cut`` wrote; frames built on it end with it."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete the tables this application wrote to the shared folder; frames built on them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions used where a width has to be named."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
