"""Documents and results as streams: JSON lines in, row-wise delivery of a finished result out.

Filters, column functions and joins with a static side run unchanged on the streaming frame.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_documents(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Streaming frame of JSON documents that arrive as files in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def append_documents(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append every document that has arrived to a Parquet class table, exactly once, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def deliver(df: DataFrame) -> Iterator[str]:
    """A finished result as JSON records: preface with the variable names, one per binding, postscript.

    One partition is held at a time.
    """
    yield json.dumps({"@type": "PrefaceRecord", "names": df.columns})
    rows = 0
    for line in _lines(df):
        rows += 1
        yield line
    yield json.dumps({"@type": "PostscriptRecord", "bindings": rows})


def _lines(df: DataFrame) -> Iterator[str]:
    body = F.to_json(F.struct(F.lit("Binding").alias("@type"), *df.columns))
    for row in df.select(body.alias("line")).toLocalIterator():
        yield row["line"]
