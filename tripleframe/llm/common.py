"""Helpers shared by the operators on texts, pages and vectors."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import SimpleNamespace
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripleframe.session import configure

#: A word, for every operator that counts or joins words.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one Arrow batch handled at a time inside a task.
SLICE_ROWS = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return configure(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds at most ``rows`` rows and, unless one row is larger, about ``size`` bytes."""
    for batch in batches:
        at, step = 0, max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
        while at < batch.num_rows:
            yield batch.slice(at, step)
            at += step


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings, null as the empty string."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def map_text(df: DataFrame, text: str, new: str, make: Callable[[], Callable[[list[str]], dict[str, pa.Array]]]) -> DataFrame:
    """Replace the text column by columns computed from it, in Arrow batches, one state per task.

    ``new`` is the schema text of the added columns; ``make`` is called once in a task and returns the function that turns
    a list of texts into Arrow arrays. A row stays a row; other columns are carried, but a column that has the name of a
    result gives way to it.
    """
    added = StructType.fromDDL(new)
    kept = [f for f in df.schema.fields if f.name != text and f.name not in added.names]
    df = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`"))
    schema = StructType(kept + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in slices(batches):
            # The text is the last column.
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            made = work(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made.values()], names=[*batch.schema.names[:-1], *made])

    return df.mapInArrow(run, schema)


def held(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once in a Python worker and kept for its later tasks, which run one after another.

    The code of a task comes with it, so the place is one that all tasks of a worker see.
    """
    kept = sys.modules.setdefault("_tripleframe_held", SimpleNamespace(values={})).values
    if key not in kept:
        kept[key] = make()
    return kept[key]


def forget() -> None:
    """Drop what earlier tasks left in the Python worker through ``held``; for tasks that need the memory and none of it."""
    if kept := sys.modules.get("_tripleframe_held"):
        kept.values.clear()


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list[str | Column], value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the rows of the group that come before each row.

    ``bucket`` must not fall along the order (rows of a lower bucket come first). Groups are summed by (group, bucket), the
    bucket totals are summed along the group, so no task ever holds a whole group. The bucket totals join back on the
    group, null groups included.
    """
    inner = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    bases = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_base"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = df.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return inside.join(bases, same).withColumn(out, F.col("_base") + F.col("_in")).drop("_base", "_in", *[f"_k{i}" for i in range(len(keys))])


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, and the whole row as ``_row``: extra columns of any name cannot clash while an operator works."""
    return df.select(*columns, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """CRC-32 of the id's text by a modulus; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> pd.DataFrame:
    """At most ``rows`` rows, the same at every run: those with the smallest hash of ``keys``, which should tell rows apart.

    Rows whose hash is beyond what twice as many rows need are dropped where they are read, so a task sends few rows.
    """
    share = min(1.0, 2 * rows / max(1, df.count()))
    hashed = F.xxhash64(*keys)
    small = df.where(hashed <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))))
    return small.orderBy(hashed, *keys).limit(rows).toPandas()


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function that does not overflow."""
    return 0.5 * (np.tanh(0.5 * x) + 1.0)
