"""CSV sources and sinks, and the import of CSV files as typed documents."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripleframe.functions.ids import assign_ids
from tripleframe.model import SPARK_TYPES, ClassDef, names
from tripleframe.operators.validate import infer_class, profile

# Texts that mean a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Texts are written as they are: quotes doubled, blanks at the ends kept.
_WRITE = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@dataclass(frozen=True)
class CsvSource:
    """A CSV file or folder at any path Spark can read."""

    path: str
    options: dict[str, Any] = field(default_factory=dict)

    def load(self, spark: SparkSession) -> DataFrame:
        options = {"header": True, "sep": ",", "quote": '"', "escape": '"', **self.options}
        header = options.pop("format_header", options.pop("header"))
        options.pop("format", None)
        return spark.read.options(header=header, **options).csv(self.path)


def file(path: str, opts: dict[str, Any] | None = None) -> CsvSource:
    """A CSV source by path."""
    return CsvSource(path, opts or {})


def remote(uri: str, opts: dict[str, Any] | None = None) -> CsvSource:
    """A CSV source by URI of a file system the cluster can read."""
    return CsvSource(uri, opts or {})


def post(path: str, opts: dict[str, Any] | None = None) -> CsvSource:
    """A CSV source that was uploaded to a path the cluster can read."""
    return CsvSource(path, opts or {})


@dataclass(frozen=True)
class As:
    """Binding of a source column, by name or 0-based index, to a variable, with an optional type."""

    column: str | int
    variable: Any
    type: str | None = None


def as_(column: str | int, variable: Any, type: str | None = None) -> As:
    return As(column, variable, type)


def get(spark: SparkSession, as_vars: Sequence[As], source: CsvSource) -> DataFrame:
    """Read a source and bind its columns to variables; only bound columns are parsed."""
    df = source.load(spark)
    cols = []
    for a in as_vars:
        held = df.columns[a.column] if isinstance(a.column, int) else a.column
        value = F.col(f"`{held}`")
        if a.type:
            value = value.try_cast(SPARK_TYPES.get(a.type, a.type))
        cols.append(value.alias(names([a.variable])[0]))
    return df.select(*cols)


def put(df: DataFrame, as_vars: Sequence[As], source: CsvSource) -> None:
    """Write bindings as CSV; index mappings give the order of the columns."""
    cols = []
    for n, a in enumerate(as_vars):
        name = names([a.variable])[0]
        place = a.column if isinstance(a.column, int) else n
        cols.append((place, F.col(name).alias(name if isinstance(a.column, int) else a.column)))
    options = {k: v for k, v in source.options.items() if k not in ("format", "format_header")}
    ordered = [c for _, c in sorted(cols, key=lambda x: x[0])]
    df.select(*ordered).write.mode("overwrite").options(**{**_WRITE, **options}).csv(source.path)


def class_name_of(path: str) -> str:
    """Class name from a file name: words title-cased and joined."""
    stem = os.path.basename(path.rstrip("/")).split(".")[0]
    return stem.replace("_", " ").title().replace(" ", "")


def clean_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace(".", "_")


def import_csv(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = (),
    class_name: str | None = None,
    na: str = "skip",
    id_: str | None = None,
    embedded: Sequence[str] = (),
    sep: str = ",",
    definition: ClassDef | None = None,
) -> tuple[DataFrame, ClassDef]:
    """Typed documents of a CSV file and their class.

    ``na``: ``skip`` drops rows with a missing value, ``error`` raises, ``optional`` keeps them and makes the
    properties optional. Ids come from the id column, else from the keys, else from all columns; documents with
    optional properties and no keys get random ids.
    """
    cls = class_name or class_name_of(path)
    df = CsvSource(path, {"sep": sep}).load(spark)
    df = df.toDF(*[clean_name(c) for c in df.columns])
    df = df.select([F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in df.columns])
    if id_ is not None and id_ not in df.columns:
        raise ValueError(f"the id column {id_} is missing")
    # One pass over the file tells missing values and datatypes.
    seen = profile(df, complete=na == "skip")
    if na == "error" and seen.nulls:
        raise ValueError("the data has missing values: skip the records or make the properties optional")
    if na == "skip":
        df = df.dropna("any")
    elif seen.nulls & set(keys):
        raise ValueError("a key column has missing values")
    found = definition or infer_class(df, cls, keys, na, id_, embedded, seen)
    kinds = {c: seen.kind(c) for c in df.columns}
    typed = df.select(
        [
            F.concat(F.lit(f"{cls}/"), F.col(c)).alias(c) if c in embedded else F.trim(F.col(c)).try_cast(kinds[c]).alias(c)
            if kinds[c] != "string"
            else F.col(c)
            for c in df.columns
        ]
    )
    if id_ is not None:
        made = F.concat(F.lit(f"{cls}/"), F.col(id_).cast("string"))
        return typed.select(made.alias("id"), *typed.columns), found
    if keys:
        return assign_ids(typed, cls, "Lexical", list(keys)), found
    if na == "optional":
        return assign_ids(typed, cls, "Random"), found
    return assign_ids(typed, cls, "Lexical", typed.columns), found


def export_csv(df: DataFrame, path: str) -> None:
    """Write a flat table as CSV."""
    df.write.mode("overwrite").options(**_WRITE).csv(path)
