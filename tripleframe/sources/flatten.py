"""Flat tables of documents: nested documents and references spread into dotted columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.model import Schema

DOCUMENT_ID = "Document id"


def _expand_structs(df: DataFrame, keepid: bool) -> DataFrame:
    """Spread struct columns that carry an id into ``column.field``."""
    cols = []
    for f in df.schema.fields:
        inner = f.dataType
        if isinstance(inner, T.StructType) and "@id" in inner.names:
            kept = [n for n in inner.names if keepid or not n.startswith("@")]
            cols += [F.col(f"`{f.name}`")[n].alias(f"{f.name}.{n}") for n in kept]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def flatten_documents(
    table: DataFrame,
    schema: Schema,
    cls: str,
    tables: dict[str, DataFrame] | None = None,
    max_embed_dep: int = 0,
    keepid: bool = False,
) -> DataFrame:
    """Flat table of one class; references are replaced by the columns of the referenced document.

    One left join per reference column and level. The loop runs over the schema, never over the data.
    References to the class itself and enums are not followed.
    """
    if max_embed_dep > 0 and tables is None:
        raise ValueError("the tables of the referenced classes are needed")
    if max_embed_dep > 0 and cls not in schema:
        raise ValueError(f"{cls} not found in the schema")
    head = "@id" if keepid else DOCUMENT_ID
    props = [c for c in table.columns if c != "id" and (keepid or not c.startswith("@"))]
    cols = [F.col("id").alias(head)]
    if keepid:
        cols.append(F.lit(cls).alias("@type"))
    df = _expand_structs(table.select(*cols, *[F.col(f"`{c}`") for c in props]), keepid)
    ranges = {name: p.range for name, p in schema.properties(cls).items() if not p.is_data} if cls in schema else {}
    for _ in range(max_embed_dep):
        open_ = {
            c: r
            for c, r in ranges.items()
            if c in df.columns and r != cls and r in schema and schema[r].kind != "enum" and tables and r in tables
        }
        if not open_:
            break
        for path, target_cls in open_.items():
            df, nested = _embed(df, path, target_cls, tables[target_cls], schema, keepid)
            del ranges[path]
            ranges.update(nested)
    return df


def _embed(
    df: DataFrame, path: str, target_cls: str, target: DataFrame, schema: Schema, keepid: bool
) -> tuple[DataFrame, dict[str, str]]:
    inner = [c for c in target.columns if c != "id"]
    marks = [F.col("id").alias("_ref")]
    if keepid:
        marks += [F.col("id").alias(f"{path}.@id"), F.lit(target_cls).alias(f"{path}.@type")]
    side = target.select(*marks, *[F.col(f"`{c}`").alias(f"{path}.{c}") for c in inner])
    joined = df.join(side, F.col(f"`{path}`") == F.col("_ref"), "left")
    cols = []
    for c in df.columns:
        if c != path:
            cols.append(F.col(f"`{c}`"))
            continue
        cols += [F.col(f"`{n}`") for n in side.columns if n != "_ref"]
    nested = {f"{path}.{n}": p.range for n, p in schema.properties(target_cls).items() if not p.is_data}
    return joined.select(*cols), nested
