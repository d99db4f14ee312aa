"""JSON documents, one object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Documents of JSON lines; text of bad lines is kept in ``_corrupt_record``."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
    return spark.read.options(**options).schema(wide).json(path)


def write_documents(df: DataFrame, path: str) -> None:
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
    df.write.mode("overwrite").options(**options).json(path)


def split_objects(lines: DataFrame) -> DataFrame:
    """One row per object of lines that hold several objects without a separator."""
    marked = F.regexp_replace("value", r"\}\s*\{", "}\u0001{")
    pieces = F.split(marked, "\u0001")
    # A brace pair inside a string is no boundary: such pieces do not parse alone and the line stays whole.
    ok = F.forall(pieces, lambda p: F.try_parse_json(p).isNotNull())
    return lines.select(F.explode(F.when(ok, pieces).otherwise(F.array("value"))).alias("value"))
