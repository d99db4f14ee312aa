"""Text functions on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import column, names


def upper(text: Column | str) -> Column:
    return F.upper(column(text))


def lower(text: Column | str) -> Column:
    return F.lower(column(text))


def trim(text: Column | str) -> Column:
    """Strip leading and trailing whitespace of every kind."""
    return F.regexp_replace(column(text), r"^\s+|\s+$", "")


def pad(text: Column | str, char: str, length: int) -> Column:
    """Append the character until the text is exactly ``length`` long; longer text is cut."""
    return F.rpad(column(text), length, char)


def concat(*parts: Column | str) -> Column:
    """Concatenate parts; plain text is constant, ``v:name`` inside it stands for a column."""
    pieces: list[Column] = []
    for part in parts:
        if isinstance(part, Column):
            pieces.append(part.cast("string"))
            continue
        for piece in re.split(r"(v:\w+)", str(part)):
            if piece.startswith("v:"):
                pieces.append(F.col(piece[2:]).cast("string"))
            elif piece:
                pieces.append(F.lit(piece))
    return F.concat(*pieces)


def join(items: Column | str, glue: str) -> Column:
    """Join a list with a separator."""
    return F.array_join(column(items), glue)


def split(text: Column | str, glue: str) -> Column:
    """Split by a literal separator; empty pieces are kept."""
    return F.split(column(text), re.escape(glue) if glue else "", -1)


def similarity(left: Column, right: Column) -> Column:
    """1 for equal text, 0 for nothing in common: edit distance over the longer length."""
    longer = F.greatest(F.length(left), F.length(right))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(left, right) / longer)


def hamming(left: Column, right: Column) -> Column:
    """Number of positions that differ, the surplus of the longer text included."""
    a, b = F.split(left, ""), F.split(right, "")
    differ = F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1))
    return F.aggregate(differ, F.lit(0), lambda acc, x: acc + x)


def substr(text: Column | str, length: int | Column, before: int | Column = 0) -> Column:
    """The part of ``length`` characters after the first ``before``; null if the text is too short."""
    t, n, b = column(text), _num(length), _num(before)
    return F.when(F.length(t) >= b + n, F.substring(t, b + 1, n))


def substr_after(text: Column | str, length: int | Column, before: int | Column = 0) -> Column:
    """Number of characters after the part; null if the text is too short."""
    t, n, b = column(text), _num(length), _num(before)
    return F.when(F.length(t) >= b + n, F.length(t) - b - n)


def _num(n: int | Column) -> Column:
    return F.lit(n) if isinstance(n, int) else n


def substrings(
    df: DataFrame,
    text: str,
    substring: str,
    before: str,
    length: str,
    after: str,
    fixed_length: int | None = None,
) -> DataFrame:
    """Generate every substring with its before, length and after counts, optionally of one length."""
    t, size = F.col(text), F.length(F.col(text))
    starts = df.withColumn(before, F.explode(F.sequence(F.lit(0), size)))
    if fixed_length is not None:
        rows = starts.withColumn(length, F.lit(fixed_length)).where(F.col(before) + fixed_length <= size)
    else:
        rows = starts.withColumn(length, F.explode(F.sequence(F.lit(0), size - F.col(before))))
    return rows.withColumn(substring, F.substring(t, F.col(before) + 1, F.col(length))).withColumn(
        after, size - F.col(before) - F.col(length)
    )


def substring_positions(df: DataFrame, text: str, substring: str, before: str, after: str) -> DataFrame:
    """One solution per place where the bound substring occurs in the text."""
    t, part = F.col(names([text])[0]), F.lit(substring)
    span = F.length(t) - len(substring)
    places = F.when(span >= 0, F.sequence(F.lit(0), span))
    hits = F.filter(places, lambda p: F.substring(t, p + 1, F.lit(len(substring))) == part)
    return df.withColumn(before, F.explode(hits)).withColumn(after, span - F.col(before))
