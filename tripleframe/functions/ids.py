"""Document ids: lexical, hash, value hash and random."""

from __future__ import annotations

import secrets
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.model import column

RANDOM_LENGTH = 16


def quote(value: Column) -> Column:
    """Percent-encode text; letters, digits and ``_ . - ~ /`` stay as they are."""
    out = F.url_encode(value.cast("string"))
    # Where form encoding differs from percent encoding of a path.
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


def idgen(prefix: str, keys: Sequence[Any]) -> Column:
    """Lexical id: the prefix and the quoted key values joined by underscores."""
    return F.concat_ws("_", F.lit(prefix), *[quote(column(k)) for k in keys])


def lexical(class_name: str, keys: Sequence[Any]) -> Column:
    """Lexical document id: ``Class/`` and the quoted key values joined by underscores."""
    return F.concat(F.lit(f"{class_name}/"), F.concat_ws("_", *[quote(column(k)) for k in keys]))


def unique(prefix: str, keys: Sequence[Any]) -> Column:
    """Hash id: the prefix and the MD5 of the concatenated key values."""
    return F.concat(F.lit(prefix), F.md5(F.concat(*[column(k).cast("string") for k in keys])))


def hashed(class_name: str, keys: Sequence[Any]) -> Column:
    """Hash document id: ``Class/`` and the SHA-256 of the key values joined by underscores."""
    text = F.concat_ws("_", *[quote(column(k)) for k in keys])
    return F.concat(F.lit(f"{class_name}/"), F.sha2(text, 256))


def value_hash(class_name: str, props: Sequence[str]) -> Column:
    """Value hash document id: ``Class/`` and the SHA-256 of the whole value."""
    return F.concat(F.lit(f"{class_name}/"), F.sha2(F.to_json(F.struct(*sorted(props))), 256))


@F.pandas_udf(T.StringType())
def _token(row: pd.Series) -> pd.Series:
    return pd.Series([secrets.token_urlsafe(12) for _ in range(len(row))])


def random_id(prefix: str) -> Column:
    """Prefix and 16 random characters from a secure source; write the frame before using it twice."""
    return F.concat(F.lit(prefix), _token.asNondeterministic()(F.lit(0)))


def assign_ids(
    df: DataFrame, class_name: str, strategy: str, fields: Sequence[str] = (), name: str = "id"
) -> DataFrame:
    """Add document ids by the key strategy of a class."""
    props = [c for c in df.columns if c != name]
    made = {
        "Lexical": lambda: lexical(class_name, fields),
        "Hash": lambda: hashed(class_name, fields),
        "ValueHash": lambda: value_hash(class_name, props),
        "Random": lambda: random_id(f"{class_name}/"),
    }[strategy]()
    out = df.select(made.alias(name), *props)
    if strategy != "Random":
        return out
    from tripleframe.session import cut

    return cut(out)
