"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the bytes that are hashed, so existing keys stay equal.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(columns, null_token: str = NULL_TOKEN, separator: str = SEPARATOR) -> Column:
    """md5 over the text forms of ``columns``; a null counts as ``null_token``."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_token))
        for c in columns
    ]
    return F.md5(F.concat_ws(separator, *parts))
