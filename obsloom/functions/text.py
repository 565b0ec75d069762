"""Text expressions used to clean, split and label names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_ALPHANUMERIC = "[^a-z0-9]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nth_part(text, separator: str, n: int) -> Column:
    """Trimmed ``n``-th part of ``text``; negative ``n`` counts from the end, '' when absent."""
    return F.trim(F.split_part(_col(text), F.lit(separator), F.lit(n)))


def parts_of(text, separator: str) -> Column:
    """All trimmed parts as an array."""
    return F.transform(F.split(_col(text), f"\\Q{separator}\\E", -1), lambda part: F.trim(part))


def digits_to_long(text) -> Column:
    """Strip everything but digits and read a bigint; a text without digits raises."""
    return F.regexp_replace(_col(text), "[^0-9]+", "").cast("bigint")


def word_tokens(text, separator: str = NOT_ALPHANUMERIC) -> Column:
    """Lower-case and split on runs of other characters; edge parts may be ''."""
    return F.split(F.lower(_col(text)), separator)


def hour_label(hour) -> Column:
    """``7`` becomes ``07:00``."""
    return F.concat(F.lpad(_col(hour).cast("string"), 2, "0"), F.lit(":00"))
