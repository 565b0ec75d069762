"""Two sources of the same series merged on their keys.

Rows of either side are kept. One full join does it: the keys include the date, so no single
task receives a whole station, and the rolled-up side arrives already partitioned by the keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.functions.keys import surrogate_key
from obsloom.functions.numeric import provenance, relative_difference


@dataclass(frozen=True)
class Pair:
    """A metric present in both sources: its output name and its column on each side."""

    name: str
    first: str
    second: str


def _joined(first: DataFrame, second: DataFrame, keys: list[str], pairs: list[Pair], carry: list[str]) -> DataFrame:
    left = first.select(
        *[F.col(k).alias(f"_a_{k}") for k in keys],
        *[F.col(p.first).alias(f"_a_{p.name}") for p in pairs],
        F.lit(True).alias("_in_first"),
    )
    right = second.select(
        *[F.col(k).alias(f"_b_{k}") for k in keys],
        *[F.col(p.second).alias(f"_b_{p.name}") for p in pairs],
        *carry,
    )
    on = [F.col(f"_a_{k}") == F.col(f"_b_{k}") for k in keys]
    return left.join(right, on, "full")


def _keys_and_values(keys: list[str], pairs: list[Pair]):
    return [F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys], [
        F.coalesce(f"_a_{p.name}", f"_b_{p.name}").alias(p.name) for p in pairs
    ]


def merge_sources(
    first: DataFrame,
    second: DataFrame,
    *,
    keys: list[str],
    pairs: list[Pair],
    carry: list[str] = (),
    key_name: str = "station_date_id",
) -> DataFrame:
    """All keys of either side; where both have a value the first source wins."""
    key_columns, values = _keys_and_values(keys, pairs)
    merged = _joined(first, second, keys, pairs, list(carry)).select(*key_columns, *values, *carry)
    return merged.select(surrogate_key(keys).alias(key_name), "*")


def merge_sources_qc(
    first: DataFrame,
    second: DataFrame,
    *,
    keys: list[str],
    pairs: list[Pair],
    carry: list[str] = (),
    key_name: str = "station_date_id",
    keep_second: str | None = None,
) -> DataFrame:
    """``merge_sources`` with, per metric, its provenance and the relative difference.

    Rows that only the second source has are marked as its own for every metric, present or
    not. ``keep_second`` is a prefix under which the second source's values are kept as well.
    """
    key_columns, values = _keys_and_values(keys, pairs)
    only_second = F.col("_in_first").isNull()
    sources = [
        F.when(only_second, "hourly").otherwise(provenance(f"_a_{p.name}", f"_b_{p.name}")).alias(f"{p.name}_source")
        for p in pairs
    ]
    differences = [relative_difference(f"_a_{p.name}", f"_b_{p.name}").alias(f"{p.name}_diff_pct") for p in pairs]
    second_values = [F.col(f"_b_{p.name}").alias(f"{keep_second}{p.name}") for p in pairs] if keep_second else []
    merged = _joined(first, second, keys, pairs, list(carry)).select(
        *key_columns, *values, *carry, *sources, *differences, *second_values
    )
    return merged.select(surrogate_key(keys).alias(key_name), "*")
