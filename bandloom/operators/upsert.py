"""Upsert with soft delete, as a DataFrame operation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import require_columns
from .result import STORE_KEY


def with_active_flag(df: DataFrame) -> DataFrame:
    """Rows that do not say whether they are active are, whether the column is absent or null."""
    if "is_active" in {name.lower() for name in df.columns}:
        return df.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
    return df.withColumn("is_active", F.lit(True))


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two active rows have the same key; a null is a key like any other."""
    twice = df.filter("is_active").groupBy(*keys).count().filter("count > 1").head()
    if twice is not None:
        raise ValueError(f"more than one active row with the key {twice.asDict()}")


def retire_matches(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = tuple(STORE_KEY)
) -> DataFrame:
    """Existing rows, with ``is_active`` turned off where an incoming row has the same key.

    Keys are compared null-safe, which is an ordinary join key for Spark. The incoming side is reduced
    to distinct keys first: the join never multiplies rows, and if one key holds much of the store,
    its rows can be split over tasks by the adaptive skew join.
    """
    require_columns(existing, [*keys, "is_active"])
    require_columns(incoming, list(keys))
    hits = incoming.select(*[F.col(key).alias(f"__{key}") for key in keys]).distinct()
    hits = hits.withColumn("__hit", F.lit(True))
    same_key = reduce(
        lambda left, right: left & right,
        [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys],
    )
    active = F.col("is_active") & F.col("__hit").isNull()
    return existing.join(hits, same_key, "left").select(
        *[active.alias(name) if name == "is_active" else F.col(name) for name in existing.columns]
    )


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = tuple(STORE_KEY)
) -> DataFrame:
    """Existing rows with replaced ones inactive, followed by the incoming rows."""
    incoming = with_active_flag(incoming)
    return retire_matches(existing, incoming, keys).unionByName(incoming)


def verify_counts(
    df: DataFrame, keys: Sequence[str] = (*STORE_KEY, "benchmark_id")
) -> DataFrame:
    """Rows per key and active flag."""
    return df.groupBy(*keys, "is_active").agg(F.count(F.lit(1)).alias("row_count"))
