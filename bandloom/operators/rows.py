"""Choosing rows: populations, latest row per key, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import row_digest

POPULATION = ["platform", "user_type"]


def as_list(value: str | Sequence[str] | None) -> list[str] | None:
    return [value] if isinstance(value, str) else None if value is None else list(value)


def filter_population(
    df: DataFrame,
    platforms: str | Sequence[str] | None = None,
    user_types: str | Sequence[str] | None = None,
) -> DataFrame:
    """Keep the wanted platforms and user types; the filter reaches the Parquet scan."""
    for column, wanted in (("platform", as_list(platforms)), ("user_type", as_list(user_types))):
        if wanted is not None:
            df = df.filter(F.col(column).isin(*wanted))
    return df


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle too, so a key
    that holds a third of all rows sends one row per input partition, not all of them.
    """
    window = Window.partitionBy(*as_list(keys)).orderBy(*order)
    rank = "__row_of_key"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    latest_by: str | Sequence[str] | None = "created_at",
    tie_break: str | Sequence[str] | None = None,
) -> DataFrame:
    """The latest row of every key; null times are the oldest.

    Rows of equal time are told apart by ``tie_break`` (highest first) or else by the row's content,
    so that a rerun, or a task that runs again on another executor, keeps the same row.
    """
    ties = as_list(tie_break)
    order = [F.col(name).desc_nulls_last() for name in as_list(latest_by) or []]
    order += [F.col(name).desc_nulls_last() for name in ties] if ties else [row_digest(df).desc()]
    return first_per_key(df, keys, order)


def duplicate_count(df: DataFrame, key: str = "id") -> DataFrame:
    """How many rows ``latest_per_key`` would remove: one row with row_count and duplicates.

    Null keys count as one key, because the window keeps one row for them.
    """
    rows = F.count(F.lit(1))
    kept = F.count_distinct(F.col(key)) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    return df.agg(rows.alias("row_count"), (rows - kept).alias("duplicates"))
