"""Join on a key that is stored with a prefix on one side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_on_prefixed_key(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, prefix: str = ""
) -> DataFrame:
    """Inner equi-join where ``prefix + left_key`` equals ``right_key``.

    The computed text is a plain join key: the join is a hash or sort-merge join, never a loop.
    """
    key = left[left_key]
    if prefix:
        key = F.concat(F.lit(prefix), key.cast("string"))
    return left.join(right, key == right[right_key], "inner")
