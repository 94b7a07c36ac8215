"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .sql import double, number, quoted, text

Fill = float | int | str | bool


def lower_columns(df: DataFrame) -> DataFrame:
    """Fold every column name to lower case; two names that fold together are an error."""
    names = [name.lower() for name in df.columns]
    repeated = sorted(name for name, n in Counter(names).items() if n > 1)
    if repeated:
        raise ValueError(f"columns are not unique after lower-casing: {repeated}")
    return df.toDF(*names)


def require_columns(df: DataFrame, names: list[str]) -> None:
    """Raise when a named column is absent (names are compared without case)."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in names if name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")


def row_digest(df: DataFrame) -> Column:
    """A hash of the row's content, used to break ties the same way on every run.

    Map columns cannot be hashed or ordered by Spark and are left out.
    """
    hashable = [
        F.col(f"`{field.name}`") for field in df.schema.fields if not _holds_map(field.dataType)
    ]
    return F.xxhash64(*hashable)


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(field.dataType) for field in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def column_type(df: DataFrame, name: str) -> T.DataType:
    """The type of a column, found without regard to case."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise ValueError(f"missing columns [{name!r}]; available: {df.columns}")


def equals_fill(df: DataFrame, name: str, fill: Fill) -> str:
    """SQL for whether a value is the one written in place of a missing value.

    Each column gets a literal of its own kind: a number is looked for in a text column by reading the
    text as a number, and a text fill is compared with the value's text. No value equals a null fill.
    """
    if fill is None:
        return "false"
    if isinstance(fill, str):
        return f"CAST({quoted(name)} AS STRING) = {text(fill)}"
    dtype = column_type(df, name)
    if isinstance(fill, int) and isinstance(dtype, T.IntegralType):
        return f"{quoted(name)} = {int(fill)}"
    return f"{number(name)} = {double(fill)}"
