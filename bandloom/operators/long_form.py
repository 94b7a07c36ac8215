"""The long form: one row per population, metric, value and band.

``band_no`` is null for the band of values that fall in no band and for metrics without bands;
``n_bands`` and ``edges`` say how many bands the value is cut into and where.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions.sql import quoted
from .rows import POPULATION

# Columns of the long form and their types, in order.
LONG_COLUMNS = {
    "platform": "string",
    "user_type": "string",
    "metric_name": "string",
    "value_name": "string",
    "band_no": "int",
    "band_label": "string",
    "cnt": "bigint",
    "metric_value": "double",
    "total": "double",
    "n_bands": "int",
    "edges": "array<double>",
}
# The same, as a window of SQL text: all rows of one population.
WHOLE_POPULATION = f"PARTITION BY {', '.join(POPULATION)}"


def to_long(df: DataFrame, **columns: str) -> DataFrame:
    """Project to the long form: given SQL expressions first, then columns of that name, then null."""
    present = set(df.columns)

    def value(name: str) -> str:
        return columns.get(name) or (name if name in present else "NULL")

    return df.selectExpr(
        *[f"CAST({value(name)} AS {kind}) AS {name}" for name, kind in LONG_COLUMNS.items()]
    )


def rows_from(df: DataFrame, keep: Sequence[str], rows: Sequence[Mapping[str, str]]) -> DataFrame:
    """Turn a wide aggregate row into one row per entry of ``rows`` (column name to SQL expression).

    Runs on aggregates, never on the data.
    """
    structs = [
        "struct(" + ", ".join(f"{value} AS {quoted(name)}" for name, value in row.items()) + ")"
        for row in rows
    ]
    return df.selectExpr(*POPULATION, *keep, f"inline(array({', '.join(structs)}))")
