"""Features side by side: stacking them, and counting their distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import column_type, require_columns
from ..functions.sql import quoted, text
from .counting import values_table
from .long_form import to_long
from .rows import POPULATION


def unpivot_features(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """One row per input row and feature: ids, feature, value (the features share one type)."""
    require_columns(df, [*ids, *features])
    return df.unpivot(list(ids), list(features), "feature", "value")


def distinct_rates(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-null values per feature, and the number of rows, from one scan.

    An entry holds a value as a number, a whole number or a text, whichever keeps all values of its feature
    apart. The shuffle is on population, feature *and* value, so neither a large population nor a frequent
    value gathers in one task, and repeated values collapse before it.
    """
    require_columns(df, [*POPULATION, *features])
    if not features:
        raise ValueError("at least one feature is needed")
    kinds = {name: _kind(column_type(df, name)) for name in features}
    ordered = sorted(features, key=lambda name: list(_KINDS).index(kinds[name]))
    arrays, before = [], 0
    for kind in _KINDS:
        names = [name for name in ordered if kinds[name] == kind]
        values = [f"CAST({quoted(name)} AS {kind})" for name in names]
        arrays.append(f"array({', '.join([*[f'CAST(NULL AS {kind})'] * before, *values])})" if names
                      else f"CAST(array() AS ARRAY<{kind}>)")
        before += len(names)
    stacked = df.selectExpr(*POPULATION, f"posexplode(arrays_zip({', '.join(arrays)})) AS (m, entry)")
    parts = [f"entry.`{i}` AS {letter}" for i, letter in enumerate("lds")]
    values = stacked.selectExpr(*POPULATION, "m", *parts).groupBy(*POPULATION, "m", *"lds").agg(F.expr("count(*) AS n"))
    counts = values.groupBy(*POPULATION, "m").agg(
        F.expr("count_if(l IS NOT NULL OR d IS NOT NULL OR s IS NOT NULL) AS cnt"), F.expr("sum(n) AS total")
    )
    names = values_table(df.sparkSession, "m, value_name", [[str(m), text(name)] for m, name in enumerate(ordered)])
    return to_long(counts.join(names, "m"), metric_name="'DISTINCT_RATE'", metric_value="cnt")


# Types that hold every value of the others apart, in the order of their arrays.
_KINDS = {
    "bigint": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "double": (T.FloatType, T.DoubleType),
    "string": (T.DataType,),
}


def _kind(dtype: T.DataType) -> str:
    return next(kind for kind, types in _KINDS.items() if isinstance(dtype, types))
