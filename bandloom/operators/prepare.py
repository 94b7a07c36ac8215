"""From feature, score and production tables to one scored population."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import lower_columns, row_digest
from .rows import as_list, first_per_key, latest_per_key

# Names the sources use, and the names of the common model.
RENAMES = {
    "v30_pred_prob": "output_value",
    "user_type_final": "user_type",
    "score": "bureau_score",
    "instalment_no_months": "tenure",
}
# The JSON column of the sources and the keys read from it.
JSON_COLUMN = "new_bureau_variables"
JSON_KEYS = ["active_cc_count", "active_pl_count"]
# Fixed value: the production column that holds the id of the scored row.
REFERENCE_KEY = "bureau_reference_number"


def platform_from_channel(
    channel: Column, platforms: Mapping[str, str], otherwise: str
) -> Column:
    """The platform a channel belongs to; unknown and missing channels belong to ``otherwise``."""
    platform = F.lit(otherwise)
    for name, value in platforms.items():
        platform = F.when(channel == name, value).otherwise(platform)
    return platform


def drop_columns(
    df: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = ()
) -> DataFrame:
    """Drop columns by name and by the start of their name; absent names are fine."""
    unwanted = {name.lower() for name in names}
    starts = tuple(prefix.lower() for prefix in prefixes)
    return df.drop(
        *[
            name
            for name in df.columns
            if name.lower() in unwanted or (starts and name.lower().startswith(starts))
        ]
    )


def prepare_source(
    features: DataFrame,
    outputs: DataFrame,
    production: DataFrame,
    platform: Column,
    *,
    id_column: str = "id",
    reference_key: str = REFERENCE_KEY,
    latest_by: str = "created_at",
    tie_break: str | Sequence[str] | None = None,
    drop_from_production: Sequence[str] = (),
    drop: Sequence[str] = (),
    drop_prefixes: Sequence[str] = (),
    one_row_per_id: bool = False,
    only: Sequence[str] | None = None,
    features_order: str | Sequence[str] | None = None,
    outputs_order: str | Sequence[str] | None = None,
) -> DataFrame:
    """Join the scores and features of one source with the latest production row of each id.

    All three tables meet on the id. With ``one_row_per_id`` features and scores are reduced to a row
    per id before they are joined, and a repeated id then never multiplies in the join. Which copy of an id is
    kept does not depend on what else is asked for: the highest by ``features_order`` or ``outputs_order``, or
    else, of a table read from files, the last by file name and place in the file, or else the highest by
    a hash of the whole row. With ``only`` no column is read beside these, the keys, the orders and, for want of an
    order or a place, the columns of that hash.
    """
    keys = {id_column.lower(), reference_key.lower(), latest_by.lower(), "platform"}
    ties = {name.lower() for name in as_list(tie_break) or []}
    asked = None if only is None else {name.lower() for name in only}

    def trim(
        df: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = (), kept: Sequence[str] = ()
    ) -> DataFrame:
        # Unwanted columns go before rows are chosen, so that they are never read.
        own = keys | ties | {name.lower() for name in kept}
        needed = [name for name in df.columns if name.lower() in own]
        rest = drop_columns(df.drop(*needed), names, prefixes).columns
        return df.select(*needed, *(name for name in rest if asked is None or name.lower() in asked))

    def one_per_id(df: DataFrame, order: str | Sequence[str] | None) -> DataFrame:
        df, places = with_place(df, as_list(order) or [])
        trimmed = trim(df, drop, drop_prefixes, [*places, *(as_list(order) or [])])
        by = [F.col(name).desc_nulls_last() for name in [*(as_list(order) or []), *places]]
        chosen = first_per_key(trimmed, id_column, by)
        return chosen.select(*trim(df.drop(*places), drop, drop_prefixes).columns)

    if one_row_per_id:
        features, outputs = one_per_id(features, features_order), one_per_id(outputs, outputs_order)
    else:
        features, outputs = trim(features, drop, drop_prefixes), trim(outputs, drop, drop_prefixes)
    only_here = [name for name in drop_from_production if name.lower() not in keys]
    production = production.withColumn("platform", platform)
    production = trim(production, [*only_here, *drop], drop_prefixes)
    latest = latest_per_key(production, reference_key, latest_by, tie_break)
    joined = outputs.join(features, on=id_column, how="inner").join(
        drop_columns(latest, only_here), F.col(id_column) == F.col(reference_key), "inner"
    )
    return drop_columns(lower_columns(joined), drop, drop_prefixes)


def with_place(df: DataFrame, order: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The rows with columns that tell rows of one key apart, whatever columns are read of them later: with an order
    none, else the place in their file, else a hash of the whole row."""
    if order:
        return df, []
    try:
        placed = df.select("*", F.xxhash64("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__place"))
        placed.schema  # noqa: B018 - only rows straight from files have a place
        return placed, ["__file", "__place"]
    except AnalysisException:
        return df.withColumn("__digest", row_digest(df)), ["__digest"]


def json_keys(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Read a column of JSON objects as a map and give each wanted key a text column.

    Text that is no JSON object gives a null map, a missing key a null value.
    """
    df = df.withColumn(column, F.from_json(F.col(column), "map<string,string>"))
    return df.withColumns({key: F.col(column).getItem(key) for key in keys})


def merge_sources(
    sources: Sequence[DataFrame],
    *,
    json_column: str | None = JSON_COLUMN,
    keys: Sequence[str] = JSON_KEYS,
    renames: Mapping[str, str] = RENAMES,
) -> DataFrame:
    """Stack the sources by column name (all must have the same columns) and give them the common names."""
    merged = reduce(DataFrame.unionByName, sources)
    if json_column is not None:
        merged = json_keys(merged, json_column, keys)
    present = {name.lower(): name for name in merged.columns}
    return merged.withColumnsRenamed(
        {present[old.lower()]: new for old, new in renames.items() if old.lower() in present}
    )
