"""Benchmark metadata: score cuts, feature cuts, fill values, feature types.

Metadata is control data: it shapes the plan and so is read on the driver. A limit on the number of
entries keeps a wrong path from pulling a data table there.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import Fill

MAX_ENTRIES = 100_000


def _lower_keys(values: Mapping[str, Any], what: str) -> dict[str, Any]:
    lowered: dict[str, Any] = {}
    for key, value in values.items():
        if key.lower() in lowered:
            raise ValueError(f"{what}: {key!r} is given twice (names are compared without case)")
        lowered[key.lower()] = value
    return lowered


@dataclass
class Metadata:
    """What a model's benchmark is computed with. Each part is needed only by metrics that use it."""

    score_cuts: list[float] = field(default_factory=list)
    fills: dict[str, Fill] = field(default_factory=dict)
    feature_cuts: dict[str, list[float | None]] = field(default_factory=dict)
    feature_types: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.fills = _lower_keys(self.fills, "fills")
        self.feature_cuts = _lower_keys(self.feature_cuts, "feature cuts")
        self.feature_types = _lower_keys(self.feature_types, "feature types")

    def to_json(self) -> str:
        return json.dumps(
            {
                "score_cuts": list(self.score_cuts),
                "fillna_dict": self.fills,
                "feature_cuts": self.feature_cuts,
                "feature_type": self.feature_types,
            }
        )


def _small_rows(df: DataFrame, path: str) -> list:
    rows = df.limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"{path}: more than {MAX_ENTRIES} entries, this is not metadata")
    return rows


def _once(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    """A dictionary of pairs, none of whose keys may be repeated."""
    found = dict(pairs)
    if len(found) < len(pairs):
        keys = [key for key, _ in pairs]
        raise ValueError(f"given twice: {sorted({key for key in keys if keys.count(key) > 1})}")
    return found


def _merged(parts: list[Any], path: str) -> Any:
    """Several files of one part: lists are joined in order of values, dictionaries by key."""
    if all(isinstance(part, list) for part in parts):
        return sorted(value for part in parts for value in part)
    if all(isinstance(part, dict) for part in parts):
        return _once([pair for part in parts for pair in part.items()])
    raise ValueError(f"{path}: some files hold lists and some dictionaries")


def _load(spark: SparkSession, path: str) -> Any:
    """A JSON document, or Parquet with one column (a list) or two (a dictionary)."""
    if path.endswith(".json"):
        files = _small_rows(spark.read.text(path, wholetext=True), path)
        parts = [json.loads(file.value, object_pairs_hook=_once) for file in files if file.value.strip()]
        if not parts:
            raise ValueError(f"{path}: no metadata found")
        return parts[0] if len(parts) == 1 else _merged(parts, path)
    table = spark.read.parquet(path)
    if len(table.columns) == 1:
        column = F.col(f"`{table.columns[0]}`")
        return [row[0] for row in _small_rows(table.select(column).orderBy(column), path)]
    if len(table.columns) != 2:
        raise ValueError(f"{path}: metadata tables have one or two columns, not {table.columns}")
    return _once([(row[0], row[1]) for row in _small_rows(table, path)])


def load_metadata(
    spark: SparkSession,
    *,
    score_cuts: str | None = None,
    fills: str | None = None,
    feature_cuts: str | None = None,
    feature_types: str | None = None,
) -> Metadata:
    """Read metadata from ``.json`` files or Parquet tables; a part without a path stays empty."""
    return Metadata(
        score_cuts=_load(spark, score_cuts) if score_cuts else [],
        fills=_load(spark, fills) if fills else {},
        feature_cuts=_load(spark, feature_cuts) if feature_cuts else {},
        feature_types=_load(spark, feature_types) if feature_types else {},
    )
