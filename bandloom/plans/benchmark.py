"""All requested metrics of all populations as one plan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from ..functions.segments import SEGMENTS, TEXT_SEGMENTS
from ..operators.counting import Counting
from ..operators.features import distinct_rates
from ..operators.result import result_rows, stamp, to_table
from ..operators.rows import filter_population
from ..sources.metadata import Metadata
from .request import CUT_METRICS, SCORE_METRICS, SEGMENT_METRIC, VALIDITY_METRIC, Request
from .request import expand_metrics


def benchmark_long(
    population: DataFrame,
    request: Request,
    metadata: Metadata,
    *,
    platforms: str | Sequence[str] | None = None,
    user_types: str | Sequence[str] | None = None,
    on_missing: str = "raise",
    include_last: bool = False,
) -> DataFrame:
    """The long form of every requested metric.

    Populations are grouping columns, so their number does not matter. All that counts rows is one pass over
    the population (see ``operators.counting``), distinct values are another. A population without rows gives
    no rows.
    """
    wanted = expand_metrics(request, metadata, on_missing)
    if not wanted:
        raise ValueError("no metric is left to compute")
    rows = filter_population(population, platforms, user_types)
    counting = Counting(rows)
    by_score = {metric: wanted[metric] for metric in SCORE_METRICS if metric in wanted}
    if by_score:
        counting.by_score(metadata.score_cuts, by_score, "output_value", "id", include_last)
    by_cut = {metric: wanted[metric] for metric in CUT_METRICS if metric in wanted}
    if by_cut or "NULL_RATE" in wanted:
        counting.by_feature(by_cut, wanted.get("NULL_RATE", []), metadata.feature_cuts, metadata.fills)
    if SEGMENT_METRIC in wanted:
        counting.by_segment(wanted[SEGMENT_METRIC], SEGMENTS, TEXT_SEGMENTS)
    if VALIDITY_METRIC in wanted:
        counting.by_validity("output_value")
    parts = [counting.long()] if counting.outputs else []
    if "DISTINCT_RATE" in wanted:
        parts.append(distinct_rates(rows, wanted["DISTINCT_RATE"]))
    return reduce(DataFrame.unionByName, parts)


def benchmark_table(
    population: DataFrame,
    request: Request,
    metadata: Metadata,
    model_name: str,
    *,
    platforms: str | Sequence[str] | None = None,
    user_types: str | Sequence[str] | None = None,
    on_missing: str = "raise",
    include_last: bool = False,
    **attributes,
) -> DataFrame:
    """The typed result table: one row per population, metric and value (see ``stamp`` for attributes).

    The rows are grouped by their key, so no second row of a key can appear; ``keep_fullest`` is for
    result tables that were put together from several runs.
    """
    long = benchmark_long(
        population,
        request,
        metadata,
        platforms=platforms,
        user_types=user_types,
        on_missing=on_missing,
        include_last=include_last,
    )
    table = stamp(to_table(long), model_name, meta_data=metadata.to_json(), **attributes)
    return result_rows(table)
