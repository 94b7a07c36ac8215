"""What a caller asks for: metric names and value names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from ..functions.segments import segment_names
from ..operators.rows import POPULATION, as_list
from ..operators.counting import SCORE_VALUES
from ..sources.metadata import Metadata

# Metric names, and the word that stands for every feature with a fill value.
SCORE_METRICS = ["PSI", "DRIFT_IN_MB"]
CUT_METRICS = ["CSI", "FEATURE_RANGE_DRIFT"]
FILL_METRICS = ["NULL_RATE", "DISTINCT_RATE"]
SEGMENT_METRIC = "SEGMENT_DISTRIBUTION"
VALIDITY_METRIC = "INVALID_SCORE"
METRICS = [*SCORE_METRICS, *CUT_METRICS, *FILL_METRICS, SEGMENT_METRIC, VALIDITY_METRIC]
ALL_FEATURES = "all_features"

Request = Mapping[str, str | Sequence[str] | None]


def normalise_metrics(
    metric_name: str | None = None,
    value_name: str | Sequence[str] | None = None,
    metric_dict: Request | None = None,
) -> dict[str, list[str]]:
    """One metric with its values, or a dictionary of them; the dictionary wins."""
    if metric_dict is None:
        if metric_name is None:
            raise ValueError("give a metric name or a metric dictionary")
        metric_dict = {metric_name: value_name}
    return {name: as_list(values) or [] for name, values in metric_dict.items()}


def expand_metrics(
    request: Request, metadata: Metadata, on_missing: str = "raise"
) -> dict[str, list[str]]:
    """Check the request against the metadata and spell out ``all_features``.

    Metric names are given in any case, feature names become lower case, repeated values count once.
    A name without a rule is an error, or left out with ``on_missing="skip"``; ``all_features`` stands
    for the features that have a rule.
    """
    if on_missing not in ("raise", "skip"):
        raise ValueError("on_missing is 'raise' or 'skip'")
    expanded: dict[str, list[str]] = {}
    for given, values in request.items():
        metric = given.upper()
        if metric not in METRICS:
            raise ValueError(f"unknown metric {given!r}; known: {METRICS}")
        known = _known(metric, metadata)
        wanted = as_list(values) or []
        if wanted == [ALL_FEATURES]:
            wanted = [name for name in metadata.fills if name in known]
        if metric == VALIDITY_METRIC:
            wanted = ["total_population"]
        elif metric != SEGMENT_METRIC:
            wanted = [value.lower() for value in wanted]
        missing = [value for value in wanted if value.lower() not in known]
        if missing and on_missing == "raise":
            raise ValueError(f"{metric}: no rule for {missing}")
        wanted = [value for value in wanted if value.lower() in known]
        if not wanted and on_missing == "raise":
            raise ValueError(f"{metric}: no values asked for")
        if wanted:
            expanded[metric] = list(dict.fromkeys([*expanded.get(metric, []), *wanted]))
    return expanded


def required_columns(request: Request, metadata: Metadata, on_missing: str = "raise") -> list[str]:
    """The columns of a population that the requested metrics read."""
    wanted = expand_metrics(request, metadata, on_missing)
    columns = [*POPULATION]
    for metric, values in wanted.items():
        if metric in (*SCORE_METRICS, VALIDITY_METRIC):
            columns.append("output_value")
            if set(values) - {"score", "total_population"}:
                columns.append("status")
        else:
            columns += values
    return list(dict.fromkeys(columns))


def _known(metric: str, metadata: Metadata) -> set[str]:
    if metric in SCORE_METRICS:
        return set(SCORE_VALUES)
    if metric in CUT_METRICS:
        return set(metadata.feature_cuts)
    if metric in FILL_METRICS:
        return set(metadata.fills)
    return set(segment_names()) if metric == SEGMENT_METRIC else {"total_population"}
