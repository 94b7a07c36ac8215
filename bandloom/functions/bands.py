"""Cutting a number into bands.

Score bands are closed on the left, feature bands on the right. The functions for single columns take the
name of a numeric column and write one nested ``CASE`` that halves the edges at each step, so a value costs
log2(edges) comparisons and stays in generated code. Metrics take the edges as data instead, see
``operators.counting``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from .sql import double, quoted, text

# Labels of the validity bands, in report order.
INVALID_SCORE_LABELS = ["<0", "=0", "0-1", ">=1", "NULL"]


def _edge(value: float) -> float:
    edge = float(value)
    if math.isnan(edge):
        raise ValueError("an edge cannot be NaN")
    return edge


def _locate(value: str, edges: Sequence[float], leaves: Sequence[str], closed: str) -> str:
    """The leaf of the interval that holds ``value``; there is one leaf more than there are edges.

    NaN compares as larger than every number and so reaches the last leaf.
    """
    if not edges:
        return leaves[0]
    middle = len(edges) // 2
    sign = "<" if closed == "left" else "<="
    below = _locate(value, edges[:middle], leaves[: middle + 1], closed)
    above = _locate(value, edges[middle + 1 :], leaves[middle + 1 :], closed)
    return f"CASE WHEN {value} {sign} {double(edges[middle])} THEN {below} ELSE {above} END"


def _band(name: str, edges: Sequence[float], leaves: Sequence[str], closed: str) -> Column:
    value = quoted(name)
    band = _locate(value, edges, leaves, closed)
    return F.expr(f"CAST(CASE WHEN {value} IS NOT NULL THEN {band} END AS INT)")


def score_cuts(cuts: Iterable[float]) -> list[float]:
    """Check the cuts of a score: at least two, ascending."""
    edges = [_edge(cut) for cut in cuts]
    if len(edges) < 2:
        raise ValueError("a score needs at least two cuts")
    if edges != sorted(edges):
        raise ValueError("score cuts must be ascending")
    return edges


def score_band(name: str, cuts: Iterable[float], include_last: bool = False) -> Column:
    """Band i (from 1) holds ``[cut i-1, cut i)``; everything outside, NaN and null have no band.

    A score equal to the last cut is outside unless ``include_last`` puts it in the last band.
    """
    edges = score_cuts(cuts)
    count = len(edges) - 1
    last = f"CASE WHEN {quoted(name)} = {double(edges[-1])} THEN {count} END"
    bands = [str(band) for band in range(1, count + 1)]
    return _band(name, edges, ["NULL", *bands, last if include_last else "NULL"], "left")


def feature_edges(edges: Iterable[float | None] | None) -> list[float]:
    """The distinct edges in order. Fewer than two entries mean "not cut" and give an empty list."""
    given = list(edges or [])
    if len(given) < 2:
        return []
    distinct = sorted({_edge(edge) for edge in given if edge is not None})
    if not distinct:
        raise ValueError("all feature edges are null")
    return distinct


def inner_edges(edges: Iterable[float | None] | None) -> list[float]:
    """The edges between the bands of a feature: all distinct ones but the outermost, if there are three."""
    distinct = feature_edges(edges)
    return distinct[1:-1] if len(distinct) > 2 else distinct[-1:]


def feature_band_count(edges: Iterable[float | None] | None) -> int:
    """How many bands ``feature_band`` can give for these edges."""
    return len(inner_edges(edges)) + 1


def feature_band(name: str, edges: Iterable[float | None] | None) -> Column:
    """Band 1 is ``(-inf, e1]``, band k ``(ek-1, ek]`` and the last is open above.

    The outermost edges are dropped when there are three or more; two distinct edges split at the
    larger one, one edge splits there, and a feature without edges is one single band.
    """
    inner = inner_edges(edges)
    return _band(name, inner, [str(band) for band in range(1, len(inner) + 2)], "right")


def validity_of(score: str) -> str:
    """SQL for which kind of validity a number has; every row gets exactly one label (NaN counts as >=1)."""
    below, zero, valid, above, missing = (text(label) for label in INVALID_SCORE_LABELS)
    return (
        f"CASE WHEN {score} IS NULL THEN {missing} WHEN {score} < 0 THEN {below} "
        f"WHEN {score} = 0 THEN {zero} WHEN {score} >= 1 THEN {above} ELSE {valid} END"
    )


def invalid_score_label(name: str) -> Column:
    """The validity label of a numeric column."""
    return F.expr(validity_of(quoted(name)))
