"""Labels that cut a population into business segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from .sql import double, number, quoted, text

Limit = tuple[str, float]
Rule = tuple[str, Sequence[Limit]]

# Labels and limits, compared with stored results of earlier runs.
# The first rule that holds gives the label; a value that no rule covers is "NA".
SEGMENTS: dict[str, list[Rule]] = {
    "bureau_score": [
        ("<720", [("<", 720)]),
        ("[720,750)", [(">=", 720), ("<", 750)]),
        ("750+", [(">=", 750)]),
    ],
    "tenure": [
        ("<6", [("<", 6)]),
        ("6-8", [(">=", 6), ("<=", 8)]),
        (">8", [(">", 8)]),
    ],
    "bureau_vintage": [
        ("<12", [("<", 12)]),
        ("12-60", [(">=", 12), ("<=", 60)]),
        (">60", [(">", 60)]),
    ],
    "no_of_cc_loan_entries": [
        ("No CC", [("=", 0)]),
        ("1CC", [("=", 1)]),
        ("1+CC", [(">", 1)]),
    ],
    "active_cc_count": [
        ("<1", [("<", 1)]),
        ("1 or 1+", [(">=", 1)]),
    ],
    "active_pl_count": [
        ("<1", [("<", 1)]),
        ("1-5", [(">=", 1), ("<=", 5)]),
        (">5", [(">", 5)]),
    ],
    "unsecured_enquiries_in_last_1_mon": [
        ("<1", [("<", 1)]),
        ("1-10", [(">=", 1), ("<=", 10)]),
        ("10+", [(">", 10)]),
    ],
    "months_since_last_90_dpd": [
        ("<1", [("<", 1)]),
        ("1-12", [(">=", 1), ("<=", 12)]),
        ("12+", [(">", 12)]),
    ],
}
# Segments whose label is the text itself, with the texts that mean "not given".
TEXT_SEGMENTS: dict[str, list[str]] = {"employment_type": [" ", "none"]}
NOT_AVAILABLE = "NA"

def segment_value(name: str, text_segments: Mapping[str, Sequence[str]] = TEXT_SEGMENTS) -> str:
    """SQL for the value a segment is cut by: text, or a number (null where the text is none)."""
    if name.lower() in text_segments:
        return f"CAST({quoted(name)} AS STRING)"
    return number(name)


def label_of(
    name: str,
    value: str,
    segments: Mapping[str, Sequence[Rule]] = SEGMENTS,
    text_segments: Mapping[str, Sequence[str]] = TEXT_SEGMENTS,
) -> str:
    """SQL for the label of ``value``, a ``segment_value``, by the rules of the segment of that name."""
    key, missing = name.lower(), text(NOT_AVAILABLE)
    if key in text_segments:
        not_given = ", ".join(text(given) for given in text_segments[key])
        return f"CASE WHEN {value} IS NULL OR {value} IN ({not_given}) THEN {missing} ELSE {value} END"
    if key not in segments:
        raise ValueError(f"no segment rule for {name!r}; known: {segment_names()}")
    rules = [
        f"WHEN {' AND '.join(f'{value} {sign} {double(limit)}' for sign, limit in limits)} THEN {text(label)}"
        for label, limits in segments[key]
    ]
    return f"CASE {' '.join(rules)} ELSE {missing} END"


def segment_label(
    name: str,
    segments: Mapping[str, Sequence[Rule]] = SEGMENTS,
    text_segments: Mapping[str, Sequence[str]] = TEXT_SEGMENTS,
) -> Column:
    """The segment label of a column that holds ``segment_value``, chosen by the column's name."""
    return F.expr(label_of(name, quoted(name), segments, text_segments))


def segment_names() -> list[str]:
    """Every segment that has a rule."""
    return sorted([*TEXT_SEGMENTS, *SEGMENTS])
