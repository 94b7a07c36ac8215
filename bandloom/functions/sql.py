"""Pieces of SQL text.

Expressions that grow with the number of cuts, labels or features are given to Spark as one text each.
Built from ``Column`` objects they would cost a call to the JVM per comparison, which for hundreds of
features takes longer than planning the query.
"""

from __future__ import annotations

import math


def quoted(name: str) -> str:
    """A column name."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    """A double literal."""
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"double('{value!r}')"


def number(name: str) -> str:
    """The column as a double; text that is no number becomes null instead of failing the job."""
    return f"try_cast({quoted(name)} AS DOUBLE)"
