"""SQL predicates for row checks, as text, so that a spec is plain data and needs no running session.

Each predicate may evaluate to NULL; the quality operators read NULL as "failed".
"""

from __future__ import annotations


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def not_null(column: str) -> str:
    return f"{quoted(column)} IS NOT NULL"


def positive(column: str) -> str:
    return f"{quoted(column)} > 0"


def present_and_positive(column: str) -> str:
    return f"{not_null(column)} AND {positive(column)}"


def not_nan(column: str) -> str:
    """NaN compares greater than every number, so ``positive`` lets it through; add this check to stop it."""
    return f"NOT isnan({quoted(column)})"


def in_window(column: str, start: str, end: str) -> str:
    """Half-open ``[start, end)``."""
    name = quoted(column)
    return f"{name} >= TIMESTAMP_NTZ '{start}' AND {name} < TIMESTAMP_NTZ '{end}'"


def not_before(later: str, earlier: str) -> str:
    """Equal values are in order."""
    return f"{quoted(later)} >= {quoted(earlier)}"
