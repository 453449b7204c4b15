"""Keeping decoded columns computed once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def computed_once(
    df: DataFrame, columns: Mapping[str, str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Select ``keep`` (default: all other columns) and SQL expressions, filters staying above.

    Catalyst pushes a filter below a projection by writing the projected expressions into
    the filter. For decoded columns that repeats the JSON parsing for every mention of a
    column (thousands of times for a nested chain). A one-element generator gives the same
    rows, stays in generated code, and filters on its output are not moved below it.
    """
    keep = [c for c in df.columns if c not in columns] if keep is None else keep
    row = ", ".join(f"{expression} AS `{name}`" for name, expression in columns.items())
    return df.selectExpr(*[f"`{c}`" for c in keep], f"inline(array(struct({row})))")
