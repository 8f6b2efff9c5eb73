"""Row filters given as lists: ANDed predicates, or ORed groups of ANDed predicates.

A predicate is ``(column, op, value)``. ``[p, q]`` keeps rows where both hold and
``[[p, q], [r]]`` rows where either group does. The lists become one Column, so Catalyst
pushes them into the Parquet scan.
"""

from __future__ import annotations

import operator
import warnings
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Predicate = tuple[str, str, Any]
Filters = Sequence[Predicate] | Sequence[Sequence[Predicate]]

MISSING_POLICIES = ("discard", "null", "error")


def _is_in(column: Column, values: Iterable[Any]) -> Column:
    """Membership with a plain yes or no: null is a member only if it is listed."""
    values = list(values)
    known = [v for v in values if v is not None]
    hit = column.isin(known)
    return hit | column.isNull() if len(known) < len(values) else hit


def _not_in(column: Column, values: Iterable[Any]) -> Column:
    return ~F.coalesce(_is_in(column, values), F.lit(False))


_OPERATORS: dict[str, Callable[[Column, Any], Column]] = {
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": _is_in,
    "not in": _not_in,
}


def groups_of(filters: Filters | None) -> list[list[Predicate]]:
    """The filters as ORed groups, whichever of the two forms they came in."""
    if not filters:
        return []
    nested = [filters] if isinstance(filters[0], tuple) else filters
    groups = [list(group) for group in nested]
    if not all(groups):
        raise ValueError("a group of filters has no predicate")
    for predicate in (p for group in groups for p in group):
        if not (isinstance(predicate, tuple) and len(predicate) == 3):
            raise ValueError(f"a predicate is (column, op, value), got {predicate!r}")
        if predicate[1] not in _OPERATORS:
            raise ValueError(f"unknown comparison {predicate[1]!r}; known: {sorted(_OPERATORS)}")
    return groups


def filter_columns(filters: Filters | None) -> set[str]:
    return {p[0] for group in groups_of(filters) for p in group}


def discard_missing(filters: Filters | None, available: Iterable[str]) -> Filters:
    """Take out predicates on columns a table lacks, with a warning for each.

    Rows then pass as if the predicate held. A group left empty goes too; it does not turn
    into "always true". One remaining group is returned unnested.
    """
    available = set(available)
    kept = []
    for group in groups_of(filters):
        for column, op, value in group:
            if column not in available:
                warnings.warn(f"filter {(column, op, value)} discarded: there is no column {column}", stacklevel=2)
        usable = [p for p in group if p[0] in available]
        if usable:
            kept.append(usable)
    return kept[0] if len(kept) == 1 else kept


def restrict_to_filtered(selected: Sequence[str], filters: Filters | None) -> list[str]:
    """The selected columns that some predicate uses, in their own order."""
    used = filter_columns(filters)
    return [c for c in selected if c in used]


def condition(filters: Filters | None, schema: T.StructType | None = None) -> Column | None:
    """The filters as one Column, or None if there is nothing to filter.

    With a ``schema``, columns outside it count as null, and NaN is not greater than
    anything (Spark alone sorts NaN above all numbers).
    """
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else None

    def predicate(column: str, op: str, value: Any) -> Column:
        missing = types is not None and column not in types
        operand = F.lit(None) if missing else F.col(f"`{column}`")
        test = _OPERATORS[op](operand, value)
        if types and op in (">", ">=") and isinstance(types.get(column), (T.FloatType, T.DoubleType)):
            test = test & ~F.isnan(operand)
        return test

    groups = [reduce(operator.and_, [predicate(*p) for p in g]) for g in groups_of(filters)]
    return reduce(operator.or_, groups) if groups else None


def filter_rows(df: DataFrame, filters: Filters | None, missing: str = "discard") -> DataFrame:
    """Keep the rows that pass.

    ``missing`` says what a predicate on an absent column means: ``discard`` drops the
    predicate, ``null`` compares with null as SQL does, ``error`` raises.
    """
    if missing not in MISSING_POLICIES:
        raise ValueError(f"missing must be one of {MISSING_POLICIES}, got {missing!r}")
    absent = sorted(filter_columns(filters) - set(df.columns))
    if absent and missing == "error":
        raise ValueError(f"filters use absent columns {absent}")
    if absent and missing == "discard":
        filters = discard_missing(filters, df.columns)
    test = condition(filters, df.schema)
    return df if test is None else df.where(test)
