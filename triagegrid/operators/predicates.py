"""Row predicates with SQL's three-valued logic."""

from __future__ import annotations

import operator
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.scalars import as_col, local_time

COMPARISONS = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "LIKE": lambda c, v: c.like(v),
    "NOT LIKE": lambda c, v: ~c.like(v),
}


def literal(value) -> Column:
    """A typed literal. The text ``NULL`` is a null, a date-time is cut to its date."""
    if isinstance(value, Column):
        return value
    if value is None or value == "NULL":
        return F.lit(None)
    if isinstance(value, datetime):
        return F.lit(value.date())
    return F.lit(value)


def compare(column: Column | str, op: str, value) -> Column:
    op = " ".join(op.upper().split())
    column = as_col(column)
    if op in ("IS", "IS NOT"):
        if value not in (None, "NULL"):
            raise ValueError(f"{op} compares with NULL only")
        return column.isNull() if op == "IS" else column.isNotNull()
    if op not in COMPARISONS:
        raise ValueError(f"unknown comparison: {op}")
    if "LIKE" in op:
        return COMPARISONS[op](column, value)
    return COMPARISONS[op](column, literal(value))


def condition(parts: list, between: bool = False) -> Column:
    """``[column, value]``, ``[column, operator, value]`` or ``[column, low, high]`` with ``between``."""
    if between and len(parts) == 3:
        return as_col(parts[0]).between(literal(parts[1]), literal(parts[2]))
    if len(parts) == 2:
        return compare(parts[0], "=", parts[1])
    if len(parts) == 3:
        return compare(*parts)
    raise ValueError("a condition has two or three parts")


def chain(steps: list[tuple[str, Column]]) -> Column:
    """Join conditions by AND / OR left to right; AND binds tighter."""
    terms = [steps[0][1]]
    for connector, cond in steps[1:]:
        if connector == "AND":
            terms[-1] = terms[-1] & cond
        else:
            terms.append(cond)
    return reduce(operator.or_, terms)


def like_any(column: Column | str, patterns: list[str]) -> Column:
    return reduce(operator.or_, [as_col(column).like(p) for p in patterns])


def like_none(column: Column | str, patterns: list[str]) -> Column:
    return reduce(operator.and_, [~as_col(column).like(p) for p in patterns])


def equals_any(column: Column | str, values: list) -> Column:
    return as_col(column).isin(list(values))


def equals_none(column: Column | str, values: list) -> Column:
    """AND of ``!=``; a null is rejected."""
    return ~as_col(column).isin(list(values))


def time_bound(df: DataFrame, column: str, local: str | date | datetime, zone: str = fixed.LOCAL_ZONE) -> Column:
    """A local time turned into a UTC literal of the column's own type.

    The stored column stays bare in the comparison, so the bound reaches the file scan.
    """
    return F.to_utc_timestamp(F.lit(str(local)).cast("timestamp"), zone).cast(df.schema[column].dataType)


def not_recovered(df: DataFrame, recovered: str, zone: str | None = None) -> Column:
    """Missing, or in the epoch year that stands for missing; the year is that of the stored time unless a zone is given.

    The year is stated as bounds of the column's own type, which reach the file scan.
    """
    first, after = (
        time_bound(df, recovered, f"{year}-01-01 00:00:00", zone or "UTC") for year in (fixed.EPOCH_YEAR, fixed.EPOCH_YEAR + 1)
    )
    return F.col(recovered).isNull() | ((F.col(recovered) >= first) & (F.col(recovered) < after))


def in_local_range(
    df: DataFrame, column: str, start, end, zone: str = fixed.LOCAL_ZONE, half_open: bool = False
) -> Column:
    """Local time between start and end, both ends in (the end out with ``half_open``)."""
    low, high = time_bound(df, column, start, zone), time_bound(df, column, end, zone)
    upper = F.col(column) < high if half_open else F.col(column) <= high
    return (F.col(column) >= low) & upper


def open_in_range(
    df: DataFrame, first: str, recovered: str, start, end, zone: str = fixed.LOCAL_ZONE
) -> Column:
    """The fault overlaps the range, or it is not recovered yet."""
    overlap = (F.col(first) <= time_bound(df, first, end, zone)) & (
        F.col(recovered) >= time_bound(df, recovered, start, zone)
    )
    return overlap | not_recovered(df, recovered)


def since_year(df: DataFrame, column: str, year: int, zone: str = fixed.LOCAL_ZONE) -> Column:
    """Local year not before ``year``, stated as a bound on the stored column."""
    return F.col(column) >= time_bound(df, column, f"{year}-01-01 00:00:00", zone)


def finishes_by(df: DataFrame, column: str, bound: str = fixed.FAR_FUTURE, zone: str = fixed.LOCAL_ZONE) -> Column:
    """Finished at all: a far bound that only nulls fail."""
    return F.col(column) <= time_bound(df, column, bound, zone)


def any_missing(*columns: str) -> Column:
    return reduce(operator.or_, [as_col(c).isNull() for c in columns])


def id_in_text(column: Column | str, ident: str) -> Column:
    """Substring match, so longer ids that contain this one match too."""
    return F.contains(as_col(column), F.lit(ident))


def id_in_list(column: Column | str, ident: str, prefix: str = "(group|user):") -> Column:
    """Exact match of one list item, type prefix aside."""
    return F.array_contains(F.split(F.regexp_replace(as_col(column), prefix, ""), ";"), ident)
