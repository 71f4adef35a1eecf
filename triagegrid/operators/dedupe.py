"""Keep-one rows, duplicate rows, worst row per key, sorts, row numbers, unions and deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions.classify import severity_rank
from triagegrid.functions.scalars import as_col
from triagegrid.operators.order_index import OrderIndex, tie_break

#: Rows that one task may merge for a limit.
TASK_ROWS = 10_000


def nulls_last(c: Column | str) -> list[Column]:
    """Order parts of one column with nulls after all values, for use in a struct."""
    c = as_col(c)
    return [c.isNull(), c]


def keep_one(df: DataFrame, keys: list[str], order: list[Column | str], keep: str = "first") -> DataFrame:
    """One row per key, first or last in ``order``; null is a key like any other. No keys: distinct rows.

    This is an aggregation with a partial step, so a hot key is thinned out before the shuffle.
    """
    if not keys:
        return df.distinct()
    rank = F.struct(*[part.alias(f"o{i}") for i, part in enumerate(p for o in order for p in nulls_last(o))])
    whole = F.struct(*[as_col(c) for c in df.columns])
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    best = df.groupBy(*[as_col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(pick(whole, rank).alias("__row"))
    return best.select("__row.*")


def removed_rows(df: DataFrame, keys: list[str], order: list[Column | str], keep: str = "first") -> DataFrame:
    """Rows that ``keep_one`` removes, without exact copies of anything: each occurs once and is not kept."""
    once = df.groupBy(*[as_col(c) for c in df.columns]).agg(F.count("*").alias("__n"))
    if not keys:
        return once.where(F.col("__n") > 1).select(*[as_col(c) for c in df.columns])
    kept = keep_one(df, keys, order, keep)
    kept = kept.select(*[as_col(c).alias(f"__kept_{i}") for i, c in enumerate(kept.columns)])
    same = [as_col(c).eqNullSafe(F.col(f"__kept_{i}")) for i, c in enumerate(df.columns)]
    return once.where(F.col("__n") == 1).drop("__n").join(kept, same, "left_anti")


def worst_per_key(
    df: DataFrame, key: str, severity: str, mean_of: str, tie: str, order: list[str] | None = None
) -> DataFrame:
    """The row with the worst severity per key, its ``mean_of`` replaced by the mean over the key's rows.

    Worst row and mean come from the same aggregation. Rows without a key are left out, unlisted severities rank last.
    """
    rank = severity_rank(severity, order) if order else severity_rank(severity)
    sort = F.struct(*[p.alias(f"o{i}") for i, p in enumerate([*nulls_last(rank), *nulls_last(tie)])])
    rest = F.struct(*[as_col(c) for c in df.columns if c not in (key, mean_of)])
    best = (
        df.where(as_col(key).isNotNull())
        .groupBy(as_col(key))
        .agg(F.min_by(rest, sort).alias("__row"), F.avg(as_col(mean_of)).alias(mean_of))
    )
    return best.select(
        *[as_col(c) if c in (key, mean_of) else F.col(f"__row.`{c}`").alias(c) for c in df.columns]
    )


def row_index(df: DataFrame, order: list[Column], name: str = "index") -> DataFrame:
    """Dense 0-based row number in the given order; the rows are sorted by ranges and written once."""
    return OrderIndex(df, order).numbered(name)


def sort_keys(columns: list[str] | str, order: str = "ASC") -> list[Column]:
    """Sort keys, one direction for all, nulls after the values when ascending and before when descending."""
    names = [columns] if isinstance(columns, str) else list(columns)
    order = order.upper()
    if order not in ("ASC", "DESC"):
        raise ValueError(f"order is ASC or DESC, not {order}")
    return [as_col(c).asc_nulls_last() if order == "ASC" else as_col(c).desc_nulls_first() for c in names]


def sort_rows(df: DataFrame, columns: list[str] | str, order: str = "ASC") -> DataFrame:
    """Rows sorted by ``sort_keys``."""
    return df.orderBy(*sort_keys(columns, order), tie_break(df))


def sort_by_category(df: DataFrame, column: str, order: list[str], ascending: bool = True) -> DataFrame:
    """Sort by a custom category order; values outside it become null and come last either way."""
    rank = severity_rank(column, order)
    known = df.withColumn(column, F.when(as_col(column).isin(order), as_col(column)))
    return known.orderBy(rank.asc_nulls_last() if ascending else rank.desc_nulls_last(), tie_break(known))


def first_rows(df: DataFrame, limit: int, offset: int = 0, order: list[Column] | None = None) -> DataFrame:
    """``limit`` rows after the first ``offset`` of the given order, sorted by it; without an order, of the frame as it is.

    Up to TASK_ROWS rows every task sends its best ones and one task merges them. Beyond that no task could hold them, so the
    rows come from an order index, which gives the same ones.
    """
    if offset + limit > TASK_ROWS:
        return OrderIndex(df, order or []).slice(limit, offset)
    ordered = df.orderBy(*order, tie_break(df)) if order else df
    return ordered.offset(offset).limit(limit) if offset else ordered.limit(limit)


def stack(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column one frame lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def delta(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur exactly once in the two frames together."""
    both = left.unionByName(right)
    counted = both.groupBy(*[as_col(c) for c in left.columns]).agg(F.count("*").alias("__n"))
    return counted.where(F.col("__n") == 1).drop("__n")
