"""Table edits. Each returns a new version of the table; the stored one is not touched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions.scalars import as_col
from triagegrid.operators.predicates import literal


def insert_record(df: DataFrame, values: dict) -> DataFrame:
    """Add one record; columns it does not name are null."""
    unknown = set(values) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    cells = [
        (literal(values[f.name]) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in df.schema.fields
    ]
    return df.unionByName(df.sparkSession.range(1).select(*cells))


def update_where(df: DataFrame, values: dict, cond: Column | None = None) -> DataFrame:
    """Set columns where the condition is true; where it is false or unknown the row stays."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name, value in values.items():
        new = literal(value).cast(types[name])
        changed[name] = new if cond is None else F.when(cond, new).otherwise(as_col(name))
    return df.withColumns(changed)


def delete_where(df: DataFrame, cond: Column | None = None) -> DataFrame:
    """Remove the rows where the condition is true; without a condition all rows go."""
    if cond is None:
        return df.where(F.lit(False))
    return df.where(~F.coalesce(cond, F.lit(False)))


def set_cell(df: DataFrame, key: str, key_value, column: str, value) -> DataFrame:
    """Set one cell, the row named by its business key."""
    return update_where(df, {column: value}, as_col(key) == literal(key_value))


def insert_columns(df: DataFrame, places: list[tuple[int, str, Column]]) -> DataFrame:
    """Insert columns at positions, one after the other, as each insertion shifts the next."""
    names = list(df.columns)
    for position, name, _ in places:
        names.insert(position, name)
    return df.withColumns({name: value for _, name, value in places}).select(*[as_col(n) for n in names])
