"""A dated history that stores changes only.

Each day's folder holds the rows that it has more or fewer copies of than the day before. A day's table is the sum of all changes up to it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagegrid.functions.scalars import as_col
from triagegrid.sources.sinks import beside, exists, swap_in

DAY, COPIES = "asof", "__copies"


def _changes(spark: SparkSession, path: str) -> DataFrame | None:
    if not exists(spark, path):
        return None
    spark.catalog.refreshByPath(path)
    found = spark.read.parquet(path).schema
    # A day is a text, also where it looks like a number.
    kinds = [T.StructField(f.name, T.StringType()) if f.name == DAY else f for f in found.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(path)


def _summed(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Copies of each row, without rows that have none; nulls are equal."""
    total = changes.groupBy(*[as_col(c) for c in columns]).agg(F.sum(COPIES).alias(COPIES))
    return total.where(F.col(COPIES) != 0)


def _difference(more: DataFrame, less: DataFrame | None, columns: list[str]) -> DataFrame:
    """Copies of each row in one frame beyond those in another, in one aggregation; both may hold a row several times."""
    return _summed(more if less is None else more.unionByName(less.withColumn(COPIES, -F.col(COPIES))), columns)


def days(spark: SparkSession, path: str) -> list[str]:
    """The days that were written, in order."""
    changes = _changes(spark, path)
    return [] if changes is None else sorted(r[0] for r in changes.select(DAY).distinct().collect())


def write_day(df: DataFrame, path: str, day: str) -> str:
    """Put a day's rows into the history; a row may occur several times.

    A day that is written again replaces what it was. The day after it, if there is one, is stored anew as changes against
    the new rows, so that the tables of all other days stay as they are. Days are texts whose order is that of time. Columns are those of
    the first day and have no maps.
    """
    spark, columns = df.sparkSession, df.columns
    if clash := {DAY, COPIES} & {c.lower() for c in columns}:
        raise ValueError(f"columns of the history itself: {sorted(clash)}")
    kept = [*[as_col(c) for c in columns], COPIES]
    now = df.withColumn(COPIES, F.lit(1).cast("long"))
    changes, known = _changes(spark, path), days(spark, path)
    earlier, later = [d for d in known if d < day], [d for d in known if d > day]
    before = changes.where(F.col(DAY) < day).select(*kept) if earlier else None
    swaps = [(os.path.join(path, f"{DAY}={day}"), _difference(now, before, columns))]
    if later:
        next_rows = changes.where(F.col(DAY) <= later[0]).select(*kept)
        swaps.append((os.path.join(path, f"{DAY}={later[0]}"), _difference(next_rows, now, columns)))
    # Both are written before either is put in its place, as both are made from what is there.
    written = [(target, beside(target), rows) for target, rows in swaps]
    for _, new, rows in written:
        # A task takes one partition of the shuffle, so that its memory does not grow with the day; small partitions are united by AQE.
        rows.write.parquet(new)
    for target, new, _ in written:
        swap_in(spark, new, target)
    return path


def as_of(spark: SparkSession, path: str, day: str) -> DataFrame:
    """The table as it was on a day: that of the last day written up to it."""
    changes = _changes(spark, path)
    if changes is None:
        raise FileNotFoundError(path)
    columns = [c for c in changes.columns if c not in (DAY, COPIES)]
    held = _summed(changes.where(F.col(DAY) <= day), columns)
    copies = F.explode(F.array_repeat(F.lit(0), F.col(COPIES).cast("int"))).alias(COPIES)
    return held.select(*[as_col(c) for c in columns], copies).drop(COPIES)
