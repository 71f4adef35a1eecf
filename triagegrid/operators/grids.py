"""Dense report grids: a fixed row list by a fixed column list, blanks where nothing was counted."""

from __future__ import annotations

from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagegrid.functions.scalars import as_col
from triagegrid.operators.pivots import TOTAL


def axis_frame(spark: SparkSession, names: list[str], labels: list[tuple]) -> DataFrame:
    """The row labels as a local relation with known size, numbered in report order."""
    columns = [pa.array([label[i] for label in labels], pa.string()) for i in range(len(names))]
    position = pa.array(list(range(len(labels))), pa.int64())
    return spark.createDataFrame(pa.table([*columns, position], names=[*names, "__pos"]))


def dense_grid(
    table: DataFrame,
    keys: list[str],
    axes: list[list[str]],
    columns: list[str],
    total_column: str | None = None,
    total_row: str | None = "TOTAL",
) -> DataFrame:
    """Every combination of the row labels once, with the listed columns of a pivot.

    ``table`` is a pivot with its ``All`` row and column. Labels that were not counted give blanks, and so do columns
    the pivot lacks. Row labels outside the axes are hidden; the total row still includes them.
    """
    labels = list(product(*axes))
    if total_row:
        labels.append((TOTAL,) + ("",) * (len(keys) - 1))
    axis = axis_frame(table.sparkSession, keys, labels)
    return _filled(axis, table, keys, columns, total_column, total_row, ["__pos"])


def dense_grid_over(
    axis: DataFrame,
    table: DataFrame,
    keys: list[str],
    columns: list[str],
    inner: list[str] | None = None,
    total_column: str | None = None,
    total_row: str | None = "TOTAL",
) -> DataFrame:
    """The same grid with row labels that come from data: the values of ``axis``, each with every ``inner`` label."""
    rows = axis.select(as_col(keys[0]))
    if inner:
        ranked = F.posexplode(F.array(*[F.lit(label) for label in inner])).alias("__pos", keys[1])
        rows = rows.select(as_col(keys[0]), ranked)
    else:
        rows = rows.withColumn("__pos", F.lit(0))
    rows = rows.withColumn("__last", F.lit(0))
    if total_row:
        blank = [F.lit("").alias(k) for k in keys[1:]]
        last = table.sparkSession.range(1).select(
            F.lit(TOTAL).alias(keys[0]), *blank, F.lit(0).alias("__pos"), F.lit(1).alias("__last")
        )
        rows = rows.unionByName(last)
    return _filled(rows, table, keys, columns, total_column, total_row, ["__last", keys[0], "__pos"])


def _filled(axis, table, keys, columns, total_column, total_row, order) -> DataFrame:
    wanted = [*columns, TOTAL] if total_column else columns
    held = {c: F.col(f"__cell_{i}") for i, c in enumerate(wanted) if c in table.columns}
    cells = table.select(
        *[as_col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        *[as_col(c).alias(f"__cell_{i}") for i, c in enumerate(wanted) if c in table.columns],
    )
    joined = axis.join(cells, [as_col(k) == F.col(f"__key_{i}") for i, k in enumerate(keys)], "left")
    blank = F.lit(None).cast("long")
    shown = {c: held.get(c, blank) for c in columns}
    if total_column:
        shown[total_column] = held.get(TOTAL, blank)
    first = as_col(keys[0])
    label = F.when(first == TOTAL, F.lit(total_row)).otherwise(first) if total_row else first
    heads = [label.alias(keys[0]), *[as_col(k) for k in keys[1:]]]
    return joined.orderBy(*[as_col(o) for o in order]).select(*heads, *[v.alias(n) for n, v in shown.items()])
