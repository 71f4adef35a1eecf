"""Sinks: CSV, table append, dated snapshots and multi-dataset reports."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.sources.readers import rename


def write_csv(df: DataFrame, path: str, report_date: str) -> str:
    """CSV with a header and empty texts for nulls, in a folder named after the report date."""
    target = os.path.join(path, f"report_date={report_date}")
    options = {"header": True, "nullValue": "", "emptyValue": "", "escape": '"'}
    df.write.mode("overwrite").options(**options).csv(target)
    return target


def append_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append by column name; a column the table lacks is an error."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        known = spark.table(table).columns
        unknown = [c for c in df.columns if c not in known]
        if unknown:
            raise ValueError(f"{table} has no columns {unknown}")
        present = [F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in known]
        df.select(*present).write.mode("append").format(fmt).saveAsTable(table)
    else:
        df.write.format(fmt).saveAsTable(table)


def append_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).options(**(options or {})).save()


def append_path(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def as_of_rows(df: DataFrame, as_of: str, names: dict[str, str] | None = None) -> DataFrame:
    """Rows stamped with the run date, under their snapshot names."""
    return rename(df.withColumn("AsOf", F.lit(as_of)), names or fixed.SNAPSHOT_NAMES)


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at(path))


def beside(target: str, kind: str = "new") -> str:
    """A fresh path in the target's folder that readers of the folder pass over."""
    folder, name = os.path.split(target)
    return os.path.join(folder, f"_{kind}-{uuid.uuid4().hex}-{name}")


def swap_in(spark: SparkSession, written: str, target: str) -> str:
    """Put a written folder in the target's place, by two renames."""
    files, at = _file_system(spark, target)
    old = beside(target, "old")
    if files.exists(at(target)) and not files.rename(at(target), at(old)):
        raise OSError(f"cannot move {target}")
    if not files.rename(at(written), at(target)):
        files.rename(at(old), at(target))
        raise OSError(f"cannot move {written} to {target}")
    files.delete(at(old), True)
    spark.catalog.refreshByPath(target)
    return target


def write_swapped(df: DataFrame, target: str) -> str:
    """Write a folder beside its target and put it in the target's place when it is whole.

    A write that fails leaves the target as it was, and ``df`` may read the target itself.
    """
    new = beside(target)
    df.write.parquet(new)
    return swap_in(df.sparkSession, new, target)


def write_snapshot(df: DataFrame, path: str, as_of: str, names: dict[str, str] | None = None) -> str:
    """Put the day's rows into the history. The day's own folder is swapped whole, also for no rows, so a rerun gives the same history."""
    rows = as_of_rows(df, as_of, names)
    day = [c for c in rows.columns if c.lower() == "asof"]
    write_swapped(rows.drop(*day), f"{path}/asof={as_of}")
    return path


def write_report(datasets: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Several named datasets, one folder each."""
    return write_counted(datasets, path)[0]


def write_counted(datasets: dict[str, DataFrame], path: str) -> tuple[dict[str, str], dict[str, int]]:
    """``write_report`` with the rows of each dataset, counted while they are written."""
    paths, counts = {}, {}
    for name, df in datasets.items():
        paths[name] = os.path.join(path, name)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(paths[name])
        counts[name] = int(seen.get.get("rows", 0))
    return paths, counts


def counts_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts as rows (dataset, rows)."""
    return spark.createDataFrame(pa.table({"dataset": pa.array(list(counts), pa.string()), "rows": pa.array(list(counts.values()), pa.int64())}))
