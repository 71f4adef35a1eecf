"""Sources: query results, databases over JDBC, and all-text CSV."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagegrid.functions.scalars import as_col


def rename(df: DataFrame, names: dict[str, str] | None) -> DataFrame:
    """Apply a rename map; names the frame lacks are ignored, an empty frame is renamed like any other."""
    return df.withColumnsRenamed(names) if names else df


def query(
    spark: SparkSession,
    text: str,
    tables: dict[str, DataFrame] | None = None,
    args: dict | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Result of a SQL text. ``{table}`` in the text stands for a DataFrame, ``:name`` for a parameter value."""
    return rename(spark.sql(text, args=args or {}, **(tables or {})), names)


def jdbc_query(
    spark: SparkSession, url: str, text: str, options: dict[str, str] | None = None, names: dict | None = None
) -> DataFrame:
    """Result of a query the database runs itself; fetched by one task, so meant for small results."""
    reader = spark.read.format("jdbc").option("url", url).option("query", text).options(**(options or {}))
    return rename(reader.load(), names)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A database table read in parallel by ranges of one column; filters and columns are pushed to the database."""
    reader = spark.read.format("jdbc").options(**jdbc_ranges(url, table, partition_column, lower, upper, partitions))
    return reader.options(**(options or {})).load()


def jdbc_ranges(url: str, table: str, partition_column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def csv_all_text(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    skip_rows: int = 0,
    names: dict[str, str] | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """CSV, every column text. Lines with too many fields are skipped, short ones filled with nulls.

    The first ``skip_rows`` lines and the header of each file are dropped by their place, whatever they say; they must lie
    in the file's first split. The field names are those of the first file by path. With ``fields`` the files have no
    header. A record is one line.
    """
    lines = spark.read.text(path)
    top = skip_rows + (fields is None)
    if fields is None:
        head = spark.read.text(min(lines.inputFiles())).limit(top).collect()
        if len(head) < top:
            raise ValueError("the file has no header line")
        fields = next(csv.reader([head[-1].value], delimiter=sep))
    body = _below(lines, top).where(F.trim("value") != "")
    bare = F.regexp_replace("value", '"[^"]*"', "")
    count = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + F.lit(1)
    kept = body.where(count <= len(fields))
    ddl = ", ".join(f"`{name}` STRING" for name in fields)
    parsed = kept.select(F.from_csv("value", ddl, {"sep": sep, "mode": "PERMISSIVE", "escape": '"'}).alias("row"))
    return rename(parsed.select(*[F.col(f"row.`{name}`").alias(name) for name in fields]), names)


def _below(lines: DataFrame, top: int) -> DataFrame:
    """Lines of text files without the first ``top`` of each file.

    Only first splits are numbered, so a group of the window is one split at most.
    """
    if not top:
        return lines
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
    )
    begin = F.min("__at").over(Window.partitionBy("__file"))
    first = placed.where(F.col("__block") == 0).withColumn("__begin", begin)
    first = first.where(F.col("__at") - F.col("__begin") >= top)
    return first.select("value").union(placed.where(F.col("__block") > 0).select("value"))


def columns(df: DataFrame, names: list[str] | str | None = None) -> DataFrame:
    """Column-list projection; nothing named means all columns."""
    if not names:
        return df
    return df.select(*[as_col(c) for c in ([names] if isinstance(names, str) else names)])
