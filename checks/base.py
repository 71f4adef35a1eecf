"""Registry of queries and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagegrid.analog import SOURCES, Tables, table_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-06-30 12:00:34"
START, END = "1999-03-01 00:00:00", "1999-09-01 00:00:00"
EVENT_START, EVENT_END = "2024-01-05 00:00:00", "2024-01-20 00:00:00"
FIRST_YEAR = 1998


def check(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name, with its SQL where SQL can express it."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register


def with_tables(sql: str) -> str:
    """Put the canonical tables a query names in front of it."""
    used = [n for n in SOURCES if re.search(rf"\b{n}\b", sql)]
    ctes = ", ".join(f"{n} AS ({table_sql(n)})" for n in used)
    if not used:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def local(c: str) -> str:
    """Local time as text."""
    return f"strftime({c} + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')"


def stripped(c: str, text: str) -> str:
    return f"nullif(replace({c}, '{text}', ''), '')"


def one_of(dim: str, key: str, value: str) -> str:
    """A dimension with one value per key, as a subquery."""
    return f"(SELECT {key} AS k, min({value}) AS v FROM {dim} GROUP BY {key})"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def sql_pivot(base: str, rows: list[str], labels: list[str], how: str, names: list[str], total="All") -> str:
    """Pivot with totals over ``base(r1[, r2], c, v)`` by grouping sets."""
    keys = ", ".join(rows)
    agg = "count(v)" if how == "count" else "avg(v)"
    shown = [f"CASE WHEN grouping({r}) = 1 THEN '{total if i == 0 else ''}' ELSE {r} END AS {r}_l" for i, r in enumerate(rows)]
    nulls = " AND ".join(f"{c} IS NOT NULL" for c in [*rows, "c"])
    cells = ", ".join(
        (f"round(max(n) FILTER (WHERE c_l = '{label}'), 6)" if how == "mean" else f"max(n) FILTER (WHERE c_l = '{label}')")
        + f' AS "{label}"'
        for label in [*labels, total]
    )
    heads = ", ".join(f'{r}_l AS "{n}"' for r, n in zip(rows, names))
    group = ", ".join(f"{r}_l" for r in rows)
    keep = ' HAVING max(n) IS NOT NULL' if how == "mean" else ""
    return (
        f"WITH base AS ({base}), g AS (SELECT {', '.join(shown)}, CASE WHEN grouping(c) = 1 THEN '{total}' ELSE c END AS c_l, "
        f"{agg} AS n FROM base WHERE {nulls} GROUP BY GROUPING SETS (({keys}, c), ({keys}), (c), ())) "
        f"SELECT {heads}, {cells} FROM g GROUP BY {group}{keep}"
    )
