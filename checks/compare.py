"""Compare a registered query with its SQL on DuckDB: columns, types, row counts and values."""

from __future__ import annotations

from dataclasses import dataclass

import duckdb
from pyspark.sql import SparkSession

from triagegrid.analog import GIVEN

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@dataclass
class Outcome:
    rows: int
    problem: str = ""


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in GIVEN:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value) -> str:
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    return repr(value)


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, folder: str, query, sql: str) -> Outcome:
    df = query(spark, folder)
    rows = df.collect()
    rel = db.sql(sql)
    names, cols = rel.columns, sorted(df.columns)
    if cols != sorted(names):
        return Outcome(len(rows), f"columns {cols} / {sorted(names)}")
    kinds = {c: str(k) for c, k in zip(names, rel.types)}
    odd = [(c, k, kinds[c]) for c, k in df.dtypes if KINDS.get(k, k) != kinds[c]]
    at = [names.index(c) for c in cols]
    ours = sorted(tuple(plain(r[c]) for c in cols) for r in rows)
    theirs = sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    if len(ours) != len(theirs):
        return Outcome(len(rows), f"rows {len(ours)} / {len(theirs)}")
    wrong = [(x, y) for x, y in zip(ours, theirs) if x != y]
    if wrong:
        cells = [(c, p, q) for c, p, q in zip(cols, *wrong[0]) if p != q]
        return Outcome(len(rows), f"{len(wrong)} rows differ, the first in {cells[:6]}")
    return Outcome(len(rows), f"types {odd}" if odd else "")
