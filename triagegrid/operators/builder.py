"""Fluent query and table-edit chains over DataFrames, and a chained frame wrapper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagegrid.functions.scalars import as_col
from triagegrid.operators import dedupe, edits
from triagegrid.operators.predicates import COMPARISONS, chain, condition
from triagegrid.operators.range_join import LOWER, UPPER, range_join
from triagegrid.sources import readers, sinks

def listed(fields: list[str] | str) -> list[str]:
    """Names or expressions as a list; a text may hold several, between commas outside of brackets and quotes."""
    if not isinstance(fields, str):
        return list(fields)
    parts, depth, quote = [""], 0, ""
    for c in fields:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        depth += 0 if quote else (c == "(") - (c == ")")
        if c == "," and not depth and not quote:
            parts.append("")
        else:
            parts[-1] += c
    return [p.strip() for p in parts]


class TableQuery:
    """``table → select → join → where → groupBy → orderBy → limit → get`` in a fixed clause order.

    The chain only collects clauses; ``get`` returns one lazy DataFrame. ``tables`` maps names to DataFrames, other
    names are read from the session's catalog. Every clause takes names of columns and ``table.column``, which several tables with
    equal column names need.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.tables = dict(tables or {})
        self._clear()

    def _clear(self) -> None:
        self._table = None
        self._select: list[str] | None = None
        self._joins: list[tuple[str, list, str]] = []
        self._tokens: list[tuple[str, bool, list, bool, bool]] = []
        self._groups: list[str] = []
        self._order: tuple[list[str], str] | None = None
        self._limit: tuple[int, int] | None = None
        self._open = self._close = False

    def _frame(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else self.spark.table(name)

    def table(self, name: str) -> TableQuery:
        self._table = name
        return self

    def select(self, fields: list[str] | str) -> TableQuery:
        self._select = listed(fields)
        return self

    def join(self, table: str, on: list, how: str = "INNER", all_pairs: bool = False) -> TableQuery:
        """``[left, right]``, ``[left, operator, right]`` or a list of such conditions. Several joins may follow.

        Without an equality the conditions are ranges, as in ``[[x, ">=", low], [x, "<", high]]``. Conditions of other kinds alone
        pair all rows with all; that has to be asked for with ``all_pairs``, whatever the sizes.
        """
        conditions = [tuple(c) for c in (on if isinstance(on[0], (list, tuple)) else [on])]
        conditions = [(c[0], "=", c[1]) if len(c) == 2 else c for c in conditions]
        if any(len(c) != 3 or c[1] not in COMPARISONS for c in conditions):
            raise ValueError("a join condition is [left, right] or [left, operator, right]")
        if not all_pairs and not any(op in ("=", *LOWER, *UPPER) for _, op, _ in conditions):
            raise ValueError("a join needs an equality or a range condition; all_pairs asks for all rows with all")
        self._joins.append((table, conditions, how))
        return self

    def groupWhere(self, parenthesis: str) -> TableQuery:
        """``open`` before the first condition of a group, ``close`` before its last one."""
        self._open = self._open or parenthesis == "open"
        self._close = self._close or parenthesis == "close"
        return self

    def where(self, parts: list, between: bool = False) -> TableQuery:
        return self._add("AND", parts, between)

    def orWhere(self, parts: list) -> TableQuery:
        return self._add("OR", parts)

    def _add(self, connector: str, parts: list, between: bool = False) -> TableQuery:
        condition(parts, between)  # what is wrong with it shows here, not at the end of the chain
        self._tokens.append((connector, self._open, parts, between, self._close))
        self._open = self._close = False
        return self

    def groupBy(self, fields: list[str] | str) -> TableQuery:
        self._groups = listed(fields)
        return self

    def orderBy(self, fields: list[str] | str, order: str = "ASC") -> TableQuery:
        self._order = (listed(fields), order)
        return self

    def limit(self, limit: int, offset: int = 0) -> TableQuery:
        self._limit = (limit, offset)
        return self

    def _condition(self) -> Column | None:
        if not self._tokens:
            return None
        outer: list[tuple[str, Column]] = []
        group: list[tuple[str, Column]] | None = None
        for connector, opens, parts, between, closes in self._tokens:
            cond = condition([self._column(parts[0]), *parts[1:]], between)
            if opens:
                group = []
                group_connector = connector
            if group is None:
                outer.append((connector, cond))
            else:
                group.append((connector, cond))
                if closes:
                    outer.append((group_connector, chain(group)))
                    group = None
        if group:
            raise ValueError("a condition group was opened and not closed")
        return chain(outer)

    def _column(self, name: Column | str) -> Column:
        """A column by its name, or by table and name."""
        if isinstance(name, str) and "." in name:
            table, column = name.split(".", 1)
            if table in (self._table, *(t for t, _, _ in self._joins)):
                return F.col(f"`{table}`.`{column}`")
        return as_col(name)

    def _joined(self, df: DataFrame, table: str, on: list, how: str) -> DataFrame:
        frame = self._frame(table)
        right = frame.alias(table)

        def own(name: str) -> Column:
            """A name of the joined table."""
            return F.col(f"`{table}`.`{name}`") if name in frame.columns else self._column(name)

        def other(name: str) -> Column:
            """A name of the tables before it."""
            return df[f"`{name}`"] if df.columns.count(name) == 1 else self._column(name)

        pairs = [(other(left), op, own(r)) for left, op, r in on]
        first = next((left for left, op, _ in on if op in (*LOWER, *UPPER)), None)
        if first is None or any(op == "=" for _, op, _ in on):
            return df.join(right, [COMPARISONS[op](left, r) for left, op, r in pairs], how.lower())
        ranges = [p for p, c in zip(pairs, on) if c[0] == first and c[1] in (*LOWER, *UPPER)]
        more = [COMPARISONS[op](left, r) for (left, op, r), c in zip(pairs, on) if c[0] != first or c[1] not in (*LOWER, *UPPER)]
        return range_join(df, right, ranges, how.lower(), more)

    def get(self) -> DataFrame:
        df = self._frame(self._table).alias(self._table)
        for table, on, how in self._joins:
            df = self._joined(df, table, on, how)
        cond = self._condition()
        if cond is not None:
            df = df.where(cond)
        shown = [] if not self._select or self._select == ["*"] else self._select
        if self._groups:
            plain = {g: self._column(g).alias(g.rsplit(".", 1)[-1]) for g in self._groups}
            rest = [F.expr(e) for e in shown if e not in plain]
            df = df.groupBy(*plain.values()).agg(*rest) if rest else df.select(*plain.values()).distinct()
            hidden = [g.rsplit(".", 1)[-1] for g in plain if shown and g not in shown]
            df = self._ordered(df, [as_col(c.rsplit(".", 1)[-1]) for c in self._order[0]] if self._order else [])
            df = df.drop(*hidden)
        else:
            keys = [self._column(c) for c in self._order[0]] if self._order else []
            names = [f"__order_{i}" for i in range(len(keys))]
            df = df.select(*[F.expr(e) for e in shown or ["*"]], *[k.alias(n) for k, n in zip(keys, names)])
            df = self._ordered(df, [as_col(n) for n in names]).drop(*names)
        self._clear()
        return df

    def _ordered(self, df: DataFrame, keys: list[Column]) -> DataFrame:
        """Sorted and limited."""
        order = dedupe.sort_keys(keys, self._order[1]) if self._order else None
        if self._limit:
            return dedupe.first_rows(df, *self._limit, order)
        return df.orderBy(*order, dedupe.tie_break(df)) if order else df

    def _edited(self, df: DataFrame) -> DataFrame:
        self.tables[self._table] = df
        self._clear()
        return df

    def insert(self, values: dict) -> DataFrame:
        return self._edited(edits.insert_record(self._frame(self._table), values))

    def update(self, values: dict) -> DataFrame:
        return self._edited(edits.update_where(self._frame(self._table).alias(self._table), values, self._condition()))

    def delete(self) -> DataFrame:
        return self._edited(edits.delete_where(self._frame(self._table).alias(self._table), self._condition()))


class TicketFrame:
    """A chained wrapper around one DataFrame; every step replaces ``df`` by a new one."""

    def __init__(self, spark: SparkSession, df: DataFrame | None = None):
        self.spark = spark
        self.df = df
        self._names: dict[str, str] = {}

    def setColsToRename(self, names: dict[str, str]) -> TicketFrame:
        self._names = dict(names)
        return self

    def renameCols(self) -> TicketFrame:
        self.df = readers.rename(self.df, self._names)
        return self

    def fromCsv(self, path: str, sep: str = ",", skip_rows: int = 0) -> TicketFrame:
        self.df = readers.csv_all_text(self.spark, path, sep, skip_rows)
        return self.renameCols()

    def fromQuery(self, text: str, tables: dict[str, DataFrame] | None = None, args: dict | None = None) -> TicketFrame:
        self.df = readers.query(self.spark, text, tables, args)
        return self.renameCols()

    def toTable(self, table: str) -> TicketFrame:
        sinks.append_table(self.df, table)
        return self

    def select(self, columns: list[str]) -> DataFrame:
        return self.df.select(*[as_col(c) for c in columns])

    def fillNulls(self, column: str, value) -> TicketFrame:
        self.df = self.df.fillna({column: value})
        return self

    def sortByCategory(self, column: str, order: list[str] | None = None, ascending: bool = True) -> TicketFrame:
        if order:
            self.df = dedupe.sort_by_category(self.df, column, order, ascending)
        else:
            self.df = self.df.orderBy(as_col(column).asc_nulls_last() if ascending else as_col(column).desc_nulls_last())
        return self

    def reindex(self, order: list[str], name: str = "index") -> TicketFrame:
        self.df = dedupe.row_index(self.df, [as_col(c).asc_nulls_last() for c in order], name)
        return self

    def updateCell(self, key: str, key_value, column: str, value) -> TicketFrame:
        self.df = edits.set_cell(self.df, key, key_value, column, value)
        return self

    def dropDuplicates(self, columns: list[str] | None, order: list[str], keep: str = "first") -> TicketFrame:
        self.df = dedupe.keep_one(self.df, columns or [], order, keep)
        return self

    def duplicates(self, columns: list[str] | None, order: list[str], keep: str = "first") -> DataFrame:
        return dedupe.removed_rows(self.df, columns or [], order, keep)

    def concat(self, frames: list[DataFrame]) -> TicketFrame:
        self.df = dedupe.stack([self.df, *frames])
        return self

    def delta(self, other: DataFrame) -> DataFrame:
        return dedupe.delta(self.df, other)

    @staticmethod
    def isNull(column: str) -> Column:
        return as_col(column).isNull()
