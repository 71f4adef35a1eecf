"""Aggregates, pivots with totals and summary tables.

A lattice aggregates a detail once by all keys that its reports use; every pivot and summary also takes a lattice in place of the
detail and adds up its cells. A summary is one aggregation with a conditional aggregate per measure; a pivot aggregates by row keys and column value and
spreads that small result over its columns. The detail is combined before its only shuffle, and totals are added up from
the aggregated rows, never from the detail a second time.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions.scalars import as_col
from triagegrid.operators.order_index import OrderIndex
from triagegrid.session import stored

TOTAL = "All"


@dataclass(frozen=True)
class Measure:
    """A count or mean of ``value`` over the rows that satisfy ``when``. Over a lattice the value is named by a text."""

    name: str
    how: str
    value: Column | str
    when: Column | None = None


@dataclass(frozen=True)
class Lattice:
    """Mergeable pieces of a detail per combination of its keys: rows, and for each value the rows that have it and their sum.

    There are at most as many cells as the keys have combinations, however long the detail.
    """

    frame: DataFrame
    keys: list[str]
    counted: list[str]
    summed: list[str]

    def where(self, condition: Column) -> Lattice:
        """The cells that satisfy a condition on the keys."""
        return Lattice(self.frame.where(condition), self.keys, self.counted, self.summed)


def lattice(df: DataFrame, keys: list[str], counted: list[str], summed: list[str] | None = None) -> Lattice:
    """One aggregation of ``df`` by ``keys``, nulls included; ``counted`` and ``summed`` are the values of later measures."""
    summed = summed or []
    both = list(dict.fromkeys([*counted, *summed]))
    counts = [F.count(as_col(v)).alias(f"__count:{v}") for v in both]
    sums = [F.sum(as_col(v).cast("double")).alias(f"__sum:{v}") for v in summed]
    cells = df.groupBy(*[as_col(k) for k in keys]).agg(F.count("*").alias("__rows"), *counts, *sums)
    return Lattice(cells, keys, both, summed)


def _frame(source: DataFrame | Lattice) -> DataFrame:
    return source.frame if isinstance(source, Lattice) else source


def group_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per key; null keys and keys without any value are left out."""
    means = df.where(as_col(key).isNotNull()).groupBy(as_col(key)).agg(F.avg(as_col(value)).alias(value))
    return means.where(as_col(value).isNotNull())


def axis_values(df: DataFrame | Lattice, column: str, exclude: list | None = None, most: int = 10_000) -> list:
    """Distinct non-empty values in order, for use as pivot columns; more than ``most`` is an error."""
    c = as_col(column)
    values = _frame(df).select(c.alias("v")).where(c.isNotNull() & (c.cast("string") != "")).distinct()
    if exclude:
        values = values.where(~F.col("v").isin(list(exclude)))
    found = [row.v for row in values.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; paged_pivot takes an axis of any length")
    return sorted(found)


def distinct_axis(df: DataFrame | Lattice, column: str, exclude: list | None = None) -> DataFrame:
    """The same values as rows."""
    c = as_col(column)
    rows = _frame(df).select(c.alias(column)).where(c.isNotNull() & (c.cast("string") != ""))
    if exclude:
        rows = rows.where(~c.isin(list(exclude)))
    return rows.distinct().orderBy(c)


def _parts(measures: list[Measure], source: DataFrame | Lattice | None = None) -> dict[str, Column]:
    """The mergeable pieces of the measures: rows seen, values counted, and the sum behind a mean."""
    if isinstance(source, Lattice):
        return _merged_parts(measures, source)
    parts = {}
    for i, m in enumerate(measures):
        value = as_col(m.value) if m.when is None else F.when(m.when, as_col(m.value))
        parts[f"__seen_{i}"] = F.count("*") if m.when is None else F.count(F.when(m.when, 1))
        parts[f"__count_{i}"] = F.count(value)
        if m.how == "mean":
            parts[f"__sum_{i}"] = F.sum(value.cast("double"))
    return parts


def _merged_parts(measures: list[Measure], source: Lattice) -> dict[str, Column]:
    """The same pieces, added up from the cells of a lattice."""

    def added(cell: str, when: Column | None) -> Column:
        c = as_col(cell)
        return F.sum(c if when is None else F.when(when, c))

    parts = {}
    for i, m in enumerate(measures):
        if m.value not in (source.summed if m.how == "mean" else source.counted):
            raise ValueError(f"the lattice has no {m.how} of {m.value}")
        parts[f"__seen_{i}"] = F.coalesce(added("__rows", m.when), F.lit(0))
        parts[f"__count_{i}"] = F.coalesce(added(f"__count:{m.value}", m.when), F.lit(0))
        if m.how == "mean":
            parts[f"__sum_{i}"] = added(f"__sum:{m.value}", m.when)
    return parts


def _cells(measures: list[Measure]) -> dict[str, Column]:
    """The measures from their pieces; blank where no row satisfied the condition."""
    cells = {}
    for i, m in enumerate(measures):
        count = F.col(f"__count_{i}")
        if m.how == "mean":
            cells[m.name] = F.when(count > 0, F.col(f"__sum_{i}") / count)
        else:
            cells[m.name] = F.when(F.col(f"__seen_{i}") > 0, count)
    return cells


def _with_keys(df: DataFrame | Lattice, columns: list[str]) -> DataFrame | Lattice:
    return df.where(reduce(operator.and_, [as_col(c).isNotNull() for c in columns]))


def with_total(
    df: DataFrame | Lattice, rows: list[str], measures: list[Measure], require: list[str] | None = None, total: str = TOTAL
) -> DataFrame:
    """Measures per row key plus one grand-total row.

    Rows with a null key, or a null in a ``require`` column, take no part. A measure is blank where no row satisfies
    its condition. Means are kept as sum and count until the end, so a total is the mean over rows. The total is a
    second grouping set over the aggregated rows, not over the detail.
    """
    keyed = _with_keys(df, [*rows, *(require or [])])
    keys = [as_col(c).cast("string").alias(f"__row_{i}") for i, c in enumerate(rows)]
    base = _frame(keyed).groupBy(*keys).agg(*[p.alias(n) for n, p in _parts(measures, keyed).items()])
    return _totalled(base, rows, measures, total)


def _totalled(base: DataFrame, rows: list[str], measures: list[Measure], total: str) -> DataFrame:
    """Cells and the grand total of pieces that are aggregated per row key, or per row key and more."""
    parts = list(_parts(measures))
    keys = [F.col(f"__row_{i}") for i in range(len(rows))]
    both = base.groupingSets([keys, []], *keys).agg(
        F.grouping_id().alias("__level"), *[F.sum(n).alias(n) for n in parts]
    )
    labels = [
        F.when(F.col("__level") == 0, k).otherwise(F.lit(total if i == 0 else "")).alias(rows[i])
        for i, k in enumerate(keys)
    ]
    # The grand-total set gives a row even for no input at all; a report of nothing has no total.
    seen = both.where(F.col(f"__seen_{len(measures) - 1}").isNotNull())
    return seen.select(*labels, *[c.alias(n) for n, c in _cells(measures).items()])


def with_inner_rows(
    df: DataFrame | Lattice, outer: str, inner: str, labels: list[str], measures: list[Measure], exclude: list | None = None
) -> DataFrame:
    """Measures per ``outer`` value found in the data and per listed ``inner`` label, blank rows included.

    One aggregation of the detail gives both the row labels and the cells; the inner labels are laid out from the
    aggregated rows. No join with an axis is needed.
    """
    keyed = _with_keys(df, [outer])
    if exclude:
        keyed = keyed.where(~as_col(outer).isin(list(exclude)))
    parts = _parts(measures, keyed)
    base = _frame(keyed).groupBy(as_col(outer).alias("__outer"), as_col(inner).alias("__inner")).agg(
        *[p.alias(n) for n, p in parts.items()]
    )
    cells = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(_cells(measures).values())])
    picked = [F.max(F.when(F.col("__inner") == v, cells)).alias(f"__row_{i}") for i, v in enumerate(labels)]
    wide = base.groupBy("__outer").agg(*picked)
    laid = F.posexplode(F.array(*[F.col(f"__row_{i}") for i in range(len(labels))])).alias("__pos", "__cells")
    long = wide.select("__outer", laid)
    label = F.get(F.array(*[F.lit(v) for v in labels]), F.col("__pos"))
    return long.orderBy("__outer", "__pos").select(
        F.col("__outer").alias(outer),
        label.alias(inner),
        *[F.col(f"__cells.c{i}").alias(m.name) for i, m in enumerate(measures)],
    )


def pivot_with_total(
    df: DataFrame | Lattice,
    rows: list[str],
    column: str,
    value: str,
    how: str,
    columns: list | None = None,
    total: str = TOTAL,
) -> DataFrame:
    """Row keys by the values of ``column``, counts or means, with a total row and a total column.

    Totals cover every value of ``column``, also those not listed in ``columns``. Blank cells are null. Rows of a mean
    pivot without any value are left out. The narrow cells (row keys, value of ``column``) are totalled over the rows first; only
    the result is laid out wide.
    """
    labels = axis_values(df, column) if columns is None else columns
    keyed = _with_keys(df, [*rows, column])
    keys = [as_col(r).cast("string").alias(f"__row_{i}") for i, r in enumerate(rows)]
    parts = {n.removesuffix("_0"): p for n, p in _parts([Measure(total, how, value)], keyed).items()}
    cells = _frame(keyed).groupBy(*keys, as_col(column).alias("__column")).agg(*[p.alias(n) for n, p in parts.items()])
    names = [F.col(f"__row_{i}") for i in range(len(rows))]
    own, whole = [*names, F.col("__column")], [F.col("__column")]
    totalled = cells.groupingSets([own, whole], *own).agg(
        F.grouping(names[0]).alias("__level"), *[F.sum(n).alias(n) for n in parts]
    )

    def shown(when: Column | None) -> Column:
        seen, count, amount = (F.sum(F.col(n) if when is None else F.when(when, F.col(n))) for n in ("__seen", "__count", "__sum" if how == "mean" else "__seen"))
        return F.when(count > 0, amount / count) if how == "mean" else F.when(seen > 0, count)

    marked = totalled.withColumns({f"__row_{i}": F.when(F.col("__level") == 0, n).otherwise(F.lit(total if i == 0 else "")) for i, n in enumerate(names)})
    made = {str(v): shown(F.col("__column") == v) for v in labels}
    table = marked.groupBy("__level", *names).agg(*[c.alias(n) for n, c in made.items()], shown(None).alias(total))
    table = table.select(*[n.alias(r) for n, r in zip(names, rows)], *[as_col(n) for n in [*made, total]])
    return table.where(as_col(total).isNotNull()) if how == "mean" else table


def mean_with_total(df: DataFrame, row: str, value: str, total: str = TOTAL) -> DataFrame:
    """Mean per row key plus the mean over all rows."""
    table = with_total(df, [row], [Measure(value, "mean", as_col(value))], total=total)
    return table.where(as_col(value).isNotNull())


def grouped(df: DataFrame, keys: list[str] | str, *aggregates: str) -> DataFrame:
    """GROUP BY with aggregate select expressions given as SQL text."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*[as_col(k) for k in names]).agg(*[F.expr(a) for a in aggregates])


def row_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows per named dataset, counted in parallel in one job."""
    counts = [d.agg(F.count("*").alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n, d in datasets.items()]
    return reduce(DataFrame.unionByName, counts)


@dataclass(frozen=True)
class PagedPivot:
    """A pivot over an axis of any length: cells stay narrow, and only one page of columns at a time is laid out wide.

    ``cells`` has the row keys, the number of the page, and a map from each axis value of the page that the row has to its cell. ``totals``
    has the row keys and the total column. The driver holds the values of one page at most.
    """

    axis: OrderIndex
    cells: DataFrame
    totals: DataFrame
    rows: list[str]
    page_columns: int

    @property
    def pages(self) -> int:
        return -(-len(self.axis) // self.page_columns)

    def labels(self, page: int) -> list[str]:
        """The axis values of a page, in order; pages are numbered from 0."""
        return [r.value for r in self.axis.slice(self.page_columns, page * self.page_columns).collect()]

    def page(self, page: int, total: str = TOTAL) -> DataFrame:
        """Every row of the pivot, the total row included, with the columns of a page and the total column over all pages."""
        own = self.cells.where(F.col("__page") == page).select(*[as_col(r).alias(f"__{r}") for r in self.rows], "__cells")
        same = [as_col(r) == as_col(f"__{r}") for r in self.rows]
        shown = [F.try_element_at("__cells", F.lit(v)).alias(v) for v in self.labels(page)]
        return self.totals.join(own, same, "left").select(*[as_col(r) for r in self.rows], *shown, F.col("__total").alias(total))


def paged_pivot(
    df: DataFrame | Lattice, rows: list[str], column: str, value: str, how: str, page_columns: int = 1000, total: str = TOTAL
) -> PagedPivot:
    """``pivot_with_total`` for an axis that is found in the data, without a limit to its length.

    The axis is sorted and numbered by ranges; its values are texts. The plan has the size of one page, however long the axis.
    """
    keyed = _with_keys(df, [*rows, column])
    keys = [as_col(r).cast("string").alias(r) for r in rows]
    parts = {n.removesuffix("_0"): p for n, p in _parts([Measure(total, how, value)], keyed).items()}
    narrow = _frame(keyed).groupBy(*keys, as_col(column).cast("string").alias("__column")).agg(*[p.alias(n) for n, p in parts.items()])
    narrow = stored(narrow.where(F.col("__column") != ""), "pivot-cells")
    axis = OrderIndex(narrow.select(F.col("__column").alias("value")).distinct(), ["value"])
    names = [as_col(r) for r in rows]
    every = [F.lit(total if i == 0 else "").alias(r) for i, r in enumerate(rows)]
    added = [F.sum(n).alias(n) for n in parts]
    whole = narrow.groupBy("__column").agg(*added).select(*every, "__column", *parts)
    cells = narrow.union(whole.select(*narrow.columns))
    cell = F.when(F.col("__count") > 0, F.col("__sum") / F.col("__count")) if how == "mean" else F.col("__count")
    place = axis.numbered("__place").select(F.floor(F.col("__place") / page_columns).cast("int").alias("__page"), F.col("value").alias("__value"))
    paged = cells.join(place, F.col("__column") == F.col("__value")).where(cell.isNotNull())
    paged = paged.groupBy(*names, "__page").agg(F.map_from_entries(F.collect_list(F.struct("__value", cell.alias("cell")))).alias("__cells"))
    totals = cells.groupBy(*names).agg(*added).select(*names, cell.alias("__total")).where(F.col("__total").isNotNull())
    return PagedPivot(axis, stored(paged, "pivot-pages"), stored(totals, "pivot-totals"), rows, page_columns)
