"""Joins on inequalities and ranges without pairing all rows.

The left side's values are cut into buckets of like size by bounds from a sample, and a value that fills buckets by itself gets one of
its own. A left row has one bucket; a right row goes to those buckets whose smallest and largest values leave room for its conditions.
Rows then meet by an equality of buckets, and the conditions are tested exactly. Of the buckets of a range only the first and the last
hold rows beside it, so with buckets of a fixed size the tests that fail grow with the right rows, not with the product of both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagegrid.session import stored

#: Left rows of a bucket, and sampled rows for each bound; they only change how evenly the buckets are filled.
ROWS, SAMPLED = 4096, 8
LOWER, UPPER, TURN = (">", ">="), ("<", "<="), str.maketrans("<>", "><")
TESTS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def place_of(held: list, kind: T.DataType, value: Column, passed: Callable[[Column, Column], Column]) -> Column:
    """How many of the ascending values are passed, which are the first ones, by halving."""
    if not held:
        return F.lit(0)
    known = F.array(*[F.lit(x) for x in held]).cast(T.ArrayType(kind))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(held).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(passed(F.get(known, at + step - 1), value), at + step).otherwise(at))


class Buckets:
    """Smallest and largest value of each bucket of a column, in order. The driver holds these two for each bucket.

    The column is written once, apart from its rows, and has to be the same whenever it is read.
    """

    def __init__(self, df: DataFrame, value: Column, at_least: int, rows: int | None):
        """``at_least`` buckets or one for each ``rows`` rows, where there are so many values."""
        values = stored(df.select(value.alias("v")).where(F.col("v").isNotNull()), "range-values")
        self.kind, size = values.schema["v"].dataType, values.count()
        wanted = max(at_least, -(-size // rows) if rows else 0)
        sample = values.sample(min(1.0, SAMPLED * wanted / size), 17) if size else values
        found = [r.v for r in sample.orderBy("v").collect()]
        cuts = [found[len(found) * i // wanted] for i in range(1, wanted)] if found else []
        bounds = [x for i, x in enumerate(cuts) if not i or x != cuts[i - 1]]
        # A value that is cut at twice has a bucket for itself.
        alone = [x for i, x in enumerate(cuts) if i and x == cuts[i - 1] and (i < 2 or x != cuts[i - 2])]
        number = place_of(bounds, self.kind, F.col("v"), TESTS["<="]) + place_of(alone, self.kind, F.col("v"), TESTS["<"])
        edges = values.groupBy(number.alias("number")).agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("number").collect()
        self.lows, self.highs = [r.low for r in edges], [r.high for r in edges]

    def of(self, value: Column) -> Column:
        return F.when(value.isNotNull(), place_of(self.highs, self.kind, value, TESTS["<"]))

    def first(self, op: str, bound: Column) -> Column:
        """The first bucket whose largest value stands in the relation to the bound."""
        return place_of(self.highs, self.kind, bound, lambda high, b: ~TESTS[op](high, b))

    def last(self, op: str, bound: Column) -> Column:
        """The last bucket whose smallest value stands in the relation to the bound."""
        return place_of(self.lows, self.kind, bound, TESTS[op]) - 1

    def __len__(self) -> int:
        return len(self.highs)


def bucketed(left: DataFrame, right: DataFrame, ranges: list[tuple[Column, str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Left rows with their ``__bucket``, and right rows once for each bucket that has room for them, ``__of``."""
    # The conditions on the first left value cut the buckets; those on other ones are tested only.
    value = ranges[0][0]
    own = [(op, r) for v, op, r in ranges if str(v) == str(value)]
    two_sided = any(op in LOWER for op, _ in own) and any(op in UPPER for op, _ in own)
    # One-sided conditions go to about half of all buckets, so more of these would only repeat the right rows.
    buckets = Buckets(left, value, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), ROWS if two_sided else None)
    begins = [F.lit(0), F.lit(0), *[buckets.first(op, r) for op, r in own if op in LOWER]]
    end = F.lit(len(buckets) - 1)
    ends = [end, end, *[buckets.last(op, r) for op, r in own if op in UPPER]]
    reached = right
    # A right row without one of its values is in no bucket.
    for _, _, r in ranges:
        reached = reached.where(r.isNotNull())
    reached = reached.withColumns({"__begin": F.greatest(*begins), "__end": F.least(*ends)}).where(F.col("__begin") <= F.col("__end"))
    reached = reached.withColumn("__of", F.explode(F.sequence("__begin", "__end"))).drop("__begin", "__end")
    return left.withColumn("__bucket", buckets.of(value)), reached


def range_join(
    left: DataFrame, right: DataFrame, ranges: list[tuple[Column, str, Column]], how: str = "inner", more: list[Column] | None = None
) -> DataFrame:
    """Join on ``left value, operator, right value`` conditions and ``more`` conditions on both sides.

    ``how`` is inner, left, left_semi, left_anti, right or full. Nulls match nothing. A hot left value is one bucket, which the
    adaptive skew join can split. A one-sided condition lets a right row meet about half of all left rows by its nature.
    """
    turned = [(r, op.translate(TURN), v) for v, op, r in ranges]
    if how in ("right", "right_outer"):
        out = range_join(right, left, turned, "left", more)
        return out.select(*[left[c] for c in left.columns], *[right[c] for c in right.columns])
    if how in ("full", "outer", "full_outer"):
        both = range_join(left, right, ranges, "left", more)
        alone = range_join(right, left, turned, "left_anti", more)
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
        return both.union(alone.select(*nulls, "*"))
    placed, reached = bucketed(left, right, ranges)
    exact = [TESTS[op](v, r) for v, op, r in ranges]
    return placed.join(reached, [F.col("__bucket") == F.col("__of"), *exact, *(more or [])], how).drop("__bucket", "__of")
