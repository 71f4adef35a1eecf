"""Rows in order, written once: row numbers, limits and offsets read only the files that they need.

The rows are range-sorted and each range is written to a folder of its own with the place of every row in it. The sizes of the
ranges, added up, turn places into dense numbers, and a slice of the order is a few whole folders and two cut ones.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagegrid.functions.scalars import as_col
from triagegrid.session import new_path

PART, PLACE = "__part", "__place"


def tie_break(df: DataFrame) -> Column:
    """A last sort key that lets rows with one hot sort value spread over several ranges. Columns that share a name take no part."""
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*[as_col(n) for n in names if names.count(n) == 1], F.lit(0))


class OrderIndex:
    """The rows of a frame in an order. Ties are broken by a hash of the row, and equal rows by where they were written.

    The driver holds one number per range. The number of ranges is ``spark.sql.shuffle.partitions`` unless given.
    """

    def __init__(self, df: DataFrame, order: list[Column | str], ranges: int | None = None):
        if clash := {PART, PLACE} & set(df.columns):
            raise ValueError(f"columns already there: {sorted(clash)}")
        spark = df.sparkSession
        self.columns = df.columns
        keys = [*[as_col(c) for c in order], tie_break(df)]
        # Copies of one row have one hash; the number of the partition that they come from lets them, too, spread over ranges. It stays
        # the same when a lost task is run again, which a drawn number needn't.
        known = df.withColumn(PLACE, F.spark_partition_id())
        spread = known.repartitionByRange(ranges or int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, PLACE)
        placed = spread.sortWithinPartitions(*keys, PLACE).withColumns(
            {PART: F.spark_partition_id(), PLACE: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
        )
        path = new_path(spark, "order-index")
        placed.write.partitionBy(PART).parquet(path)
        kept = T.StructType([f for f in placed.schema.fields if f.name != PART] + [T.StructField(PART, T.IntegerType())])
        self.rows = spark.read.schema(kept).parquet(path)
        sizes = {r[0]: r[1] for r in self.rows.groupBy(PART).count().collect()}
        self.parts = sorted(sizes)
        #: First number of each range, and at the end the number of rows.
        self.starts = [0, *accumulate(sizes[p] for p in self.parts)]

    def __len__(self) -> int:
        return self.starts[-1]

    def _number(self) -> Column:
        if not self.parts:
            return F.lit(0).cast("long")
        starts = F.create_map(*[F.lit(x) for pair in zip(self.parts, self.starts) for x in pair])
        return F.element_at(starts, F.col(PART)).cast("long") + F.col(PLACE)

    def numbered(self, name: str, first: int = 0) -> DataFrame:
        """All rows with their dense number, the first column; in no particular order."""
        return self.rows.select((self._number() + first).alias(name), *[as_col(c) for c in self.columns])

    def slice(self, limit: int | None = None, offset: int = 0) -> DataFrame:
        """``limit`` rows after the first ``offset``, in order. Only the ranges that hold some of them are read."""
        if offset < 0 or (limit is not None and limit < 0):
            raise ValueError("limit and offset are not negative")
        end = len(self) if limit is None else min(offset + limit, len(self))
        if offset >= end:
            return self.rows.where(F.lit(False)).select(*[as_col(c) for c in self.columns])
        first, last = bisect_right(self.starts, offset) - 1, bisect_left(self.starts, end) - 1
        held = self.rows.where(F.col(PART).between(self.parts[first], self.parts[last]))
        edge = [
            (F.col(PART) > self.parts[first]) | (F.col(PLACE) >= offset - self.starts[first]),
            (F.col(PART) < self.parts[last]) | (F.col(PLACE) < end - self.starts[last]),
        ]
        cut = held.where(edge[0] & edge[1]).orderBy(PART, PLACE)
        return cut.select(*[as_col(c) for c in self.columns])
