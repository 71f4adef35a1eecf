"""Joins and lookups.

No broadcast is forced here: Spark broadcasts a dimension when its size estimate, or the size AQE measures,
is below ``spark.sql.autoBroadcastJoinThreshold``, and sort-merges it otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions.classify import coded_item
from triagegrid.functions.scalars import as_col, first_item, has_separator

HOT_ROWS = 1_000_000


def left_by_key(
    df: DataFrame,
    key: Column | str,
    dim: DataFrame,
    dim_key: str,
    take: dict[str, str],
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Left equi join that adds the ``take`` columns of the right side under new names.

    Give ``spread_by`` when the key can be null or hot. A second join key is then 0 for every row that can match and a
    hash of those columns for rows whose key is null, so that these do not pile up in one partition. It also gives both
    sides their own exchange, which is what AQE needs to split a hot key. On the right it is computed rather than a
    literal 0, since a literal would be folded out of the join keys.

    Without ``spread_by`` the join is on the key alone. That suits the table's own id: several such joins in a row share
    one partitioning, and tables bucketed by the id are not shuffled at all.
    """
    if clash := set(take.values()) & set(df.columns):
        raise ValueError(f"columns already there: {sorted(clash)}")
    right = dim.where(as_col(dim_key).isNotNull()).select(
        as_col(dim_key).alias("__dim_key"), *[as_col(c).alias(out) for c, out in take.items()]
    )
    key = as_col(key)
    if not spread_by:
        return df.join(right, key == F.col("__dim_key"), "left").drop("__dim_key")
    spread = F.xxhash64(*[as_col(c) for c in spread_by]).bitwiseOR(F.lit(1))
    left = df.withColumns({"__key": key, "__spread": F.when(key.isNull(), spread).otherwise(F.lit(0).cast("long"))})
    right = right.withColumn("__dim_spread", F.pmod(F.xxhash64("__dim_key"), F.lit(1)))
    same = (F.col("__key") == F.col("__dim_key")) & (F.col("__spread") == F.col("__dim_spread"))
    return left.join(right, same, "left").drop("__key", "__spread", "__dim_key", "__dim_spread")


def fan_out_left(
    df: DataFrame,
    key: Column | str,
    many: DataFrame,
    many_key: str,
    take: dict[str, str],
    spread_by: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join with one output row per match, for a right side in which one key may hold very many rows.

    AQE cannot split the right side of a left join. So a key with more than ``hot_rows`` matches is split here: its
    matches are dealt over numbered parts and its left rows are repeated once per part; a repeated row that meets no
    match in its part is dropped, as the key has matches in others. Copies of a match travel once, with their number.
    Rows without a key are spread by a hash of ``spread_by``.
    There are at most rows / ``hot_rows`` hot keys. From ``HOT_ROWS`` on their table is small enough to broadcast; below, it may grow
    with the rows and is joined by key, which shuffles the left rows once more.
    """
    names = {c: f"__take_{i}" for i, c in enumerate(take)}
    pairs = (
        many.where(as_col(many_key).isNotNull())
        .select(as_col(many_key).alias("__many"), *[as_col(c).alias(n) for c, n in names.items()])
        .groupBy("__many", *names.values())
        .agg(F.count("*").alias("__copies"))
    )
    sizes = pairs.groupBy(F.col("__many").alias("__hot")).agg(F.sum("__copies").alias("__n"))
    hot = sizes.where(F.col("__n") > hot_rows).select("__hot", F.ceil(F.col("__n") / hot_rows).alias("__parts"))
    zero = F.lit(0).cast("bigint")

    def counted(parts) -> Column:
        return F.explode(F.sequence(zero, parts - 1))

    few = hot_rows >= HOT_ROWS

    def with_parts(rows: DataFrame, on: str, out: str, aside: list[str]) -> DataFrame:
        """Adds the number of parts of a row's key, null for keys that are not hot."""
        if not few:
            return left_by_key(rows, on, hot, "__hot", {"__parts": out}, aside)
        found = F.broadcast(hot.withColumnsRenamed({"__parts": out}))
        return rows.join(found, as_col(on) == F.col("__hot"), "left").drop("__hot")

    left = with_parts(df.withColumn("__on", as_col(key)), "__on", "__parts", spread_by).withColumnRenamed("__on", "__key")
    left = left.withColumn("__part", counted(F.coalesce("__parts", F.lit(1))))
    aside = F.xxhash64(*[as_col(c) for c in spread_by])
    left = left.withColumn("__part", F.when(F.col("__key").isNull(), aside).otherwise(F.col("__part")))
    right = with_parts(pairs, "__many", "__of", list(names.values()))
    right = right.withColumn("__run", counted(F.ceil(F.col("__copies") / hot_rows)))
    size = F.least(F.lit(hot_rows), F.col("__copies") - F.col("__run") * hot_rows)
    dealt = F.pmod(F.xxhash64(*names.values(), "__run"), F.col("__of"))
    right = right.select(
        "__many",
        F.when(F.col("__of").isNull(), zero).otherwise(dealt).alias("__to"),
        size.alias("__size"),
        *names.values(),
    )
    joined = left.join(right, (F.col("__key") == F.col("__many")) & (F.col("__part") == F.col("__to")), "left")
    kept = joined.where(F.col("__parts").isNull() | F.col("__many").isNotNull())
    copied = kept.withColumn("__copy", counted(F.coalesce("__size", F.lit(1))))
    helpers = ["__key", "__parts", "__part", "__many", "__to", "__size", "__copy"]
    return copied.drop(*helpers).withColumnsRenamed({n: take[c] for c, n in names.items()})


def one_per_key(dim: DataFrame, key: str, value: str, strict: bool = False) -> DataFrame:
    """One value per key, the smallest; with ``strict`` also whether there are different ones (``__several``).

    Both forms combine before the shuffle, so copies of one key cost one row per map task.
    """
    low, high = F.min(as_col(value)), F.max(as_col(value))
    several = [(low < high).alias("__several")] if strict else []
    return dim.groupBy(as_col(key).alias("__k")).agg(low.alias("__v"), *several)


def lookup(
    df: DataFrame,
    key: Column | str,
    dim: DataFrame,
    dim_key: str,
    value: str,
    out: str,
    strict: bool = False,
    unique: bool = False,
    own_id: bool = False,
) -> DataFrame:
    """Add ``out``: the dimension's value for the key, null when there is none.

    ``unique`` says that the dimension holds each key once, which saves its aggregation; ``own_id`` that ``df`` holds
    each key once too and never a null. ``strict`` makes two different values an error for the rows that look them up; a
    key that no row looks up may have several.
    """
    spread_by = None if own_id else df.columns[:2]
    if unique:
        source = dim.select(as_col(dim_key).alias("__k"), as_col(value).alias("__v"))
        return left_by_key(df, key, source, "__k", {"__v": out}, spread_by)
    source = one_per_key(dim, dim_key, value, strict)
    if not strict:
        return left_by_key(df, key, source, "__k", {"__v": out}, spread_by)
    found = left_by_key(df, key, source, "__k", {"__v": out, "__several": "__several"}, spread_by)
    error = F.raise_error(F.concat(F.lit(f"more than one {value} for "), as_col(key).cast("string")))
    return found.withColumn(out, F.when(F.col("__several"), error).otherwise(as_col(out))).drop("__several")


@dataclass(frozen=True)
class Ask:
    """One lookup of a row: the column ``out`` gets the dimension's text for ``key``; ``strict`` as in ``lookup``."""

    out: str
    key: Column | str
    dim: DataFrame
    dim_key: str
    value: str
    strict: bool = False


def stacked_lookups(df: DataFrame, row_id: str, asks: list[Ask]) -> DataFrame:
    """Several lookups of the same rows at once; the wide rows themselves are shuffled by their own id only.

    Every foreign key of a row becomes a narrow row (id, dimension, key). The dimensions are stacked, one value per key, and met by
    the narrow rows in one join, whose two sides have exchanges of their own, so that a hot key can be split. What a row has found
    comes back to it in one map by its id, which further joins on that id share. Values are texts; of several the smallest is
    taken. Null keys ask nothing. ``row_id`` is never null; rows that share one are told apart by their keys.
    """
    dims: dict[tuple, int] = {}
    at = [dims.setdefault((id(a.dim), a.dim_key, a.value), len(dims)) for a in asks]
    made = {}
    for a, number in zip(asks, at):
        one = a.dim.where(as_col(a.dim_key).isNotNull()).select(
            F.lit(number).alias("__dim"), as_col(a.dim_key).cast("string").alias("__dim_key"), as_col(a.value).cast("string").alias("__v")
        )
        made[number] = one
    stacked = reduce(DataFrame.unionAll, made.values()).groupBy("__dim", "__dim_key")
    stacked = stacked.agg(F.min("__v").alias("value"), (F.min("__v") < F.max("__v")).alias("several"))
    stacked = stacked.withColumn("__dim_spread", F.pmod(F.xxhash64("__dim_key"), F.lit(1)))

    keys = [as_col(a.key).cast("string") for a in asks]
    wanted = F.array(*[F.struct(F.lit(number).alias("of"), k.alias("key")) for number, k in zip(at, keys)])
    narrow = df.select(as_col(row_id).alias("__id"), F.explode(F.filter(wanted, lambda w: w["key"].isNotNull())).alias("__ask"))
    narrow = narrow.select("__id", "__ask.*").withColumn("__spread", F.pmod(F.xxhash64("key"), F.lit(1)))
    same = (F.col("of") == F.col("__dim")) & (F.col("key") == F.col("__dim_key")) & (F.col("__spread") == F.col("__dim_spread"))
    found = narrow.join(stacked, same).select(
        "__id", F.struct(F.concat(F.col("of").cast("string"), F.lit(":"), "key").alias("ask"), F.struct("value", "several").alias("held")).alias("entry")
    )
    found = found.groupBy("__id").agg(F.map_from_entries(F.collect_set("entry")).alias("__held"))

    joined = df.join(found, as_col(row_id) == F.col("__id"), "left")
    outs = {}
    for a, number, k in zip(asks, at, keys):
        held = F.try_element_at("__held", F.concat(F.lit(f"{number}:"), k))
        error = F.raise_error(F.concat(F.lit(f"more than one {a.value} for "), k))
        outs[a.out] = F.when(held["several"], error).otherwise(held["value"]) if a.strict else held["value"]
    return joined.withColumns(outs).drop("__id", "__held")


def parent_fallback(
    wo: DataFrame, tt: DataFrame, parent_key: str, parent_order: str, out: str, spread_by: list[str]
) -> DataFrame:
    """Parent order id of a child: its own field, else the order id of the ticket it points to."""
    joined = left_by_key(wo, parent_key, tt, "ticketid", {"orderid": "__found"}, spread_by)
    return joined.withColumn(out, F.coalesce(as_col(parent_order), F.col("__found"))).drop("__found")


def branch_lookup(
    df: DataFrame, branches: list[tuple[Column, Column, bool]], dim: DataFrame, dim_key: str, value: str, out: str
) -> DataFrame:
    """CASE whose branches either resolve a key through the dimension or keep the raw text.

    ``branches`` holds (condition, key, resolve); the first true condition decides. A key that fails to resolve
    gives null.
    """
    key = branch = None
    for number, (cond, col, resolve) in enumerate(branches):
        picked = col if resolve else F.lit(None).cast("string")
        key = F.when(cond, picked) if key is None else key.when(cond, picked)
        branch = F.when(cond, F.lit(number)) if branch is None else branch.when(cond, F.lit(number))
    marked = df.withColumn("__branch", branch)
    found = lookup(marked, key, dim, dim_key, value, "__resolved")
    result = F.lit(None).cast("string")
    for number, (_, col, resolve) in reversed(list(enumerate(branches))):
        chosen = F.col("__resolved") if resolve else col
        result = F.when(F.col("__branch") == number, chosen).otherwise(result)
    return found.withColumn(out, result).drop("__branch", "__resolved")


def either_key_lookup(
    df: DataFrame, keys: tuple[str, str], dim: DataFrame, dim_key: str, value: str, out: str, strict: bool = True
) -> DataFrame:
    """The one value found by either of two keys: two equi joins instead of an OR join.

    Two different values are an error when ``strict``; otherwise the smaller is taken.
    """
    first = lookup(df, keys[0], dim, dim_key, value, "__one", strict)
    both = lookup(first, keys[1], dim, dim_key, value, "__two", strict)
    return both.withColumn(out, either_value("__one", "__two", value, strict)).drop("__one", "__two")


def either_value(one: str, two: str, value: str, strict: bool = True) -> Column:
    """The one text in either of two columns."""
    a, b = F.col(one), F.col(two)
    differ = F.raise_error(F.concat(F.lit(f"two values of {value} for one row: "), a, F.lit(" / "), b))
    return F.coalesce(F.when(a != b, differ if strict else F.least(a, b)), a, b).cast("string")


def group_directory(users: DataFrame, name="fullname", group="user_default_group", ident="user_id") -> DataFrame:
    """Text to group: a full name gives that user's group (lowest id first), a group name gives itself."""
    people = users.where(as_col(group).isNotNull())
    by_name = people.select(
        as_col(name).alias("text"), as_col(group).alias("group"), F.lit(0).alias("kind"), as_col(ident).alias("ident")
    )
    by_group = people.select(
        as_col(group).alias("text"), as_col(group).alias("group"), F.lit(1).alias("kind"), F.lit(0).alias("ident")
    )
    return (
        by_name.unionByName(by_group)
        .where(F.col("text").isNotNull())
        .groupBy("text")
        .agg(F.min(F.struct("kind", "ident", "group")).alias("best"))
        .select("text", F.col("best.group").alias("group"))
    )


def default_group(df: DataFrame, text: Column | str, directory: DataFrame, out: str) -> DataFrame:
    """Group of a user name or of a known group text, else ``NA``."""
    found = lookup(df, text, directory, "text", "group", "__group", unique=True)
    return found.withColumn(out, F.coalesce(F.col("__group"), F.lit("NA"))).drop("__group")


def processor_group(
    df: DataFrame, processor: str, directory: DataFrame, out: str, codes: list[str] | None = None
) -> DataFrame:
    """Group of the current processor; of a list, the item with the best-ranked code, else the first item's group.

    With an empty code list only the first item counts.
    """
    grouped = default_group(df, first_processor(processor), directory, "__default")
    return grouped.withColumn(out, picked_group(processor, "__default", codes)).drop("__default")


def first_processor(processor: str) -> Column:
    """The text that a processor's default group is looked up by."""
    return F.when(has_separator(processor), first_item(processor)).otherwise(as_col(processor))


def picked_group(processor: str, default: Column | str, codes: list[str] | None = None) -> Column:
    """Of a list the item with the best-ranked code, else the default group; with an empty code list the default group."""
    if codes == []:
        return as_col(default)
    item = coded_item(processor, codes) if codes else coded_item(processor)
    return F.coalesce(F.when(has_separator(processor), item), as_col(default))


def first_match(
    df: DataFrame, key: str, hits: DataFrame, hit_key: str, value: str, out: str, default: str = ""
) -> DataFrame:
    """The earliest hit per key, or a default text."""
    earliest = hits.groupBy(as_col(hit_key).alias("__k")).agg(F.min(as_col(value)).alias("__v"))
    found = left_by_key(df, key, earliest, "__k", {"__v": out}, df.columns[:2])
    return found.withColumn(out, F.coalesce(as_col(out), F.lit(default)))


def keys_only(
    df: DataFrame, key: Column | str, allowed: DataFrame, allowed_key: str, unique: bool = False
) -> DataFrame:
    """Rows whose key occurs in another result; an empty result leaves nothing.

    Copies of a key in the other result are combined before the shuffle, unless it is ``unique``. The second join key
    is always 0; it gives both sides their own exchange, so that AQE can split a hot key of ``df``.
    """
    listed = allowed.select(as_col(allowed_key).alias("__allowed"))
    key = as_col(key)
    if unique:
        return df.join(listed, key == F.col("__allowed"), "left_semi")
    listed = listed.distinct().withColumn("__zero", F.pmod(F.xxhash64("__allowed"), F.lit(1)))
    same = (key == F.col("__allowed")) & (F.pmod(F.xxhash64(key), F.lit(1)) == F.col("__zero"))
    return df.join(listed, same, "left_semi")


def merge_left(df: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Attach an aggregate to the detail it came from."""
    return left_by_key(df, key, right, key, {c: c for c in right.columns if c != key}, df.columns)
