"""List aggregation of child records and resolution of id lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions.scalars import as_col, list_items
from triagegrid.operators.lookups import keys_only, left_by_key, one_per_key
from triagegrid.operators.order_index import OrderIndex

#: Items of one list cell. A text of that many ids has some ten megabytes.
BLOCK_ITEMS = 1_000_000


def child_lists(
    children: DataFrame,
    key: str,
    lists: dict[str, tuple[Column | str, Column | str]],
    sep: str = ",",
    block_items: int = BLOCK_ITEMS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Joined child values per parent key in child order: ``lists`` maps an output name to (value, order).

    Each list is cut into blocks of ``block_items`` items, numbered from 0 in child order: block ``piece`` holds the items from
    ``piece * block_items`` on. That is one rule for all parents. A parent has a row per block, the first one also when none of its
    children has a value; a list that is shorter than another one of the parent is null in the later blocks.

    An item's block follows from its place among its parent's items. Places come from an order index, which sorts all items by
    ranges, so that no task holds one parent. It is built when some parent has more children than a block holds; otherwise every
    block is 0. ``counted`` is a frame with the key and at least the same rows that is cheaper to count than ``children``.
    """
    size = (children if counted is None else counted).where(as_col(key).isNotNull()).groupBy(as_col(key)).count()
    longest = size.agg(F.max("count")).first()[0] or 0
    values = {f"__value_{i}": as_col(v).cast("string") for i, (v, _) in enumerate(lists.values())}
    orders = {f"__order_{i}": as_col(o) for i, (_, o) in enumerate(lists.values())}
    items = children.where(as_col(key).isNotNull()).select(
        as_col(key).alias("__parent"), *[c.alias(n) for n, c in {**values, **orders}.items()]
    )
    if longest <= block_items:
        slots = items.select("__parent", F.lit(0).cast("bigint").alias("__block"), *[
            F.when(F.col(f"__value_{i}").isNotNull(), F.struct(F.col(f"__order_{i}").alias("at"), F.col(f"__value_{i}").alias("value"))).alias(f"__slot_{i}")
            for i in range(len(lists))
        ])
        slots = slots.groupBy("__parent")
        blocks = slots.agg(F.min("__block").alias("__block"), *_joined_slots(lists, sep))
    else:
        # One struct as the group key: rows that arrive partitioned by the parent alone are then still spread by block.
        slots = _placed_items(items, len(lists), block_items)
        slots = slots.groupBy(F.struct("__parent", "__block").alias("__cell"))
        blocks = slots.agg(*_joined_slots(lists, sep)).select("__cell.*", *lists)
    return blocks.select(F.col("__parent").alias(key), F.col("__block").alias("piece"), *lists)


def _joined_slots(lists: dict, sep: str) -> list[Column]:
    """The slots of a block as one text per list, in order; null without a slot."""

    def joined(i: int) -> Column:
        held = F.transform(F.sort_array(F.collect_list(f"__slot_{i}")), lambda p: p["value"])
        return F.when(F.size(held) > 0, F.array_join(held, sep))

    return [joined(i).alias(out) for i, out in enumerate(lists)]


def _placed_items(items: DataFrame, count: int, block_items: int) -> DataFrame:
    """A row per item of a list (__parent, __block, the list's slot), and a row without an item for block 0 of each parent."""
    fields = [f for i in range(count) for f in (f"__order_{i}", f"__value_{i}")]
    none = {f.name: F.lit(None).cast(f.dataType) for f in items.schema.fields}
    apart = F.array(*[
        F.struct(F.lit(i).alias("list"), *[(F.col(f) if f.endswith(f"_{i}") else none[f]).alias(f) for f in fields]) for i in range(count)
    ])
    single = items.select("__parent", F.explode(apart).alias("one")).select("__parent", "one.*")
    held = single.where(F.coalesce(*[f"__value_{i}" for i in range(count)]).isNotNull())
    index = OrderIndex(held, ["__parent", "list", *[F.col(f).asc_nulls_first() for f in fields]])
    numbered = index.numbered("__at")
    starts = numbered.groupBy(F.col("__parent").alias("__of"), F.col("list").alias("__list")).agg(F.min("__at").alias("__start"))
    placed = numbered.join(starts, (F.col("__parent") == F.col("__of")) & (F.col("list") == F.col("__list")))
    place = F.col("__at") - F.col("__start")
    slots = {
        f"__slot_{i}": F.when(F.col("list") == i, F.struct(place.alias("at"), F.col(f"__value_{i}").alias("value"))) for i in range(count)
    }
    rows = placed.select("__parent", F.floor(place / block_items).cast("bigint").alias("__block"), *[c.alias(n) for n, c in slots.items()])
    first = items.select("__parent").distinct().withColumn("__block", F.lit(0).cast("bigint"))
    return rows.unionByName(first, allowMissingColumns=True)


def child_lists_of(
    parents: DataFrame, parent_key: str, children: DataFrame, key: str, lists: dict, **options
) -> DataFrame:
    """``child_lists`` for the given parents only, each listed once: other children are dropped before the grouping."""
    return child_lists(keys_only(children, key, parents, parent_key, unique=True), key, lists, counted=children, **options)


def with_child_lists(
    df: DataFrame, key: str, lists: DataFrame, lists_key: str, piece: str | None = None
) -> DataFrame:
    """Attach the lists by the parents' own id. Parents without children get nulls, several pieces give as many rows.

    With ``piece`` the number of the piece is kept under that name, so that later joins can treat the first row of a
    parent apart from its further pieces.
    """
    take = {c: c for c in lists.columns if c not in (lists_key, "piece")}
    if piece:
        take["piece"] = piece
    return left_by_key(df, key, lists, lists_key, take)


def first_piece_key(key: str, piece: str) -> Column:
    """The parent's id on its first row (piece 0 or no children) only, so that a fan-out is not multiplied by the further pieces."""
    return F.when(F.coalesce(F.col(piece), F.lit(0)) == 0, as_col(key))


def backfilled_parent(
    df: DataFrame,
    order_col: str,
    key: str,
    tt: DataFrame,
    spread_by: list[str],
    tt_key: str = "ticketid",
    tt_order: str = "orderid",
    unique: bool = False,
) -> DataFrame:
    """Fill a missing parent order id by ticket id; several finds are joined by ``;``, none gives an empty text.

    Rows that hold an id look nothing up: their key is null and spreads. ``unique`` says that each ticket id occurs
    once, which saves the grouping of the finds.
    """
    found = tt.select(as_col(tt_key).alias("__k"), as_col(tt_order).alias("__v"))
    if not unique:
        pairs = found.where(F.col("__v").isNotNull()).distinct()
        found = child_lists(pairs, "__k", {"__v": ("__v", "__v")}, sep=";").where(F.col("__v").isNotNull())
    key_if_missing = F.when(as_col(order_col).isNull(), as_col(key))
    joined = left_by_key(df, key_if_missing, found, "__k", {"__v": "__found"}, spread_by)
    return joined.withColumn(order_col, F.coalesce(as_col(order_col), F.col("__found"), F.lit(""))).drop("__found")


def list_key(column: str, prefixes: list[str] | None = None, sep: str = ";") -> Column:
    """The text of an id list without its prefixes; null for a text without the separator."""
    text = as_col(column)
    for prefix in prefixes or []:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return F.when(F.contains(as_col(column), F.lit(sep)), text)


def list_names(lists: DataFrame, groups: DataFrame, users: DataFrame, sep: str = ";") -> DataFrame:
    """(ids, text): the names of each distinct id list of the one column of ``lists``; an id is a group first and a user otherwise.

    Unknown ids ahead of the first known one vanish, later ones leave an empty slot. A text that fills many rows is worked on once.
    """
    texts = lists.toDF("ids").where(F.col("ids").isNotNull()).distinct()
    single = texts.select("ids", F.posexplode(list_items("ids", sep)).alias("pos", "item")).withColumn(
        "id", F.trim("item").try_cast("long")
    )
    group_names = one_per_key(groups, "group_id", "groupname")
    user_names = one_per_key(users, "user_id", "fullname")
    named = left_by_key(single, "id", group_names, "__k", {"__v": "group_name"}, ["ids", "pos"])
    named = left_by_key(named, "id", user_names, "__k", {"__v": "user_name"}, ["ids", "pos"])
    slot = F.struct("pos", F.coalesce("group_name", "user_name", F.lit("")).alias("name"))
    slots = F.transform(F.array_sort(F.collect_list(slot)), lambda s: s["name"])
    return named.groupBy("ids").agg(slots.alias("slots")).select("ids", _join_slots(F.col("slots"), sep).alias("text"))


def resolve_id_lists(
    df: DataFrame,
    columns: list[str],
    groups: DataFrame,
    users: DataFrame,
    prefixes: dict[str, list[str]] | None = None,
    sep: str = ";",
) -> DataFrame:
    """Turn ``;`` lists of ids into ``;`` lists of names, order kept, as ``list_names`` does; other texts stay as they are."""
    keys = {c: list_key(c, (prefixes or {}).get(c), sep) for c in columns}
    resolved = list_names(df.select(F.explode(F.array(*keys.values()))), groups, users, sep)
    out = df.withColumns({f"__ids_{i}": k for i, k in enumerate(keys.values())})
    for i, c in enumerate(columns):
        out = left_by_key(out, f"__ids_{i}", resolved, "ids", {"text": f"__text_{i}"}, df.columns[:2])
    changed = {c: F.coalesce(F.col(f"__text_{i}"), as_col(c)) for i, c in enumerate(columns)}
    helpers = [f"__{kind}_{i}" for kind in ("ids", "text") for i in range(len(columns))]
    return out.withColumns(changed).drop(*helpers)


def _join_slots(slots: Column, sep: str) -> Column:
    """Drop the empty slots at the front, then join the rest."""
    known = F.transform(slots, lambda s: F.when(s != "", True).otherwise(False))
    first = F.array_position(known, True)
    kept = F.slice(slots, F.greatest(first, F.lit(1)).cast("int"), F.size(slots))
    return F.when(first > 0, F.array_join(kept, sep)).otherwise("")
