"""Steps that several report plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.scalars import as_col, braced_value, strip_text
from triagegrid.operators.lookups import Ask, keys_only, lookup, one_per_key


def user_name(df: DataFrame, tables, key: Column | str, out: str) -> DataFrame:
    """Full name of a user id; a ``user:`` prefix is allowed."""
    ident = strip_text(key, "user:").try_cast("long")
    return lookup(df, ident, tables["user_dim"], "user_id", "fullname", out)


def label_of(df: DataFrame, tables, dim: str, key: Column | str, out: str) -> DataFrame:
    """Label of a code in one of the small code tables."""
    return lookup(df, key, tables[dim], "code", "label", out)


def user_ask(tables, key: Column | str, out: str) -> Ask:
    """``user_name`` as one of several stacked lookups."""
    return Ask(out, strip_text(key, "user:").try_cast("long"), tables["user_dim"], "user_id", "fullname")


def label_ask(tables, dim: str, key: Column | str, out: str) -> Ask:
    """``label_of`` as one of several stacked lookups."""
    return Ask(out, key, tables[dim], "code", "label")


def parents_of(tt: DataFrame, tables, out: str = "parent") -> DataFrame:
    """(associateticketid, parent): order ids of the tickets that the given ones are associated with, a row per association."""
    pairs = keys_only(tables["ticket_associate"], "associateticketid", tt, "ticketid", unique=True)
    pairs = pairs.select("associateticketid", "sourceticketid")
    return lookup(pairs, "sourceticketid", tables["ticket_order"], "ticketid", "orderid", out, strict=True)


def processors_of(df: DataFrame, tables, dim: str, out: str, key: str = "ticketid") -> DataFrame:
    """Current processors of a ticket; both tables hold each ticket once."""
    return lookup(df, key, tables[dim], "ticketid", "processors", out, unique=True, own_id=True)


def handled_by(df: DataFrame, tables, dim: str, group: str = fixed.REPORT_TEAM_GROUP) -> DataFrame:
    """Rows whose current processors name the group; the pattern filters the processor scan, not the joined rows."""
    matching = tables[dim].where(F.col("processors").like(f"%{group}%"))
    return keys_only(df, "ticketid", matching, "ticketid", unique=True)


def known_people(tables) -> DataFrame:
    """Active users that have a default group."""
    return tables["user_dim"].where((F.col("active") == 1) & F.col("user_default_group").isNotNull())


def roster(tables, group: str = fixed.REPORT_TEAM_GROUP) -> DataFrame:
    """The team: active users whose default group is the given one."""
    return known_people(tables).where(F.col("user_default_group") == group)


def of_team(df: DataFrame, tables, user: str, team: DataFrame, out: str = "Operator") -> DataFrame:
    """Rows whose operator's full name is on the roster, with that name."""
    return keys_only(user_name(df, tables, user, out), out, team, "fullname")


def team_tasks(tables, nodes: list[str], group: str = fixed.REPORT_TEAM_GROUP) -> DataFrame:
    """Task log rows of the given nodes that were assigned to a group whose name contains ``group``."""
    names = one_per_key(tables["user_group"], "code", "label").where(F.upper("__v").like(f"%{group}%"))
    tasks = tables["ticket_task"].where(F.col("nodeid").isin(nodes))
    named = lookup(tasks, braced_value("assignto"), names, "__k", "__v", "assign_group", unique=True)
    return named.where(F.col("assign_group").isNotNull())


def columns_as(df: DataFrame, names: dict[str, Column | str]) -> DataFrame:
    """Projection with exact output names."""
    return df.select(*[as_col(c).alias(out) for out, c in names.items()])
