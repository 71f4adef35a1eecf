"""Ticket classification as column expressions."""

from __future__ import annotations

import re
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.scalars import as_col, duration_text, first_item_with, map_values, strip_text


def instant(value: datetime | str | Column) -> Column:
    """A literal time; text is read in the session zone."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def whole_minutes(end: Column, start: Column) -> Column:
    """Minutes from start to end, seconds cut off (down, also for negative spans)."""
    span = F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))
    return F.floor(span / 60)


def aging_hours(created: Column | str, as_of: datetime | str | Column) -> Column:
    return whole_minutes(instant(as_of), as_col(created)) / 60


def aging_text(
    created: Column | str, as_of: datetime | str | Column, pattern: str = "{days} days {hours}:{minutes}"
) -> Column:
    return duration_text(whole_minutes(instant(as_of), as_col(created)), pattern)


def aging_bucket(hours: Column | str) -> Column:
    hours = as_col(hours)
    below, between, above = fixed.AGING_AXIS
    return F.when(hours < 4, below).when(hours <= 24, between).when(hours > 24, above)


def first_rule(text: Column | str, rules: list[tuple[str, str]]) -> Column:
    """Label of the first pattern that matches; null when none does. Plain words need no regex engine."""
    text = as_col(text)

    def hit(pattern: str) -> Column:
        return text.contains(pattern) if re.fullmatch(r"\w+", pattern) else text.rlike(pattern)

    (label, pattern), *rest = rules
    return reduce(lambda w, rule: w.when(hit(rule[1]), rule[0]), rest, F.when(hit(pattern), label))


def workgroup(
    group: Column | str, processor: Column | str, rules: list[tuple[str, str]] = fixed.WORKGROUP_RULES
) -> Column:
    group = as_col(group)
    return F.when(group == "NA", first_rule(processor, rules)).otherwise(first_rule(group, rules))


def area_from_group(group: Column | str) -> Column:
    return first_rule(group, fixed.AREA_RULES)


def repaired_area(area: Column | str, title: Column | str, group: Column | str) -> Column:
    """A known area stays; else a known area before the first bar of the title; else the group's area."""
    area = as_col(area)
    known = list(fixed.AREA_CODES)
    in_title = F.trim(F.substring_index(as_col(title), "|", 1))
    return F.when(area.isin(known), area).when(in_title.isin(known), in_title).otherwise(area_from_group(group))


def area_code(area: Column | str) -> Column:
    return map_values(area, fixed.AREA_CODES)


def technology_label(technology: Column | str) -> Column:
    return map_values(technology, fixed.TECHNOLOGY_LABELS)


def affecting_type(site_down: Column | str) -> Column:
    return map_values(site_down, fixed.AFFECTING_TYPES, other=F.lit(None).cast("string"))


def coded_item(text: Column | str, codes: list[str] = fixed.LIST_CODES) -> Column:
    """Codes are tried in order; the first one found anywhere gives the first item that contains it."""
    text = as_col(text)
    first, *rest = dict.fromkeys(codes)
    best = reduce(lambda w, code: w.when(text.contains(code), code), rest, F.when(text.contains(first), first))
    return first_item_with(text, best)


def severity_rank(label: Column | str, order: list[str] = fixed.SEVERITY_ORDER) -> Column:
    """Position in the ordered category; labels outside it have none."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), as_col(label))
    return F.nullif(place, F.lit(0).cast("long")).cast("int") - 1


def listed_severity(label: Column | str, order: list[str] = fixed.SEVERITY_ORDER) -> Column:
    label = as_col(label)
    return F.when(label.isin(order), label)


def business_status(status: Column | str) -> Column:
    return strip_text(status, "BusinessStatus")


def status_header(status: Column | str) -> Column:
    return map_values(status, fixed.STATUS_SPELLING)


def before_year(year: Column | str, as_of: datetime | str | Column) -> Column:
    return as_col(year) < F.year(instant(as_of))


def in_year(year: Column | str, as_of: datetime | str | Column) -> Column:
    return as_col(year) == F.year(instant(as_of))
