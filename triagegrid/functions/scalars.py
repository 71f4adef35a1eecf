"""Scalar column expressions. All of them stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagegrid.functions import fixed

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def as_col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def strip_text(c: Column | str, text: str) -> Column:
    """Remove every copy of ``text``; an empty rest counts as missing."""
    return F.nullif(F.replace(as_col(c), F.lit(text), F.lit("")), F.lit(""))


def has_separator(c: Column | str, sep: str = ";") -> Column:
    return F.instr(as_col(c), sep) > 0


def clean_assignment(c: Column | str, label: Column, prefix: str = "group:") -> Column:
    """A list keeps its ids without the prefix, a single code takes its looked-up label."""
    return F.when(has_separator(c), strip_text(c, prefix)).otherwise(label)


def braced_value(c: Column | str, start: int = 11, tail: str = '"}') -> Column:
    """The value inside a short JSON-like text: cut at a position, closing characters trimmed."""
    return F.rtrim(F.substring(as_col(c), start, 1000), F.lit(tail))


def upper_contains(c: Column | str, text: str) -> Column:
    return F.upper(as_col(c)).like(f"%{text}%")


def or_else(c: Column | str, stand_in: str = "-") -> Column:
    return F.coalesce(as_col(c), F.lit(stand_in))


def local_time(c: Column | str, zone: str = fixed.LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(as_col(c), zone)


def time_text(c: Column | str) -> Column:
    return F.date_format(as_col(c), TIME_FORMAT)


def local_text(c: Column | str, zone: str = fixed.LOCAL_ZONE) -> Column:
    return time_text(local_time(c, zone))


def month_name_text(c: Column | str) -> Column:
    return F.upper(F.date_format(as_col(c), "dd-MMM-yyyy HH:mm:ss"))


def year_number(c: Column | str) -> Column:
    return F.year(as_col(c))


def parse_time(c: Column | str, lenient: bool = False) -> Column:
    if lenient:
        return F.try_to_timestamp(as_col(c), F.lit(TIME_FORMAT))
    return F.to_timestamp(as_col(c), TIME_FORMAT)


def whole_second(c: Column | str) -> Column:
    """The instant without its fraction; the time of day stays."""
    return F.date_trunc("second", as_col(c))


def phase_label(c: Column | str) -> Column:
    return map_values(c, fixed.PHASE_LABELS, other=F.lit(fixed.LAST_PHASE))


def list_items(c: Column | str, sep: str = ";") -> Column:
    return F.split(as_col(c), f"\\Q{sep}\\E")


def trimmed_items(c: Column | str, sep: str = ";") -> Column:
    return F.transform(list_items(c, sep), lambda x: F.trim(x))


def first_item(c: Column | str, sep: str = ";") -> Column:
    return F.substring_index(as_col(c), sep, 1)


def first_item_with(c: Column | str, code: Column | str, sep: str = ";") -> Column:
    """The first list item that contains ``code``: the one around the code's first occurrence in the text."""
    text, code = as_col(c), F.lit(code) if isinstance(code, str) else code
    at = F.position(code, text)
    before = F.substring_index(F.substring(text, F.lit(1), at - 1), sep, -1)
    after = F.substring_index(F.substring(text, at, F.length(text)), sep, 1)
    return F.when(at > 0, F.concat(before, after))


def matches(c: Column | str, pattern: str) -> Column:
    return as_col(c).rlike(pattern)


def map_values(c: Column | str, mapping: dict[str, str], other: Column | None = None) -> Column:
    """Replace the listed values; the rest is kept, or becomes ``other``.

    A literal map names the input once or twice, where a CASE would repeat it per value.
    """
    c = as_col(c)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c if other is None else other)


def to_number(c: Column | str, kind: str = "double") -> Column:
    return as_col(c).try_cast(kind)


def duration_text(minutes: Column, pattern: str = "{days} days {hours}:{minutes}") -> Column:
    """Whole minutes as days, hours and minutes; a negative span borrows from the days."""
    days = F.floor(minutes / 1440)
    parts = {
        "days": days,
        "hours": F.lpad(F.floor(F.pmod(minutes, F.lit(1440)) / 60).cast("string"), 2, "0"),
        "minutes": F.lpad(F.pmod(minutes, F.lit(60)).cast("string"), 2, "0"),
    }
    out, rest = [], pattern
    while "{" in rest:
        text, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        out += [F.lit(text), parts[name].cast("string")]
    return F.concat(*out, F.lit(rest))
