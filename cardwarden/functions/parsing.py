"""Text to typed values. Every function returns NULL for text it cannot read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    """Day of `2021-03-01`, `2021-3-1` or `2021-03-01 10:11:12`; NULL for any other form.

    The text-to-date cast drops the time of day, but also takes a lone year or month and
    years of more digits, so the places of the two dashes are tested first.
    """
    bare = F.ltrim(text, F.lit(" \t\n\x0b\f\r"))
    dashes = (F.locate("-", bare) == 5) & F.locate("-", bare, 6).between(7, 8)
    return F.when(dashes, text.try_cast("date"))


def parse_listed_day(text: Column) -> Column:
    """Day of a blacklist entry: only the first ten characters count."""
    return parse_day(F.substring(text, 1, 10))


def parse_compact_day(text: Column) -> Column:
    """Day of `20210303`."""
    return F.try_to_date(text, "yyyyMMdd")


def parse_amount(text: Column) -> Column:
    """Amount with a decimal comma or point, rounded half up to cents."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("decimal(18,2)")


def file_day(name: Column) -> Column:
    """Day a dropped file is for, written `DDMMYYYY` just before its extension or extensions."""
    return F.try_to_date(F.regexp_extract(name, r"(\d{8})(?:\.[^.]+)+$", 1), "ddMMyyyy")


def load_order(path: Column) -> Column:
    """Orders files as they are loaded: by the day in the name, then by name."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.concat_ws(" ", F.date_format(file_day(name), "yyyy-MM-dd"), name)


def full_name(last: Column, first: Column, patronymic: Column) -> Column:
    """NULL as soon as one part is NULL, unlike concat_ws."""
    return F.concat(last, F.lit(" "), first, F.lit(" "), patronymic)


def unread(text: Column, value: Column) -> Column:
    """True where text was given but could not be read."""
    return text.isNotNull() & value.isNull()


def differs(left: Column, right: Column) -> Column:
    """Inequality that counts NULL against a value as a change and NULL against NULL as none."""
    return ~left.eqNullSafe(right)
