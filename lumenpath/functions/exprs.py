"""Scalar expressions: durations, percentages, dates and text, all on built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime | str) -> Column:
    """A constant timestamp without zone."""
    text = moment if isinstance(moment, str) else moment.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def _two_digits(number: Column) -> Column:
    return F.when(number < 10, F.concat(F.lit("0"), number.cast("string"))).otherwise(number.cast("string"))


def _whole(seconds: Column, unit: int) -> Column:
    return F.floor(seconds / unit).cast("bigint")


def _tail(seconds: Column) -> Column:
    return F.concat(_two_digits(_whole(seconds % 3600, 60)), F.lit(":"), _two_digits(seconds % 60))


def clock(seconds: Column) -> Column:
    """``HH:MM:SS``; hours grow past two digits when needed."""
    whole = seconds.cast("bigint")
    return F.concat(_two_digits(_whole(whole, 3600)), F.lit(":"), _tail(whole))


def short_clock(seconds: Column) -> Column:
    """``H:MM:SS``; zero is ``0:00:00``."""
    whole = seconds.cast("bigint")
    return F.concat(_whole(whole, 3600).cast("string"), F.lit(":"), _tail(whole))


def decimal_comma(value: Column) -> Column:
    return F.translate(value.cast("string"), ".", ",")


def money(value: Column, precision: int = 18) -> Column:
    return value.cast(f"decimal({precision},2)")


def percent(part: Column, whole: Column) -> Column:
    """Two-decimal percentage; NULL when ``whole`` is zero."""
    share = part.cast("decimal(18,2)") / F.nullif(whole, F.lit(0)).cast("decimal(18,2)")
    return (share * 100).cast("decimal(18,2)")


def percent_text(part: Column, whole: Column) -> Column:
    """``33,33%``"""
    return F.concat(decimal_comma(percent(part, whole)), F.lit("%"))


def grouped_number(value: Column) -> Column:
    """``1.234,50``: thousands point, decimal comma."""
    return F.translate(F.format_number(money(value), 2), ",.", ".,")


def day(moment: Column) -> Column:
    return F.date_format(moment, "dd/MM/yyyy")


def day_minute(moment: Column) -> Column:
    return F.date_format(moment, "dd/MM/yyyy HH:mm")


def day_second(moment: Column) -> Column:
    return F.date_format(moment, "dd/MM/yyyy HH:mm:ss")


def plus_days(moment: Column, days: Column) -> Column:
    """Timestamp shifted by a number of days held in a column."""
    return moment + F.make_dt_interval(days.cast("int"))


def first_chars(text: Column, below: int) -> Column:
    """The first ``below - 1`` characters: a 0-based substring of length ``below`` in the legacy database."""
    return F.substring(text, 1, below - 1)


def without_prefix(name: Column, tenant_id: Column) -> Column:
    """Attribute name without its literal ``<tenant>_`` prefix."""
    return F.trim(F.replace(name, F.concat(tenant_id, F.lit("_")), F.lit("")))


def to_id(text: Column) -> Column:
    """Integer key held as text; NULL when it is not a number."""
    return text.try_cast("bigint")


def blank_when(condition: Column, value: Column) -> Column:
    return F.when(condition, F.lit("")).otherwise(value)


def join_sorted(order: Sequence[str | Column], text: str | Column, separator: str = ", ") -> Column:
    """Aggregate: the texts of a group joined in the given order; NULL texts are left out, no text gives NULL."""
    text = F.col(text) if isinstance(text, str) else text
    items = F.collect_list(F.when(text.isNotNull(), F.struct(*order, text.alias("text"))))
    return F.when(F.size(items) > 0, F.array_join(F.sort_array(items)["text"], separator))


def spread_key(key: Column, *salt: Column) -> Column:
    """Join key for the optional side of a left join: missing keys become negative numbers that match nothing.

    A NULL key would send every row without a partner to one task; keys of the platform are not
    negative, so the substitutes never match and only spread those rows over all tasks.
    """
    return F.coalesce(key, -1 - F.pmod(F.xxhash64(*salt), F.lit(1 << 40)))
