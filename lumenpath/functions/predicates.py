"""Filter predicates.  ``None`` stands for "no such filter" and is dropped by ``where_all``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenpath.functions.exprs import instant

FOLD = "UNICODE_CI_AI"  # compare text without regard to case and accents


def where_all(df: DataFrame, *predicates: Column | None) -> DataFrame:
    used = [p for p in predicates if p is not None]
    return df.where(reduce(and_, used)) if used else df


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(and_, predicates)


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(or_, predicates)


def one_of(column: Column, values: Iterable | None) -> Column | None:
    """IN-list; an empty list means no filter."""
    values = list(values or ())
    return column.isin(values) if values else None


LITERAL_VALUES = 1000  # a longer list is joined, not written into the plan


def keep_listed(df: DataFrame, column: str, values: Iterable | None) -> DataFrame:
    """Rows whose column holds one of the values; an empty list means no filter.

    A long list becomes a semi-join, its size bounded by the request that carries it.
    """
    values = list(dict.fromkeys(values or ()))
    if len(values) <= LITERAL_VALUES:
        return where_all(df, one_of(F.col(column), values))
    kind = df.schema[column].dataType.simpleString()
    listed = df.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` {kind}")
    return df.join(F.broadcast(listed), column, "left_semi").select(*df.columns)


def keep_all_listed(df: DataFrame, lists: Mapping[str, Iterable | None]) -> DataFrame:
    """``keep_listed`` for several columns: rows that pass all of the lists."""
    for column, values in lists.items():
        df = keep_listed(df, column, values)
    return df


def keep_either_listed(df: DataFrame, columns: Sequence[str], values: Iterable | None) -> DataFrame:
    """Rows of which some column holds one of the values; an empty list means no filter.

    With a long list each column is looked up in the same broadcast; the list is distinct, so no row is repeated.
    """
    values = list(dict.fromkeys(values or ()))
    if len(values) <= LITERAL_VALUES:
        return where_all(df, either_one_of([F.col(c) for c in columns], values))
    kept = df
    for k, column in enumerate(columns):
        kind = df.schema[column].dataType.simpleString()
        listed = df.sparkSession.createDataFrame([(v,) for v in values], f"_listed{k} {kind}")
        kept = kept.join(F.broadcast(listed), F.col(column) == F.col(f"_listed{k}"), "left")
    return kept.where(any_of(F.col(f"_listed{k}").isNotNull() for k in range(len(columns)))).select(*df.columns)


def with_flag(column: Column, codes: Iterable[int] | None, active: object = True, inactive: object = False) -> Column | None:
    """Rows of the asked user statuses: 1 active, 0 inactive; no code means no filter, and a code that is neither matches no row."""
    asked = list(codes or ())
    known = [value for code, value in ((1, active), (0, inactive)) if code in asked]
    return one_of(column, known) if known or not asked else F.lit(False)


def either_one_of(columns: Iterable[Column], values: Iterable | None) -> Column | None:
    """Some column holds one of the values."""
    values = list(values or ())
    return any_of(F.coalesce(c.isin(values), F.lit(False)) for c in columns) if values else None


def unless(switch: bool, predicate: Column) -> Column | None:
    """``predicate`` unless the switch (such as "show inactive") is on."""
    return None if switch else predicate


Window = tuple[datetime | str | None, datetime | str | None]


def has_window(window: Window | None) -> bool:
    return bool(window and window[0] and window[1])


def in_window(column: Column, window: Window | None, show_empty: bool = False) -> Column | None:
    """Inclusive date window, used only when both ends are given; ``show_empty`` also keeps NULL."""
    if not has_window(window):
        return None
    inside = column.between(instant(window[0]), instant(window[1]))
    return inside | column.isNull() if show_empty else inside


def is_real_user(users: str = "") -> Column:
    """Neither a built-in account nor deleted."""
    prefix = f"{users}." if users else ""
    return ~F.col(f"{prefix}is_default") & F.col(f"{prefix}deleted_at").isNull()


def text_matches(operation: Column, value: Column, wanted: Column) -> Column:
    """``equal_to``, ``starts_with``, ``ends_with``, ``contains`` or ``is_empty``."""
    left, right = F.collate(value, FOLD), F.collate(wanted, FOLD)
    return (
        F.when(operation == "equal_to", left == right)
        .when(operation == "starts_with", left.startswith(right))
        .when(operation == "ends_with", left.endswith(right))
        .when(operation == "contains", left.contains(right))
        .when(operation == "is_empty", value.isNull() | (value == ""))
        .otherwise(F.lit(False))
    )


def typed_matches(operation: Column, value: Column, low: Column, high: Column, kind: str) -> Column:
    """Comparison of text that holds a number or a date; text that does not parse never matches."""
    v, a, b = value.try_cast(kind), low.try_cast(kind), high.try_cast(kind)
    return (
        F.when(operation == "equal_to", v == a)
        .when(operation == "in_between", v.between(a, b))
        .when(operation == "greater_than", v > a)
        .when(operation == "greater_than_or_equal_to", v >= a)
        .when(operation == "less_than", v < a)
        .when(operation == "less_than_or_equal_to", v <= a)
        .otherwise(F.lit(False))
    )


def mentions(columns: Iterable[Column], term: str | None) -> Column | None:
    """Search box: some column contains the term."""
    if not term:
        return None
    wanted = F.collate(F.lit(term), FOLD)
    return any_of(F.coalesce(F.collate(c.cast("string"), FOLD).contains(wanted), F.lit(False)) for c in columns)
