"""Typed values out of text columns. Bad text raises an error, as sessions have ANSI casts on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unbounded decimals have this type everywhere in the library.
NUMERIC = "decimal(38,10)"
_WHITE = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: Column | str) -> Column:
    """Null for an empty text; text of white space alone stays."""
    return F.nullif(column(x), F.lit(""))


def typed(x: Column | str, kind: str) -> Column:
    return blank_to_null(x).cast(kind)


def numeric(x: Column | str) -> Column:
    return typed(x, NUMERIC)


def bigint(x: Column | str) -> Column:
    return typed(x, "bigint")


def timestamp(x: Column | str) -> Column:
    return typed(x, "timestamp")


def date(x: Column | str) -> Column:
    return typed(x, "date")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from one timestamp text's day to another's."""
    return F.datediff(timestamp(end).cast("date"), timestamp(start).cast("date"))


def yes_no(x: Column | str) -> Column:
    """Y and y are true, N and n false, all else null."""
    letter = F.upper(column(x))
    return F.when(letter == "Y", True).when(letter == "N", False)


def stripped(x: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(column(x), _WHITE, "")


def is_blank(x: Column | str) -> Column:
    return column(x).isNull() | (stripped(x) == "")


def first_filled(*xs: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(x) for x in xs])
