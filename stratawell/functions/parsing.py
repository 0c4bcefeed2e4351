"""Tolerant parsing of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratawell.config import ENTITY_PATTERN, LOG_NULL_VALUE, SHEET_DATE_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; anything unreadable becomes NULL."""
    return _col(c).try_cast("double")


def to_day(c: Column | str, fmt: str = SHEET_DATE_FORMAT) -> Column:
    """Text to date; anything unreadable becomes NULL, also under ANSI mode."""
    return F.try_to_date(_col(c), fmt)


def entity_key(c: Column | str, pattern: str = ENTITY_PATTERN) -> Column:
    """First match of the entity pattern; an empty string where there is none."""
    return F.regexp_extract(_col(c), pattern, 0)


def without_sentinel(c: Column | str, sentinel: float = LOG_NULL_VALUE) -> Column:
    """NULL in place of the marker that stands for a missing reading."""
    return F.nullif(_col(c), F.lit(sentinel))
