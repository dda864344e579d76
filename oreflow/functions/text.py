"""Cleaning of text columns: built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    return F.trim(F.col(f"`{name}`")).alias(name)


def _tried(value: str | Column, kind: str) -> Column:
    column = F.col(f"`{value}`") if isinstance(value, str) else value
    # try_cast: with ANSI on, a plain cast of '-' would end the job
    return F.trim(column.cast("string")).try_cast(kind)


def to_int(value: str | Column) -> Column:
    return _tried(value, "int")


def to_long(value: str | Column) -> Column:
    return _tried(value, "bigint")


def to_double(value: str | Column) -> Column:
    return _tried(value, "double")
