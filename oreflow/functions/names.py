"""Column names: lookup without regard to case, and sanitising. Schema only, no job."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.layouts import FORBIDDEN_NAME_CHARACTERS


def resolve_column(df: DataFrame, *candidates: str, required: bool = True) -> str | None:
    """The actual name of the first candidate that ``df`` has, in any case.

    Candidates are tried in the order given. A missing optional column is None.
    """
    actual = {name.casefold(): name for name in reversed(df.columns)}
    found = next((actual[c.casefold()] for c in candidates if c.casefold() in actual), None)
    if found is None and required:
        raise ValueError(f"no column named like {list(candidates)}; the columns are {df.columns}")
    return found


def resolve_values(df: DataFrame, *candidates: str) -> Column:
    """Text of the first candidate that a row has a value for: rows of one table may use different columns."""
    actual = {name.casefold(): name for name in reversed(df.columns)}
    found = [actual[c.casefold()] for c in candidates if c.casefold() in actual]
    if not found:
        raise ValueError(f"no column named like {list(candidates)}; the columns are {df.columns}")
    return F.coalesce(*[F.col(f"`{name}`").cast("string") for name in found])


def sanitize_names(df: DataFrame) -> DataFrame:
    """Trim column names and put ``_`` for every character a table column may not hold."""
    table = str.maketrans(dict.fromkeys(FORBIDDEN_NAME_CHARACTERS, "_"))
    names = [name.strip().translate(table) for name in df.columns]
    twice = sorted(n for n, times in Counter(n.casefold() for n in names).items() if times > 1)
    if twice:
        raise ValueError(f"column names collide after sanitising: {twice}")
    return df.toDF(*names)
