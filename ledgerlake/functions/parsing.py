"""ANSI-safe parsers: a value that does not parse becomes NULL, never an error.

Spark 4 runs with ANSI mode on, where a plain ``cast``/``to_date`` throws on
bad input. Cleansing relies on "unparseable -> NULL -> filtered", so every
parse here goes through a ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def to_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(c, fmt)


# Patterns of the two feeds' timestamps, and the shape of a text that fits them.
SHAPES = {
    "yyyy-MM-dd HH:mm:ss.SSSSSS": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
}


def to_wall_timestamp(c: Column, fmt: str) -> Column:
    """Parse to a wall-clock ``timestamp_ntz``, NULL if the text does not fit.
    It never passes through an instant, so hours that a session zone skips or
    repeats stay as written."""
    return F.when(c.rlike(SHAPES[fmt]), c.try_cast("timestamp_ntz"))


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a wall-clock timestamp (``unix_timestamp``)."""
    return F.unix_timestamp(ts)
