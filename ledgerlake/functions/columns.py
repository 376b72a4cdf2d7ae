"""Column-name and text shaping helpers (driver-side names, JVM-side values)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NOT_WORD = re.compile(r"[^a-zA-Z0-9_]")


def clean_name(name: str) -> str:
    """Every character outside ``[a-zA-Z0-9_]`` becomes ``_``; leading and
    trailing ``_`` are stripped (``_ingest_ts`` -> ``ingest_ts``)."""
    return _NOT_WORD.sub("_", name).strip("_")


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename all columns with :func:`clean_name` (positional rename).

    Raises if two columns collapse to one name or a name becomes empty, which
    would otherwise silently shadow data.
    """
    names = [clean_name(c) for c in df.columns]
    empty = [orig for orig, new in zip(df.columns, names) if not new]
    if empty:
        raise ValueError(f"column names empty after cleaning: {empty}")
    seen: dict[str, str] = {}
    for orig, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {orig!r} both clean to {new!r}")
        seen[new] = orig
    return df.toDF(*names)


def file_name_of(path: Column) -> Column:
    """Last path segment of a file URI."""
    return F.regexp_extract(path, r"([^/]+$)", 1)


def mask_email(email: Column, domain: str = "gmail.com") -> Column:
    """Replace everything from the first ``@`` with ``@<domain>``, lower-cased."""
    return F.lower(F.regexp_replace(email, "@.*", "@" + domain))


def upper_or(c: Column, default: str) -> Column:
    """Upper-case, NULL -> ``default``."""
    return F.when(c.isNull(), F.lit(default)).otherwise(F.upper(c))
