"""Small helpers shared by the column rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed_text(c: Column | str) -> Column:
    """The cell as text without leading and trailing spaces (spaces only, not tabs)."""
    return F.trim(as_column(c).cast("string"))
