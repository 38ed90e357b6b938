"""Column expressions shared by the operators that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+``; none of a NULL text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")
