"""Column functions that clean raw text.  A value that does not parse is NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(c: Column) -> Column:
    """Empty or blank text becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def tidy(c: Column) -> Column:
    return F.trim(F.lower(c))


def to_number(c: Column, type_name: str = "double") -> Column:
    """Number from text with currency signs or separators; keeps the sign."""
    return F.regexp_replace(c, "[^0-9.\\-]", "").try_cast(type_name)


def parse_date(c: Column, fmt: str) -> Column:
    return F.try_to_date(c, fmt)


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns, and the rest.  Every row is in one."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok)


def schema_listing(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, data_type string, nullable boolean"
    )


def as_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
