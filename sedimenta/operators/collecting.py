"""Lists and sets of a group as bounded pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.windows import sequence_windows

PIECE_ROWS = 10_000


def collect_pieces(
    df: DataFrame, keys: list[str], value: str, order: list[str], piece_rows: int = PIECE_ROWS, **split
) -> DataFrame:
    """All values per key in ``order``, as arrays of at most ``piece_rows``.

    ``piece`` numbers the arrays of a key from 0; their concatenation is the
    whole list.  No array and no task holds a whole hot key.
    """
    rows = sequence_windows(df, keys, order, number="_pos", **split)
    piece = F.floor((F.col("_pos") - 1) / F.lit(piece_rows)).cast("long")
    return (
        rows.withColumn("piece", piece)
        .groupBy(*keys, "piece")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", value))).alias("_list"))
        .withColumn("items", F.transform("_list", lambda x: x[value]))
        .drop("_list")
    )


def collect_distinct_pieces(
    df: DataFrame, keys: list[str], value: str, piece_rows: int = PIECE_ROWS, **split
) -> DataFrame:
    """Like ``collect_pieces`` over the distinct non-null values, sorted."""
    distinct = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    return collect_pieces(distinct, keys, value, [value], piece_rows, **split)
