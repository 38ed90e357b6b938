"""What was known at a point in time.

Facts and points go through one window per key in the order of time: a fact
adds to running sums and last values, a point reads them.  No fact is paired
with a point, and the rows of a hot key are split by ``sequence_windows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.windows import BUCKET_ROWS, sequence_windows


def as_of(
    facts: DataFrame,
    points: DataFrame,
    keys: list[str],
    fact_time: str,
    point_time: str,
    sums: dict[str, str] | None = None,
    last: dict[str, str] | None = None,
    inclusive: bool = False,
    hot_rows: int | None = None,
    small_bytes: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``points`` with sums and last values of the facts of their key before them.

    ``sums`` maps a new column to the fact column it sums (NULL where no fact
    came before), ``last`` to the column whose last value that is not NULL it
    takes; of facts at one time the greatest value is the last.  Facts at the
    time of a point count only if ``inclusive``.  Rows of either side whose
    time is NULL meet nothing; NULL keys are a key like any other.  Every row
    of ``points`` comes out once.
    """
    sums, last = sums or {}, last or {}
    used = list(dict.fromkeys([*sums.values(), *last.values()]))
    fields = [F.col(f"p.{c}").alias(c) for c in points.columns]
    row = points.select(F.struct(*[F.col(c) for c in points.columns]).alias("p"), *keys)
    kind = facts.schema[fact_time].dataType
    # At one time: facts of an inclusive look-up, points, other facts.
    side = F.lit(0 if inclusive else 2)
    left = facts.filter(F.col(fact_time).isNotNull()).select(
        *keys, F.col(fact_time).alias("_t"), side.alias("_side"), *[F.col(c).alias(f"_v_{c}") for c in used],
        F.lit(None).cast(row.schema["p"].dataType).alias("p"))
    right = row.select(
        *keys, F.col(f"p.{point_time}").cast(kind).alias("_t"), F.lit(1).alias("_side"),
        *[F.lit(None).cast(facts.schema[c].dataType).alias(f"_v_{c}") for c in used], "p")
    both = left.unionByName(right)
    order = ["_t", "_side", *dict.fromkeys(f"_v_{c}" for c in last.values())]
    seen = sequence_windows(
        both, keys, order, peer_running={f"_s_{n}": f"_v_{c}" for n, c in sums.items()},
        last={f"_l_{n}": f"_v_{c}" for n, c in last.items()},
        hot_rows=hot_rows, small_bytes=small_bytes, bucket_rows=bucket_rows)
    return seen.filter("_side = 1").select(
        *fields, *[F.col(f"_s_{n}").alias(n) for n in sums], *[F.col(f"_l_{n}").alias(n) for n in last])
