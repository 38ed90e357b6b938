"""Staged quality run: every stage leaves a log row, also the one that fails."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

STAGE_LOG = "stage string, success boolean, detail string"


def run_stages(
    spark: SparkSession, stages: list[tuple[str, Callable[[], str]]]
) -> DataFrame:
    """Run the stages in order and stop at the first that raises.

    A stage is a name and a function that returns a short text.  Later stages
    are logged as skipped.
    """
    log, failed = [], False
    for name, run in stages:
        if failed:
            log.append((name, False, "skipped"))
            continue
        try:
            log.append((name, True, run()))
        except Exception as e:  # noqa: BLE001 - the log must show any failure
            failed = True
            log.append((name, False, f"{type(e).__name__}: {str(e).splitlines()[0]}"))
    return spark.createDataFrame(log, STAGE_LOG)
