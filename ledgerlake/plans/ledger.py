"""Run ledger: what became of each window of each job, and which windows are still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import GOLD_RUN_LEDGER, conform

DONE, FAILED = "done", "failed"
WINDOW = ("window_start", "window_end")


def latest_state(ledger: DataFrame) -> DataFrame:
    """The last record of each (job, window), with the number of runs there were: ``attempts``."""
    told = [c for c in GOLD_RUN_LEDGER if c not in ("job", *WINDOW)]
    last = F.max_by(F.struct(*told), F.struct("recorded_at", F.col("state") == DONE)).alias("last")
    return ledger.groupBy("job", *WINDOW).agg(last, F.count(F.lit(1)).alias("attempts")).select("job", *WINDOW, "last.*", "attempts")


def pending(windows: DataFrame, ledger: DataFrame, job: str) -> DataFrame:
    """The windows that the job has not finished: never run, or failed the last time."""
    finished = latest_state(ledger.where(F.col("job") == job)).where(F.col("state") == DONE)
    return windows.select(*WINDOW).join(finished, list(WINDOW), "left_anti")


def records(
    windows: DataFrame, job: str, state: Column, row_count: Column, message: Column, recorded_at: Column | None = None
) -> DataFrame:
    """Ledger rows for windows, ready to be appended."""
    now = F.current_timestamp() if recorded_at is None else recorded_at
    return conform(
        windows,
        GOLD_RUN_LEDGER,
        {"job": F.lit(job), "state": state, "row_count": row_count, "message": message, "recorded_at": now},
    )
