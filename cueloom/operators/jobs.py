"""Jobs, step timings, warm-ups and poll logs as batch operators."""

from __future__ import annotations

import time
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timing import duration_ms, expiry
from ..schema import STEPS


def new_keys(keys: DataFrame, manifest: DataFrame, column: str = "output_base") -> DataFrame:
    """The rows whose output is not in the manifest yet."""
    return keys.join(manifest.select(column).distinct(), column, "left_anti")


def step_durations(timings: DataFrame) -> DataFrame:
    """timings (step, status, start_s, end_s) with duration_ms; skipped steps last no time."""
    lasted = F.when(F.col("status") == "skipped", F.lit(0)).otherwise(duration_ms("start_s", "end_s"))
    return timings.withColumn("duration_ms", lasted)


def warmup_expiry(messages: DataFrame, key: str = "worker", now: F.Column | None = None) -> DataFrame:
    """messages (key, type, until) to the time each worker is kept warm: only ever extended."""
    warm = messages.where("type = 'warmup'")
    return warm.groupBy(key).agg(F.max(expiry("until", now if now is not None else F.current_timestamp())).alias("until"))


def is_warm(until: F.Column, now: F.Column | None = None) -> F.Column:
    """Whether a worker that is kept warm to a time still is; one that was never warmed is not."""
    return F.coalesce(until > (now if now is not None else F.current_timestamp()), F.lit(False))


def idle_shutdowns(polls: DataFrame, key: str, order: str, most_empty: int = 3) -> DataFrame:
    """polls (key, order, n_messages, warm) with empty_run (empty polls in a row, warm or not) and stops.

    A worker stops at an empty poll that is the third in a row or later, unless it is warm.
    """
    by = Window.partitionBy(key).orderBy(order)
    runs = polls.withColumn("_run", F.sum(F.when(F.col("n_messages") > 0, 1).otherwise(0)).over(by))
    inside = Window.partitionBy(key, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = runs.withColumn("empty_run", F.sum(F.when(F.col("n_messages") > 0, 0).otherwise(1)).over(inside))
    return counted.withColumn("stops", (F.col("empty_run") >= most_empty) & (F.col("n_messages") == 0) & ~F.col("warm")).drop("_run")


class StepTimer:
    """Collects one record a step: success, error (raised on) or skipped."""

    def __init__(self):
        self.records: list[tuple] = []

    @contextmanager
    def step(self, name: str):
        if name not in STEPS:
            raise ValueError(f"unknown step {name!r}")
        start = time.time()
        try:
            yield
        except BaseException:
            self._record(name, "error", start)
            raise
        self._record(name, "success", start)

    def _record(self, name: str, status: str, start: float) -> None:
        end = time.time()
        when = [datetime.fromtimestamp(x, timezone.utc) for x in (start, end)]
        self.records.append((name, status, int((end - start) * 1000), *when))

    def skip(self, name: str) -> None:
        if name not in STEPS:
            raise ValueError(f"unknown step {name!r}")
        now = datetime.now(timezone.utc)
        self.records.append((name, "skipped", 0, now, now))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.records, "step string, status string, duration_ms int, start_time timestamp, end_time timestamp")
